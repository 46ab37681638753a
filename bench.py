"""Time the headline queries and print one JSON line.

Each query runs once to warm up, then ``BENCH_RUNS`` times (default 3) over its whole
result; the median is reported, from building the plan to the last row.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from tallywatch.queries import queries

HEADLINE = (
    "transactions_raw", "dq_report", "dq_report_by_batch", "dq_summary", "dq_flagged_ids", "dq_quarantine", "dq_gate",
    "transactions_clean", "transactions_clean_by_id", "rule_velocity", "rule_amount_anomaly", "rule_geo_impossible",
    "rule_repeated_failures", "rule_success_after_failures", "all_flags", "flag_reasons", "fraud_scores",
    "fraud_scores_windowed", "risk_bucket_counts", "top_flagged", "dashboard_kpis", "gated_scores", "label_eval",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered, seconds = queries(), {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
