"""Upkeep of the tables of daily runs."""

from __future__ import annotations

import datetime as dt
import re

from helpers import row, table
from tallywatch.sources.tables import Tables

DAY = dt.date(2025, 3, 1)
ORDER = ("transaction_date", "customer_id", "transaction_ts", "ingest_seq")


def test_compaction_keeps_rows_and_pruning(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    rows = [row(f"T{i}", f"2025-02-{1 + i % 5:02d}T{i % 24:02d}:00:00", customer_id=f"C{i % 7}", ingest_seq=i) for i in range(400)]
    dated = table(spark, rows).selectExpr("*", "to_date(transaction_ts) AS transaction_date").repartition(20)
    written = tables.write(dated, "transactions_clean", "run_date", DAY, by=("transaction_date",))
    want = sorted(map(tuple, written.select(*dated.columns).collect()))
    assert len(written.inputFiles()) > 50
    assert tables.compact("transactions_clean", "run_date", DAY, ORDER)
    after = tables.read("transactions_clean", "run_date", DAY)
    assert sorted(map(tuple, after.select(*dated.columns).collect())) == want
    assert len(after.inputFiles()) <= 6
    plan = after.where("transaction_date = DATE'2025-02-02'")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*transaction_date", plan)
    one = after.where("transaction_date = DATE'2025-02-02'").select("customer_id").collect()
    assert [r[0] for r in one] == sorted(r[0] for r in one)
    # Nothing more to do, and a version of its own for each rewrite.
    assert not tables.compact("transactions_clean", "run_date", DAY, ORDER)
    assert tables.compact("transactions_clean", "run_date", DAY, ORDER, target_bytes=1) is False
    versions = [p.name for p in (tmp_path / "transactions_clean" / "run_date=2025-03-01").iterdir() if p.is_dir()]
    assert sorted(versions) == ["v=0", "v=1"]


def test_compaction_of_a_folder_without_dates(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.write(spark.range(100).repartition(9), "numbers", "run_date", DAY)
    assert tables.compact("numbers", "run_date", DAY, ("id",))
    assert [r.id for r in tables.read("numbers", "run_date", DAY).collect()] == list(range(100))
