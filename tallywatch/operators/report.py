"""Check reports: one row per check, for the whole load or for each batch date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.columns import quoted
from tallywatch.operators.checks import CRITICAL, DEFAULT_CHECKS, WARNING, Check, fails_any, watches_copies
from tallywatch.operators.duplicates import HAS_ID, ID
from tallywatch.operators.quarantine import trusted

BATCH = "batch_date"
BATCH_DATE = "to_date(transaction_ts)"
RESULT = ("check_name", "severity", "affected_row_count", "total_row_count",
          "affected_pct", "threshold_pct", "passed")


def aggregate(df: DataFrame, keys: list[str], *measures: str) -> DataFrame:
    return df.groupBy(*keys).agg(*map(F.expr, measures))


def _counts(raw: DataFrame, checks: tuple[Check, ...], now: str, keys: list[str],
            repeated: DataFrame | None = None) -> DataFrame:
    """All counts side by side: one scan for the conditions, one aggregate by id for
    repeated ids, united and added up, so neither side waits on a join."""
    by_row = {i: c for i, c in enumerate(checks) if c.condition}
    parts = aggregate(raw, keys, "count(*) AS total", *[f"count_if({c.where(now)}) AS a{i}" for i, c in by_row.items()])
    copies = [f"sum(copies) AS a{i}" for i, c in enumerate(checks) if c.condition is None]
    if copies:
        per_id = repeated
        if repeated is None:
            per_id = aggregate(raw.where(HAS_ID), [*keys, ID], "count(*) AS copies").where("copies > 1")
        parts = parts.unionByName(aggregate(per_id, keys, *copies), allowMissingColumns=True)
    names = ["total", *(f"a{i}" for i in range(len(checks)))]
    return aggregate(parts, keys, *[f"CAST(coalesce(sum({n}), 0) AS BIGINT) AS {n}" for n in names])


def results(counts: DataFrame, checks: tuple[Check, ...], keys: list[str]) -> DataFrame:
    """Counts side by side to one row per check. An empty batch has 0 % and passes."""
    rows = [
        f"struct({quoted(c.name)} AS check_name, {quoted(c.severity)} AS severity, a{i} AS affected_row_count,"
        f" total AS total_row_count, CAST({float(c.threshold_pct)} AS DOUBLE) AS threshold_pct)"
        for i, c in enumerate(checks)
    ]
    pct = "CASE WHEN total_row_count > 0 THEN 100D * affected_row_count / total_row_count ELSE 0D END"
    return (
        counts.selectExpr(*keys, f"inline(array({', '.join(rows)}))")
        .selectExpr("*", f"round({pct}, 3) AS affected_pct", f"{pct} <= threshold_pct AS passed")
        .select(*keys, *RESULT)
    )


def report(raw: DataFrame, now: str, checks: tuple[Check, ...] = DEFAULT_CHECKS,
           repeated: DataFrame | None = None) -> DataFrame:
    """The report of a whole load; ``repeated`` are its repeated ids, if known."""
    return results(_counts(raw, checks, now, [], repeated), checks, [])


def report_by_batch(raw: DataFrame, now: str, checks: tuple[Check, ...] = DEFAULT_CHECKS) -> DataFrame:
    """The report of each transaction date; ids repeat only within their date."""
    dated = raw.selectExpr("*", f"{BATCH_DATE} AS {BATCH}")
    return results(_counts(dated, checks, now, [BATCH]), checks, [BATCH])


def gate(issues: DataFrame) -> DataFrame:
    """One row: may the batch be scored? Closed when there is no critical result."""
    passed = "coalesce(bool_and(passed), false)"
    return aggregate(
        issues.where(f"severity = '{CRITICAL}'"), [],
        f"{passed} AS all_critical_passed",
        "count_if(passed) AS critical_passed",
        "count(*) AS critical_total",
        f"CASE WHEN {passed} THEN 'run_fraud_scoring' ELSE 'dq_fail_alert' END AS next_step",
    )


def alerts(issues: DataFrame) -> DataFrame:
    """The critical checks that breached."""
    return issues.where(f"severity = '{CRITICAL}' AND NOT passed").select("check_name", "affected_pct", "threshold_pct")


def check_results(issues: DataFrame) -> DataFrame:
    return issues.select("check_name", "severity", "affected_pct", "threshold_pct", "passed").orderBy("check_name")


def sanity(raw: DataFrame, now: str) -> DataFrame:
    """Counts to look at right after a load."""
    return aggregate(
        raw, [],
        "count(*) AS total_rows",
        "count_if(customer_id IS NULL) AS missing_customer_id",
        "count_if(amount <= 0) AS bad_amounts",
        f"count_if(transaction_ts > {now}) AS future_dated",
    )


def summary(raw: DataFrame, now: str, checks: tuple[Check, ...] = DEFAULT_CHECKS) -> DataFrame:
    """Run totals, from one aggregate by id."""
    per_id = aggregate(
        raw, [ID],
        "count(*) AS copies",
        f"max({fails_any(checks, CRITICAL, now)}) AS critical",
        f"max({fails_any(checks, WARNING, now)}) AS warning",
        f"count_if({trusted(now)}) AS trusted",
    )
    repeated = f"({HAS_ID} AND copies > 1)"
    critical, warning = (
        f"({s} OR {repeated if watches_copies(checks, s) else 'false'})" for s in (CRITICAL, WARNING))
    return aggregate(
        per_id, [],
        "coalesce(sum(copies), 0) AS total_rows",
        f"{len(checks)}L AS checks_run",
        f"{len({c.dimension for c in checks})}L AS dimensions_run",
        f"count_if({HAS_ID} AND {critical}) AS quarantined_ids",
        f"count_if({HAS_ID} AND {warning} AND NOT {critical}) AS warning_only_ids",
        f"coalesce(sum(CASE WHEN NOT {repeated} THEN trusted END), 0) AS clean_rows",
    )
