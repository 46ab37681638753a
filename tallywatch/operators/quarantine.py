"""Splitting a load into rows fit to score and rows set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallywatch.config import HOT_COPIES
from tallywatch.functions.columns import missing, quoted
from tallywatch.operators.checks import CRITICAL, DEFAULT_CHECKS, WARNING, Check, fails_any, watches_copies, where_any
from tallywatch.operators.duplicates import copies_per_id, mark, mark_duplicates


def trusted(now: str) -> str:
    """Customer present, amount above zero, not in the future; NULLs are not trusted."""
    return f"(NOT {missing('customer_id')} AND amount > 0 AND transaction_ts <= {now})"


def clean(raw: DataFrame, now: str, hot_copies: int = HOT_COPIES, repeated: DataFrame | None = None) -> DataFrame:
    """Trusted rows whose id is not repeated anywhere in the load."""
    marked = mark_duplicates(raw, hot_copies, repeated)
    return marked.where(f"{trusted(now)} AND NOT is_duplicate").drop("is_duplicate")


def _severity_by_id(raw: DataFrame, now: str, checks: tuple[Check, ...]) -> DataFrame:
    by_row = [f"max({fails_any(checks, s, now)}) AS _{s}" for s in (CRITICAL, WARNING)]
    by_id = [f"(_{s} OR {'copies > 1' if watches_copies(checks, s) else 'false'}) AS {s}" for s in (CRITICAL, WARNING)]
    return copies_per_id(raw, *by_row).selectExpr("transaction_id", "copies", *by_id)


def clean_by_id(raw: DataFrame, now: str, checks: tuple[Check, ...] = DEFAULT_CHECKS,
                hot_copies: int = HOT_COPIES) -> DataFrame:
    """Rows whose id fails no critical check; rows without an id always stay."""
    bad = _severity_by_id(raw, now, checks).where(CRITICAL).select("transaction_id", "copies")
    return mark(raw, bad, "_bad", hot_copies).where("NOT _bad").drop("_bad")


def flagged_ids(raw: DataFrame, now: str, checks: tuple[Check, ...] = DEFAULT_CHECKS) -> DataFrame:
    """Each id with each severity it fails."""
    severities = ", ".join(f"CASE WHEN {s} THEN '{s}' END" for s in (CRITICAL, WARNING))
    return _severity_by_id(raw, now, checks).selectExpr(
        "transaction_id", f"explode(array_compact(array({severities}))) AS severity")


def quarantine(raw: DataFrame, now: str, checks: tuple[Check, ...] = DEFAULT_CHECKS,
               repeated: DataFrame | None = None) -> DataFrame:
    """Rows that fail a critical check, with all the checks they fail."""
    names = ", ".join(f"CASE WHEN {c.on_row(now)} THEN {quoted(c.name)} END" for c in sorted(checks, key=lambda c: c.name))
    return (
        mark_duplicates(raw, repeated=repeated)
        .where(where_any(checks, CRITICAL, now))
        .selectExpr(*raw.columns, f"concat_ws(';', {names}) AS failed_checks")
    )


def affected(raw: DataFrame, check: Check, now: str) -> DataFrame:
    """The rows one check is about."""
    if check.condition:
        return raw.where(check.where(now))
    return mark_duplicates(raw).where("is_duplicate").drop("is_duplicate")
