"""Repeated ids: finding them and marking their rows, whatever the number of copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.config import HOT_COPIES, HOT_IDS
from tallywatch.functions.columns import missing

ID = "transaction_id"
HAS_ID = f"NOT {missing(ID)}"


def copies_per_id(tx: DataFrame, *extra: str) -> DataFrame:
    """One row per present id with its number of copies; copies are combined map-side."""
    return tx.where(HAS_ID).groupBy(ID).agg(*map(F.expr, ("count(*) AS copies", *extra)))


def mark(tx: DataFrame, ids: DataFrame, name: str, hot_copies: int = HOT_COPIES) -> DataFrame:
    """Add the boolean ``name``: does the row's id appear in ``ids`` (id, copies)?

    Ids with very many copies are fewer than HOT_IDS, so their list is broadcast. Their
    rows, and rows without an id, then join under a key of their own instead of the id,
    which keeps any one id from filling one task.
    """
    share = ids.agg(F.expr(f"coalesce(sum(copies), 0L) div {HOT_IDS}")).scalar()
    is_hot = F.col("copies") > F.greatest(F.lit(hot_copies), share)
    hot = ids.where(is_hot).selectExpr(ID, "true AS _hot")
    cold = ids.where(~is_hot).selectExpr(f"{ID} AS _key", "true AS _cold")
    key = f"CASE WHEN {HAS_ID} AND _hot IS NULL THEN {ID} ELSE concat('row ', ingest_seq) END"
    return (
        tx.join(F.broadcast(hot), ID, "left")
        .selectExpr("*", f"{key} AS _key")
        .join(cold, "_key", "left")
        # A row's own key may happen to equal some id: only rows that joined by id count.
        .selectExpr(*tx.columns, f"coalesce(_hot, {HAS_ID} AND _cold, false) AS {name}")
    )


def repeated_ids(tx: DataFrame) -> DataFrame:
    return copies_per_id(tx).where("copies > 1")


def mark_duplicates(tx: DataFrame, hot_copies: int = HOT_COPIES, repeated: DataFrame | None = None) -> DataFrame:
    """Add ``is_duplicate``, true on every copy of a repeated id (``repeated``, if known)."""
    return mark(tx, repeated_ids(tx) if repeated is None else repeated, "is_duplicate", hot_copies)
