"""A range self-join that returns counts instead of pairs.

How many rows of the same key lie within a width before each row? Time is cut into buckets of that width, so all of
them lie in the row's own bucket or the one before. A key's rows meet per bucket, not per key, which spreads a key with
very many rows over as many tasks as it has buckets; and they meet as counted instants, so that neither many rows of one
instant nor many rows of one bucket make more than one row for each instant. No pair is ever written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallywatch.operators.report import aggregate


def counts_within(rows: DataFrame, key: str, at: str, width: int) -> DataFrame:
    """key, at, n: for each key and instant, the rows of the key from ``width`` before it up to it, both included.

    ``at`` is a column of whole numbers; rows where it or the key is NULL don't count.
    """
    instants = aggregate(rows.where(f"{key} IS NOT NULL AND {at} IS NOT NULL"), [key, at], "count(*) AS m")
    bucket = f"(({at} - pmod({at}, {width}L)) div {width}L)"
    # Each instant stands in its bucket, and asks the bucket before it from the start of its range on.
    cells = instants.selectExpr(
        key, at, f"inline(array(named_struct('bucket', {bucket}, 'place', {at}, 'own', m, 'asks', false),"
                 f" named_struct('bucket', {bucket} - 1, 'place', {at} - {width}L, 'own', 0L, 'asks', true)))")
    cell = f"PARTITION BY {key}, bucket"
    up_to = f"sum(own) OVER ({cell} ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = f"coalesce(sum(own) OVER ({cell} ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
    counted = cells.selectExpr(key, at, f"CASE WHEN asks THEN sum(own) OVER ({cell}) - {before} ELSE {up_to} END AS c")
    return aggregate(counted, [key, at], "sum(c) AS n")


def over(rows: DataFrame, key: str, at: str, width: int, limit: int) -> DataFrame:
    """The rows with more than ``limit`` rows in their range, and that number, ``n``. Only the instants above the limit
    meet the rows again; one with very many rows is a skewed join key, which Spark splits."""
    hits = counts_within(rows.select(key, at), key, at, width).where(f"n > {int(limit)}")
    return rows.join(hits, [key, at])
