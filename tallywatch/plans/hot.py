"""Splitting the histories of very large customers over several tasks.

The per-customer rules read rows in time order. Customers of ordinary size are one
window partition each. A customer above the limit of ``HotKeyPolicy`` is cut into
blocks of consecutive rows at sampled split points; windows then run per block, and
what a block needs from its neighbours (running totals, the row before, the row
after) comes from a small per-block summary. Split points are plain values, so the
cut is the same on every retry, and where they fall never changes a result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.config import HotKeyPolicy
from tallywatch.operators.heavy import heavy_keys


# The block of a customer that is not split: any negative number will do, but it must
# not be one constant, or Spark drops it from the keys of a join on (customer, block)
# and moves the rows by customer again.
ONLY_BLOCK = "(-1L - pmod(xxhash64(customer_id), 4611686018427387904L))"


@dataclass(frozen=True)
class Split:
    """Split points of all hot customers, sorted by customer and position."""

    customers: list[tuple[str, int, int]]  # customer, first split point, end
    keys: np.ndarray
    kinds: np.ndarray
    seqs: np.ndarray

    def hot_customers(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.createDataFrame(self.customers, "customer_id string, _lo bigint, _hi bigint")

    def assign(self, entries: DataFrame) -> DataFrame:
        """Add ``block`` (negative for other customers), ``_start_key`` and ``_next_key``."""
        hot = self.hot_customers(entries)
        lo, hi, block = F.col("_lo"), F.col("_hi"), F.col("block")
        key, kind, seq = F.col("key"), F.col("kind"), F.col("ingest_seq")
        keys, kinds, seqs = F.lit(self.keys), F.lit(self.kinds), F.lit(self.seqs)

        def reached(i: Column) -> Column:
            k, q, s = (F.get(a, i.cast("int")) for a in (keys, kinds, seqs))
            return (k < key) | ((k == key) & ((q < kind) | ((q == kind) & (s <= seq))))

        # Binary search for the number of split points at or before the row.
        widest = max(end - first for _, first, end in self.customers)
        steps = np.array([1 << b for b in reversed(range(int(widest).bit_length()))], dtype=np.int64)
        found = F.aggregate(
            F.lit(steps), lo,
            lambda at, step: F.when((at + step <= hi) & reached(at + step - 1), at + step).otherwise(at),
        )
        return (
            entries.join(F.broadcast(hot), "customer_id", "left")
            .withColumn("block", F.when(lo.isNotNull(), found).otherwise(F.expr(ONLY_BLOCK)))
            .withColumns({
                "_start_key": F.when(block > lo, F.get(keys, (block - 1).cast("int"))),
                "_next_key": F.when(block < hi, F.get(keys, block.cast("int"))),
            })
            .drop("_lo", "_hi")
        )


def find_split(rows: DataFrame, to_entries: Callable[[DataFrame], DataFrame], policy: HotKeyPolicy,
               at_most: int | None = None) -> Split | None:
    """Split points for the customers that need them, or None.

    ``rows`` are the transactions, or any superset of them that is cheaper to count;
    ``to_entries`` gives the entries to be ordered, with customer_id, key, kind and
    ingest_seq; ``at_most`` is a bound on the number of rows, if one is known, which
    spares the count. At most a few times ``max_blocks`` split points reach the driver.
    """
    total = rows.count() if at_most is None else at_most
    if total <= policy.min_rows:
        return None
    limit = max(policy.min_rows, -(-total // policy.max_blocks))
    hot = heavy_keys(rows, "customer_id", -(-total // limit), total).where(f"n > {limit}").select("customer_id")
    every = max(1, limit // policy.samples_per_block)
    per_block = max(1, limit // every)
    points = (
        to_entries(rows.join(F.broadcast(hot), "customer_id", "left_semi"))
        .where(f"pmod(xxhash64(kind, ingest_seq), {every}) = 0")
        .selectExpr("customer_id", "key", "CAST(kind AS BIGINT) AS kind", "ingest_seq",
                    "row_number() OVER (PARTITION BY customer_id ORDER BY key, kind, ingest_seq) AS _at")
        .where(f"_at % {per_block} = 0")
        .orderBy("customer_id", "key", "kind", "ingest_seq")
        .collect()
    )
    if not points:
        return None
    customers: list[tuple[str, int, int]] = []
    for i, point in enumerate(points):
        first = customers.pop()[1] if customers and customers[-1][0] == point.customer_id else i
        customers.append((point.customer_id, first, i + 1))
    keys, kinds, seqs = (
        np.array([p[name] for p in points], dtype=np.int64) for name in ("key", "kind", "ingest_seq"))
    return Split(customers, keys, kinds, seqs)
