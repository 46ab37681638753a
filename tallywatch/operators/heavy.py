"""Keys that hold a large share of all rows, found without grouping by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Counters of the sketch for each key that may be returned. A sketch of frequent items with m counters errs by
# less than 2.7 / m of the rows, and names only keys it is sure of: those that exceed the error twice. With eight
# counters a key, none above its share is missed.
COUNTERS, FEWEST, MOST = 8, 16, 1_000_000


def heavy_keys(rows: DataFrame, key: str, at_most: int, total: int | None = None) -> DataFrame:
    """The keys of more than one in ``at_most`` rows (NULL is none), with their exact counts: key, n.

    There are fewer than ``at_most``, however large the table, so the result may be broadcast. One pass merges
    sketches of a bounded size, one of each task; another counts the keys they name. ``total`` is the number
    of rows, if known. Empty for no rows.
    """
    if not 1 <= at_most <= MOST // COUNTERS:
        raise ValueError(f"from 1 to {MOST // COUNTERS} heavy keys can be found, not {at_most}")
    tracked = max(FEWEST, COUNTERS * at_most)
    present = rows.where(F.col(key).isNotNull()).select(key)
    seen = present.agg(F.expr(f"approx_top_k({key}, {tracked}, {tracked})").alias("named"), F.expr("count(*) AS n")).first()
    kind = present.schema[key].dataType.simpleString()
    named = rows.sparkSession.createDataFrame([(k["item"],) for k in seen.named or []], f"{key} {kind}")
    counts = present.join(F.broadcast(named), key, "left_semi").groupBy(key).agg(F.expr("count(*) AS n"))
    return counts.where(f"n * {int(at_most)}L > {int(total if total is not None else seen.n)}L")
