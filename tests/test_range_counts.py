"""Counts of a range self-join, against counting pairs."""

from __future__ import annotations

import random

import pytest

from tallywatch.operators.range_counts import counts_within, over


@pytest.mark.parametrize("seed, width", [(1, 10), (2, 1), (3, 97)])
def test_counts_equal_pairs(spark, seed, width):
    draw = random.Random(seed)
    rows = [(draw.choice(["a", "b", "c", None]), draw.choice([draw.randrange(-200, 200), draw.randrange(-30, 30), None])) for _ in range(500)]
    found = {(r.customer_id, r.at): r.n for r in counts_within(
        spark.createDataFrame(rows, "customer_id string, at long").repartition(3), "customer_id", "at", width).collect()}
    kept = [(k, t) for k, t in rows if k is not None and t is not None]
    assert found == {(k, t): sum(k2 == k and t - width <= t2 <= t for k2, t2 in kept) for k, t in kept}


def test_a_hot_key_makes_no_pairs_and_no_single_task(spark):
    """A third of all rows in one instant of one key: rows stay rows, in every exchange."""
    rows = spark.range(60_000).selectExpr("id", "CASE WHEN id % 3 > 0 THEN 'hot' ELSE concat('k', id % 50) END AS customer_id",
                                          "CASE WHEN id % 3 = 1 THEN 5000L ELSE id * 7 END AS at")
    found = over(rows, "customer_id", "at", 180, 10)
    assert found.where("at = 5000 AND customer_id = 'hot'").selectExpr("count(*)", "min(n)").first()[0] == 20_000
    cells = counts_within(rows, "customer_id", "at", 180)
    assert cells.count() == rows.select("customer_id", "at").distinct().count()
    keys = cells._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(customer_id" in keys and "bucket#" in keys.split("Window", 1)[1].split("Exchange", 1)[1].split("\n", 1)[0]


def test_empty(spark):
    assert counts_within(spark.createDataFrame([], "k string, t long"), "k", "t", 5).collect() == []
