"""Each customer's amounts so far: one row per customer, enough to go on from.

A state holds the exact count and totals of ``functions.moments``, so states of any parts of a history add up to the
state of the whole, in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions import moments
from tallywatch.operators.report import aggregate
from tallywatch.plans.hot import ONLY_BLOCK, Split

STATE = ("n", *moments.TOTALS)


def amounts(tx: DataFrame) -> DataFrame:
    """The state after these transactions alone; combined map-side."""
    return aggregate(
        moments.measured(tx.where("amount IS NOT NULL").select("customer_id", "amount")), ["customer_id"],
        "count(*) AS n", *[f"sum({x}) AS {name}" for name, x in moments.TOTALS.items()])


def by_day(clean: DataFrame) -> DataFrame:
    """What each customer adds to its state on each transaction date."""
    return aggregate(
        moments.measured(clean.where("amount IS NOT NULL").select("customer_id", "transaction_date", "amount")),
        ["customer_id", "transaction_date"], "count(*) AS n", *[f"sum({x}) AS {name}" for name, x in moments.TOTALS.items()])


def together(states: DataFrame) -> DataFrame:
    """One state per customer from those of several parts."""
    return aggregate(states, ["customer_id"], *[f"sum({c}) AS {c}" for c in STATE])


def after(before: DataFrame, tx: DataFrame) -> DataFrame:
    """The state after more transactions."""
    return together(before.select("customer_id", *STATE).unionByName(amounts(tx)))


def with_state(df: DataFrame, state: DataFrame, split: Split | None) -> DataFrame:
    """Put the state before the totals of an ordered history.

    The join runs on the keys the history is already partitioned and sorted by. The
    state of hot customers, at most one row per block, is broadcast instead.
    """
    named = [f"{c} AS _st_{c}" for c in STATE]
    if split is None:
        joined, before = df.join(state.selectExpr("customer_id", *named), "customer_id", "left"), {c: f"_st_{c}" for c in STATE}
    else:
        hot = state.join(F.broadcast(split.hot_customers(df)), "customer_id", "left_semi")
        joined = (
            df.join(F.broadcast(hot.selectExpr("customer_id", *[f"{c} AS _hot_{c}" for c in STATE])), "customer_id", "left")
            .join(state.selectExpr("customer_id", f"{ONLY_BLOCK} AS block", *named), ["customer_id", "block"], "left")
        )
        before = {c: f"_hot_{c}, _st_{c}" for c in STATE}
    replaced = {(moments.N if c == "n" else c): f"coalesce({old}, 0L)" for c, old in before.items()}
    return joined.selectExpr(*[f"{c} + {replaced[c]} AS {c}" if c in replaced else c for c in df.columns])
