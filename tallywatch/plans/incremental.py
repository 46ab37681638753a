"""Scoring the latest dates without reading the whole history again.

The result equals full scoring cut to those dates. Amounts before them come from the
state; the other rules look back at most a travel window, plus whatever a run of
failures that reaches into the dates needs. New transactions can also change flags of
earlier ones (the stop before a trip, the members of a run), so a daily run rescores
from ``rescore_from`` on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tallywatch.config import RuleLimits, ScoringPolicy
from tallywatch.operators.report import aggregate
from tallywatch.operators.rules import DEFAULT_RULES
from tallywatch.plans import scoring
from tallywatch.plans.hot import Split

ONE_DAY = dt.timedelta(days=1)


def _at(moment: dt.datetime) -> str:
    return f"TIMESTAMP'{moment:%Y-%m-%d %H:%M:%S}+00:00'"


def _between(clean: DataFrame, start: dt.datetime, end: dt.datetime | None = None) -> DataFrame:
    """Rows of a time range; the date condition prunes the table's folders."""
    rows = clean.where(f"transaction_date >= DATE'{start:%Y-%m-%d}' AND transaction_ts >= {_at(start)}")
    return rows.where(f"transaction_date <= DATE'{end:%Y-%m-%d}' AND transaction_ts < {_at(end)}") if end else rows


def _failing_across(clean: DataFrame, moment: dt.datetime, step: dt.timedelta) -> DataFrame:
    """Customers that failed within a step of a moment on both sides of it."""
    near = _between(clean, moment - step, moment + step + dt.timedelta(seconds=1)).where("status = 'failed'")
    sides = aggregate(near, ["customer_id"], f"min(transaction_ts) < {_at(moment)} AS b", f"max(transaction_ts) >= {_at(moment)} AS a")
    return sides.where("a AND b").select("customer_id")


def with_context(clean: DataFrame, since: dt.date, limits: RuleLimits = RuleLimits()) -> DataFrame:
    """Rows since a date and the earlier rows their flags depend on, with the earlier
    rows' amounts removed (the state has them)."""
    start = dt.datetime.combine(since, dt.time())
    step = dt.timedelta(minutes=limits.failure_minutes)
    look_back = max(limits.travel_under_minutes, limits.velocity_minutes, 2 * limits.failure_minutes, limits.success_minutes)
    bound = start - dt.timedelta(minutes=look_back)
    rows = _between(clean, bound)
    # Runs that may go back further: more of those customers, a day at a time.
    still_open = _failing_across(clean, bound, step)
    while not still_open.isEmpty():
        earlier = bound - ONE_DAY
        rows = rows.unionByName(_between(clean, earlier, bound).join(still_open, "customer_id", "left_semi"))
        still_open = _failing_across(clean, earlier, step).join(still_open, "customer_id", "left_semi")
        bound = earlier
    kept = [f"CASE WHEN transaction_ts >= {_at(start)} THEN amount END AS amount" if c == "amount" else c for c in clean.columns]
    return rows.selectExpr(*kept)


def rescore_from(clean: DataFrame, first_new: dt.date, limits: RuleLimits = RuleLimits()) -> dt.date:
    """The first date whose flags may change once dates from ``first_new`` on arrive:
    the day before, or earlier while some customer failed without a break all day."""
    since, span = first_new - ONE_DAY, 1
    at_least = ONE_DAY // dt.timedelta(minutes=limits.failure_minutes) - 1
    while True:  # one day, then the 8, 64, ... days before it: few jobs, however long a customer keeps failing
        first = since - (span - 1) * ONE_DAY
        days = clean.where(f"transaction_date BETWEEN DATE'{first:%Y-%m-%d}' AND DATE'{since:%Y-%m-%d}'")
        unbroken = aggregate(days, ["customer_id", "transaction_date"], "count_if(status = 'failed') AS f", "count(*) AS n")
        found = {r[0] for r in unbroken.where(f"f = n AND n >= {at_least}").select("transaction_date").distinct().collect()}
        while since in found:
            since -= ONE_DAY
        if since >= first:
            return since
        span *= 8


def rescore(clean: DataFrame, since: dt.date, state: DataFrame, rules: scoring.Rules = DEFAULT_RULES,
            policy: ScoringPolicy = ScoringPolicy(), limits: RuleLimits = RuleLimits(),
            split: Split | None = None) -> DataFrame:
    """Scores of all rows since a date. ``clean`` has a ``transaction_date``; ``state``
    holds the amounts before the date (``state.amounts``, ``state.after``)."""
    context = with_context(clean, since, limits)
    return scoring.score(context, rules, policy, limits, split, state).where(f"transaction_date >= DATE'{since:%Y-%m-%d}'")
