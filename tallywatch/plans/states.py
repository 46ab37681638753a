"""The states of all customers, kept from run to run.

A run adds one row for each customer and transaction date in its clean rows (``customer_days``), whatever the dates:
a single row dated 1970 adds a row, not a state for each day since. As totals add up in any order, the state before a
date is the sum of all rows of earlier dates. So that this doesn't grow with the history, every ``SNAPSHOT_RUNS`` runs
that sum is written as a snapshot (``customer_state``, with the date it reaches to); later runs add to it the
days it doesn't reach, and days of any date that later runs brought. Folders of other runs and dates are never read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallywatch.plans import state
from tallywatch.sources.tables import DATE, Tables

DAYS, SNAPSHOTS = "customer_days", "customer_state"
RUN, AS_OF = "run_date", "as_of"
SNAPSHOT_RUNS = 30

_TOTALS = [T.StructField("customer_id", T.StringType()), *(T.StructField(c, T.LongType()) for c in state.STATE)]
_DAYS = T.StructType([*_TOTALS, T.StructField(RUN, T.DateType()), T.StructField(DATE, T.DateType())])


def record(tables: Tables, clean: DataFrame, run: dt.date) -> None:
    """Store what a run's clean rows add. Snapshots that hold a former version of the run go."""
    for taken in tables.days(SNAPSHOTS, RUN):
        if taken >= run:
            tables.drop(SNAPSHOTS, RUN, taken)
    added = state.by_day(clean).repartitionByRange(DATE, "customer_id")
    tables.write(added, DAYS, RUN, run, by=(DATE,))


def before(tables: Tables, run: dt.date, since: dt.date, snapshot_runs: int = SNAPSHOT_RUNS) -> DataFrame:
    """The states before a date, as a run and those before it make them; now and then kept as a snapshot."""
    snapshot, reach = None, dt.date.min
    earlier = [d for d in tables.days(SNAPSHOTS, RUN) if d < run]
    for taken in reversed(earlier):
        reaches = tables.values(SNAPSHOTS, RUN, taken, AS_OF)
        if reaches and reaches[0] <= since:
            snapshot, reach = taken, reaches[0]
            break
    days = tables.read(DAYS, schema=_DAYS).where(f"{RUN} <= DATE'{run}' AND {DATE} < DATE'{since}'")
    parts = days.select("customer_id", *state.STATE)
    if snapshot:
        newer = days.where(f"{RUN} > DATE'{snapshot}' OR {DATE} >= DATE'{reach}'")
        parts = tables.read(SNAPSHOTS, RUN, snapshot).select("customer_id", *state.STATE).unionByName(newer.select("customer_id", *state.STATE))
    found = state.together(parts)
    # Runs since the last snapshot, also one that is empty or reaches too far: late rows don't bring one more in each run.
    open_runs = [d for d in tables.days(DAYS, RUN) if d <= run and (not earlier or d > max(earlier))]
    if len(open_runs) < snapshot_runs:
        return found
    kept = tables.write(found.selectExpr("*", f"DATE'{since}' AS {AS_OF}"), SNAPSHOTS, RUN, run, by=(AS_OF,))
    return kept.select("customer_id", *state.STATE)
