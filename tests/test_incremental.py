"""Rescoring the latest dates equals scoring everything and keeping those dates."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest

from helpers import row, table
from tallywatch import schemas
from tallywatch.config import HotKeyPolicy
from tallywatch.operators.checks import DEFAULT_CHECKS, Check, with_thresholds
from tallywatch.operators.rules import DEFAULT_RULES, WINDOWED_RULES
from tallywatch.plans import daily, incremental, scoring, state
from tallywatch.plans.history import split_for
from tallywatch.sources.tables import Tables

D = dt.date(2025, 3, 3)
TINY = HotKeyPolicy(min_rows=3, max_blocks=100_000, samples_per_block=1)


def case(name, times, **changes):
    return [row(f"{name}.{i}", t, customer_id=name, **{k: v[i] if isinstance(v, list) else v for k, v in changes.items()})
            for i, t in enumerate(times)]


def every_two_minutes(start, n):
    first = dt.datetime.fromisoformat(start)
    return [(first + dt.timedelta(minutes=2 * i)).isoformat() for i in range(n)]


def rows():
    draw = random.Random(3)
    mixed = [t for c in range(25) for t in case(
        f"mix{c}", sorted(f"2025-03-0{draw.choice('1234')}T{draw.choice(['00', '23', '12'])}:{draw.randrange(60):02d}:{draw.randrange(60):02d}"
                          for _ in range(30)),
        amount=[str(draw.choice([1, 2, 3, 40])) for _ in range(30)], country=[draw.choice(["US", "GB"]) for _ in range(30)],
        status=[draw.choice(["failed", "failed", "success"]) for _ in range(30)])]
    return [
        *case("burst", [f"2025-03-02T23:59:{s}" for s in (20, 30, 40, 50)] + ["2025-03-03T00:00:10", "2025-03-03T00:00:20"]),
        *case("trip", ["2025-03-02T23:30:00", "2025-03-03T00:30:00"], country=["US", "GB"]),
        *case("run", ["2025-03-02T23:58:00", "2025-03-02T23:59:00", "2025-03-03T00:00:30", "2025-03-03T00:01:00"],
              status=["failed"] * 3 + ["success"]),
        *case("long_run", every_two_minutes("2025-03-02T02:00:00", 700), status="failed"),
        *case("constant", [f"2025-03-0{d}T{h}:00:00" for d in (1, 2, 3) for h in ("09", "10", "11")], amount=["0.1"] * 8 + ["900"]),
        *case("outlier", [f"2025-03-0{d}T{h}:00:00" for d in (1, 2, 3) for h in ("09", "10", "11")],
              amount=["10", "12", "9", "11", "10", "13", "800", "10", "11"]),
        *case("new", ["2025-03-03T10:00:00", "2025-03-03T11:00:00"]),
        *case("gone", ["2025-03-01T10:00:00"]),
        *mixed,
    ]


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clean") / "t")
    tx = table(spark, rows()).selectExpr("*", "to_date(transaction_ts) AS transaction_date")
    tx.write.partitionBy("transaction_date").parquet(path)
    return spark.read.parquet(path)


RESULT = ("transaction_id", "fraud_risk_score", "risk_bucket", "triggered_rules", "reasons")


def shown(scores, since=None):
    kept = scores.where(f"transaction_ts >= TIMESTAMP'{since} 00:00:00'") if since else scores
    return sorted(tuple(r) for r in kept.select(*RESULT).collect())


@pytest.mark.parametrize("which", [DEFAULT_RULES, WINDOWED_RULES], ids=["runs", "windows"])
@pytest.mark.parametrize("cut", [False, True], ids=["whole", "split"])
def test_rescoring_equals_full_scoring(clean, which, cut):
    before = state.after(state.amounts(clean.where("transaction_date < DATE'2025-03-02'")),
                         clean.where("transaction_date = DATE'2025-03-02'"))
    split = split_for(clean, TINY) if cut else None
    assert shown(incremental.rescore(clean, D, before, which, split=split)) == shown(scoring.score(clean, which), D)


def test_rescored_dates_reach_back_over_an_unbroken_day(spark):
    def first(n):
        tx = table(spark, case("c", every_two_minutes("2025-03-01T23:00:00", n), status="failed"))
        return incremental.rescore_from(tx.selectExpr("*", "to_date(transaction_ts) AS transaction_date"), D)

    assert first(100) == dt.date(2025, 3, 2)
    assert first(800) == dt.date(2025, 3, 1)


def test_state_join_adds_no_exchange_of_the_rows(spark, clean):
    clean = clean.where("customer_id <> 'long_run'")
    before = state.amounts(clean.where(f"transaction_date < DATE'{D}'"))

    def physical(split):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            return incremental.rescore(clean, D, before, split=split)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    plan = physical(None)
    assert plan.count("Exchange hashpartitioning(customer_id") == 2
    # Split: rows move once, by customer and block, and join the state where they are.
    by_row = physical(split_for(clean, TINY)).split("SortMergeJoin", 1)[1]
    first = re.search(r"Exchange hashpartitioning\(([^)]*)\)", by_row).group(1)
    assert re.fullmatch(r"customer_id#\d+, block#\d+L, \d+", first)
    assert re.search(r"PartitionFilters: \[[^]]*transaction_date#\d+ >= 2025-03-02", plan)


def test_daily_runs_after_earlier_loads(spark, tmp_path):
    """Three daily loads, the last one repeated, score as one table would."""
    tables = Tables(spark, str(tmp_path))
    settings = daily.Settings(
        checks=with_thresholds(DEFAULT_CHECKS, {c.name: 100.0 for c in DEFAULT_CHECKS}), scope=daily.AFTER_EARLIER)
    whole = table(spark, [r for r in rows() if r["customer_id"] != "long_run" and r["transaction_ts"].day < 4])
    now = dt.datetime(2025, 3, 5, tzinfo=dt.timezone.utc)
    closed = daily.Settings(scope=daily.AFTER_EARLIER, checks=(Check("never.passes", "critical", -1.0, "false"),))
    # The second load also brings some rows of the first date, and is refused at first.
    late = "transaction_id LIKE 'mix1%'"
    for day, used in ((1, settings), (2, closed), (2, settings), (3, settings), (3, settings)):
        date = dt.date(2025, 3, day)
        on_time = f"to_date(transaction_ts) = DATE'{date}' AND NOT (to_date(transaction_ts) = DATE'2025-03-01' AND {late})"
        also = f" OR ({late} AND to_date(transaction_ts) = DATE'2025-03-01')" if day == 2 else ""
        load = whole.where(f"({on_time}){also}").select(*schemas.FIELDS)
        outcome = daily.run_day(tables, load, date, now, used)
        assert outcome.passed == (used is settings)
    full = {r.transaction_id: tuple(r) for r in scoring.score(whole).select(*RESULT).collect()}
    last = {r.transaction_id: tuple(r) for r in outcome.scores.select(*RESULT).collect()}
    expected = {r["transaction_id"] for r in rows() if r["customer_id"] != "long_run" and r["transaction_ts"].day in (2, 3)}
    assert set(last) == expected
    assert last == {t: full[t] for t in last}
