"""Each rule at its edges, with whole customers and with customers cut into blocks.

Every case is a customer of one shared table, so the table is scored only a few times.
"""

from __future__ import annotations

import random

import pytest

from helpers import at, row, series, table
from tallywatch.config import HotKeyPolicy, RuleLimits, ScoringPolicy
from tallywatch.functions import moments
from tallywatch.operators import rules
from tallywatch.operators.rules import BASELINE, DEFAULT_RULES, NEIGHBOURS, RUNS, VELOCITY, WINDOWED, WINDOWED_RULES
from tallywatch.plans import scoring
from tallywatch.plans.history import split_for

LIMITS = RuleLimits()
EVERYTHING = {BASELINE, NEIGHBOURS, RUNS, VELOCITY, WINDOWED}
# Blocks of about one row.
TINY = HotKeyPolicy(min_rows=1, max_blocks=100_000, samples_per_block=1)
# The deviation of small amounts, from the exact totals.
SD = (f"CASE WHEN n_prior > 1 THEN sqrt((n_prior * {moments._SQUARES} - {moments._SUM} * {moments._SUM}) / n_prior / (n_prior - 1)) / 1E9D END")
TRAVEL, FAILED = "geo_impossible_travel", "repeated_failure_cardtesting"


def seconds(*offsets):
    return [f"10:{s // 60:02d}:{s % 60:02d}" for s in offsets]


def hours(n):
    return [f"{9 + i:02d}:00:00" for i in range(n)]


# case: rows, then per rule the numbers of the flagged transactions
CASES = {
    "burst": (series(seconds(0, 10, 20, 30, 40, 50)), {"velocity": [6]}),
    "spread": (series(["10:00:00", "11:00:00", "12:00:00"]), {"velocity": []}),
    "three_minutes": (series(seconds(0, 100, 110, 120, 130, 180)), {"velocity": [6]}),
    "over_three_minutes": (series(seconds(0, 100, 110, 120, 130, 181)), {"velocity": []}),
    "all_at_once": (series(seconds(*[0] * 6)), {"velocity": [1, 2, 3, 4, 5, 6]}),
    "short_history": (series(hours(4), amount=["10", "20", "15", "5000"]), {"amount_anomaly": []}),
    "outlier": (series(hours(5), amount=["10", "20", "15", "12", "5000"]), {"amount_anomaly": [5]}),
    "constant": (series(hours(5), amount=["10", "10", "10", "10", "5000"]), {"amount_anomaly": []}),
    "z_three": (series(hours(5), amount=["10", "10", "10", "14", "17"]), {"amount_anomaly": []}),
    "z_over_three": (series(hours(5), amount=["10", "10", "10", "14", "17.01"]), {"amount_anomaly": [5]}),
    "trip_119_59": (series(["10:00:00", "11:59:59"], country=["US", "GB"]), {TRAVEL: [1, 2]}),
    "trip_120_00": (series(["10:00:00", "12:00:00"], country=["US", "GB"]), {TRAVEL: []}),
    "trip_at_once": (series(["10:00:00", "10:00:00"], country=["US", "GB"]), {TRAVEL: [1, 2]}),
    "trip_chain": (series(["10:00:00", "10:10:00", "10:20:00"], country=["US", "GB", "DE"]), {TRAVEL: [1, 2, 3]}),
    "trip_unknown": (series(["10:00:00", "10:10:00"], country=["US", None]), {TRAVEL: []}),
    "fail_pair": (series(seconds(0, 120), status="failed"), {FAILED: [1, 2], "windowed": [2]}),
    "fail_apart": (series(seconds(0, 121), status="failed"), {FAILED: [], "windowed": []}),
    "fail_broken": (series(seconds(0, 20, 40), status=["failed", "success", "failed"]), {FAILED: [], "windowed": [3]}),
    "fail_pending": (series(seconds(0, 20, 40), status=["failed", "pending", "failed"]), {FAILED: [], "windowed": [3]}),
    "fail_then_success": (series(seconds(0, 20, 40, 130), status=["failed"] * 3 + ["success"]),
                          {FAILED: [1, 2, 3, 4], "windowed": [2, 3, 4]}),
    "fail_success_late": (series(seconds(0, 20, 141), status=["failed", "failed", "success"]),
                          {FAILED: [1, 2], "windowed": [2]}),
    "fail_success_edge": (series(seconds(0, 20, 140), status=["failed", "failed", "success"]),
                          {FAILED: [1, 2, 3], "windowed": [2, 3]}),
    "night": (series(["00:59:59", "01:00:00", "04:59:59", "05:00:00", "2025-03-01T02:00:00+05:30"]), {"odd_hour": [2, 3]}),
    "quiet": (series(["10:00:00"]), {"velocity": [], "amount_anomaly": [], TRAVEL: [], FAILED: [], "odd_hour": []}),
}


def all_rows():
    return [{**r, "customer_id": case, "transaction_id": f"{case}.{r['transaction_id'][3:]}"}
            for case, (rows, _) in CASES.items() for r in rows]


@pytest.fixture(scope="module", params=["whole", "split"])
def scored(request, spark):
    """Both rule sets over all cases, by transaction."""
    tx = table(spark, all_rows()).cache()
    split = split_for(tx, TINY) if request.param == "split" else None
    assert (split is None) == (request.param == "whole")
    return {name: {r.transaction_id: r for r in scoring.score(tx, which, split=split).collect()}
            for name, which in (("runs", DEFAULT_RULES), ("windows", WINDOWED_RULES))}


@pytest.mark.parametrize("case", CASES)
def test_flagged_transactions(scored, case):
    rows, expected = CASES[case]
    for rule, numbers in expected.items():
        found = scored["windows" if rule == "windowed" else "runs"]
        name = FAILED if rule == "windowed" else rule
        hit = [i for i in range(1, len(rows) + 1) if name in found[f"{case}.{i}"].triggered_rules.split(";")]
        assert hit == numbers, rule


def test_scores(scored):
    def total(name, case, n):
        return [scored[name][f"{case}.{i}"].fraud_risk_score for i in range(1, n + 1)]

    assert total("runs", "trip_chain", 3) == [35, 70, 35]
    assert total("runs", "fail_then_success", 4) == [30] * 4
    assert total("windows", "fail_then_success", 4) == [0, 30, 30, 60]
    quiet = scored["runs"]["quiet.1"]
    assert (quiet.fraud_risk_score, quiet.risk_bucket, quiet.triggered_rules, quiet.reasons) == (0, "Low", "", "")
    assert scored["runs"]["trip_chain.2"].risk_bucket == "High"


@pytest.mark.parametrize("rules_used,transaction,text", [
    ("runs", "burst.6", "6 transactions by burst within 3 min (threshold: >5)"),
    ("runs", "outlier.5", "amount 5000.00 is 1146.3 std devs above outlier's rolling average of 14.25 (n=4 prior txns)"),
    ("runs", "trip_chain.2", "trip_chain transacted in GB then DE only 10 min apart (threshold: <120 min) | "
                             "trip_chain transacted in US then GB only 10 min apart (threshold: <120 min)"),
    ("runs", "trip_119_59.1", "trip_119_59 transacted in US then GB only 119 min apart (threshold: <120 min)"),
    ("runs", "fail_then_success.1", "3 failed transactions by fail_then_success within 2 min windows "
                                    "(card-testing pattern, threshold: >=2)"),
    ("runs", "fail_then_success.4", "success followed a 3-failure card-testing cluster within 2 min"),
    ("windows", "fail_then_success.4", "success followed a card-testing failure cluster by fail_then_success within 2 min"),
    ("runs", "night.2", "transaction at 01:00 local (odd-hour window: 1-4am) — weak signal, contributing factor only"),
    ("windows", "night.2", "transaction at 01:00 local (odd-hour window: 1-4am) -- weak signal, contributing factor only"),
])
def test_reasons(scored, rules_used, transaction, text):
    assert scored[rules_used][transaction].reasons == text


def test_bucket_edges(spark):
    found = spark.createDataFrame([(s,) for s in (0, 24, 25, 49, 50)], "s int").selectExpr(scoring.bucket("s") + " AS b")
    assert [r.b for r in found.collect()] == ["Low", "Low", "Medium", "Medium", "High"]


def test_score_is_the_sum_of_flags(spark):
    tx = table(spark, all_rows())
    total = {r[0]: r[1] for r in scoring.all_flags(tx).groupBy("transaction_id").sum("weight").collect()}
    assert {r.transaction_id: r.fraud_risk_score for r in scoring.score(tx).collect()} == {
        r["transaction_id"]: total.get(r["transaction_id"], 0) for r in all_rows()}


def test_many_flags_on_one_row(spark):
    """25,000 failures at one instant: the success after them is flagged for each."""
    tx = spark.range(25_001).selectExpr(
        "concat('T', id) AS transaction_id", "'C' AS customer_id", "CAST(5 AS DECIMAL(38,9)) AS amount", "'USD' AS currency",
        "'Amazon' AS merchant", "'US' AS country",
        "TIMESTAMP'2025-03-01 10:00:00' + CASE WHEN id = 25000 THEN INTERVAL 1 SECOND ELSE INTERVAL 0 SECOND END AS transaction_ts",
        "CASE WHEN id = 25000 THEN 'success' ELSE 'failed' END AS status", "id AS ingest_seq")
    flags = scoring.all_flags(tx, WINDOWED_RULES).where("ingest_seq = 25000").groupBy("rule_name").count().collect()
    assert {r[0]: r[1] for r in flags} == {"velocity": 1, FAILED: 25_000}
    assert scoring.score(tx, WINDOWED_RULES).where("ingest_seq = 25000").first().fraud_risk_score == 25 + 30 * 25_000


def test_custom_rules(spark):
    extra = rules.Rule("big", lambda _: rules.one_if("amount > 60"), lambda _: ["CASE WHEN amount > 60 THEN 'big' END"])
    twice = rules.FlagRule("twice", lambda tx: tx.selectExpr("ingest_seq", "explode(array('b', 'a')) AS reason"))
    policy = ScoringPolicy(weights={"big": 25, "twice": 5})
    tx = table(spark, [row("TXN1", amount="70"), row("TXN2")])
    found = {r.transaction_id: r for r in scoring.score(tx, (extra, twice), policy).collect()}
    assert (found["TXN1"].fraud_risk_score, found["TXN1"].triggered_rules, found["TXN1"].reasons) == (35, "big;twice", "big | a | b")
    assert (found["TXN2"].fraud_risk_score, found["TXN2"].risk_bucket) == (10, "Low")


def test_wall_clock_hour(spark):
    tx = table(spark, [row("TXN1", ts="2025-03-01T02:00:00+05:30")]).selectExpr("*", "2 AS wall_clock_hour")
    limits = RuleLimits(wall_clock_hours=True)
    assert scoring.score(tx, limits=limits).first().fraud_risk_score == 10
    assert scoring.score(tx).first().fraud_risk_score == 0


# -- brute force ------------------------------------------------------------------------
def brute(rows):
    """What each rule counts, straight from its definition, for one customer."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i]["transaction_ts"], i))
    tx = [rows[i] for i in order]
    when = [r["transaction_ts"].timestamp() for r in tx]
    fails = [r["status"] == "failed" for r in tx]
    count = range(len(tx))
    runs, i = {}, 0
    while i < len(tx):
        j = i
        while fails[i] and j + 1 < len(tx) and fails[j + 1] and when[j + 1] - when[j] <= 120:
            j += 1
        if fails[i]:
            runs.update({k: j - i + 1 for k in range(i, j + 1)})
        i = j + 1
    clusters = [sum(fails[k] and 0 <= when[i] - when[k] <= 120 for k in count) if fails[i] else None for i in count]
    out = []
    for i, r in enumerate(tx):
        success = r["status"] == "success"
        follows = runs[i - 1] if i and success and fails[i - 1] and when[i] - when[i - 1] <= 120 else None
        landed = sum((clusters[k] or 0) >= 2 and 0 <= when[i] - when[k] <= 120 for k in count)
        prior = [float(x["amount"]) for x in tx[:i]]
        mean = sum(prior) / i if i else None
        sd = (sum((x - mean) ** 2 for x in prior) / (i - 1)) ** 0.5 if i > 1 else None
        out.append((
            r["transaction_id"], sum(0 <= when[i] - when[k] <= 180 for k in count),
            sum(0 <= when[i] - when[k] <= 180 for k in range(i + 1)), runs.get(i), follows, clusters[i],
            landed if success else None, i, round(sum(prior) * 100),
            None if mean is None else round(mean, 6), None if sd is None else round(sd, 6),
            tx[i - 1]["transaction_id"] if i else None, tx[i + 1]["transaction_id"] if i + 1 < len(tx) else None,
        ))
    return out


@pytest.mark.parametrize("policy", [None, TINY, HotKeyPolicy(min_rows=7, max_blocks=100_000, samples_per_block=3)])
def test_history_equals_brute_force(spark, policy):
    """Random histories, many with equal times: whole, one row per block, a few rows per block."""
    draw = random.Random(7)
    customers = []
    for c in range(60):
        spread = draw.choice([1, 20, 120, 900])
        customers.append([
            row(f"C{c:02d}-{i:02d}", seconds(draw.randrange(spread))[0], customer_id=f"C{c:02d}", amount=str(draw.randrange(1, 9)),
                status=draw.choice(["failed", "failed", "success", "pending"]))
            for i in range(draw.randrange(1, 40))])
    tx = table(spark, [r for rows in customers for r in rows])
    split = split_for(tx, policy) if policy else None
    assert policy is None or len(split.keys) > 100
    shown = ("transaction_id", "n_velocity", "n_velocity_seq", "run_size", "follows_run", "n_failures", "n_clusters", "n_prior",
             f"CAST({moments.TOTAL} * 100 AS BIGINT)", f"CASE WHEN n_prior > 0 THEN round({moments.MEAN}, 6) END", f"round({SD}, 6)", "prev.transaction_id AS p",
             "next.transaction_id AS n")
    found = scoring.features(tx, EVERYTHING, LIMITS, split).selectExpr(*shown).collect()
    assert sorted((tuple(r) for r in found), key=lambda r: r[0]) == sorted(r for rows in customers for r in brute(rows))


def test_one_transaction_time_shared_by_many_blocks(spark):
    """A customer whose rows all share one instant is still cut, and counts stay whole."""
    same = at("10:00:00")
    tx = spark.range(3000).selectExpr(
        "concat('T', id) AS transaction_id", "'HOT' AS customer_id", "CAST(5 AS DECIMAL(38,9)) AS amount", "'USD' AS currency",
        "'Amazon' AS merchant", "'US' AS country", f"TIMESTAMP'{same:%Y-%m-%d %H:%M:%S}' AS transaction_ts",
        "'failed' AS status", "id AS ingest_seq")
    split = split_for(tx, HotKeyPolicy(min_rows=100, max_blocks=1_000, samples_per_block=8))
    found = scoring.features(tx, EVERYTHING, LIMITS, split)
    blocks = found.groupBy("block").count().collect()
    assert len(blocks) > 15 and max(r["count"] for r in blocks) < 400
    got = found.selectExpr("min(n_velocity)", "max(n_velocity)", "count(DISTINCT n_velocity_seq)", "min(run_size)", "max(run_size)",
                           "min(n_failures)", f"count({moments.Z})", "count(DISTINCT n_prior)").first()
    assert tuple(got) == (3000, 3000, 3000, 3000, 3000, 3000, 0, 3000)
