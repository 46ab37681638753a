"""The registered queries: every operator over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywatch.config import HotKeyPolicy, RuleLimits, ScoringPolicy
from tallywatch.functions import moments
from tallywatch.functions.columns import MINUTE_US, cents, missing, whole_minutes
from tallywatch.operators import checks, quarantine, range_counts, report, rules
from tallywatch.plans import curated, evaluate, incremental, scoring, state
from tallywatch.plans.history import split_for
from tallywatch.plans.hot import Split
from tallywatch.schemas import FIELDS
from tallywatch.session import prepare
from tallywatch.sources import events, injection
from tallywatch.sources.events import NOW

Query = Callable[[SparkSession, str], DataFrame]
LIMITS = RuleLimits()
# Thresholds used by the variants.
STRICT = checks.with_thresholds(checks.DEFAULT_CHECKS, {c.name: 0.6 for c in checks.DEFAULT_CHECKS})
LOOSE = checks.with_thresholds(checks.DEFAULT_CHECKS, {c.name: 5.0 for c in checks.DEFAULT_CHECKS})
# Splits nearly every customer of the test tables, to run the hot-customer plan.
SPLIT_ALL = HotKeyPolicy(min_rows=32, samples_per_block=8)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.transactions_raw(prepare(spark), sf_dir)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.clean(_raw(spark, sf_dir), NOW)


def _split(spark: SparkSession, sf_dir: str, policy: HotKeyPolicy | None = None) -> Split | None:
    rows = _raw(spark, sf_dir).where(f"NOT {missing('customer_id')}")
    return split_for(rows, policy, LIMITS, at_most=2 * events.events(spark, sf_dir).count())


def _shown(*names: str) -> list[str]:
    """Amounts as double and times without zone, the same in every SQL engine."""
    types = {"amount": "DOUBLE", "transaction_ts": "TIMESTAMP_NTZ"}
    return [f"CAST({n} AS {types[n]}) AS {n}" if n in types else n for n in names]


def _rows(df: DataFrame) -> DataFrame:
    return df.selectExpr("event_id", *_shown(*FIELDS))


def _report(raw: DataFrame, which: tuple[checks.Check, ...] = checks.DEFAULT_CHECKS) -> DataFrame:
    return report.report(raw, NOW, which)


def _affected(name: str) -> Query:
    check = checks.by_name(name)
    return _from_raw(lambda raw: quarantine.affected(raw, check, NOW).selectExpr(
        "event_id", "transaction_id", *_shown(*check.shows)))


def _from_raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_raw(spark, sf_dir))


def _rule_rows(needs: tuple[str, ...], condition: str, *shown: str) -> Query:
    """Rows of a rule's history that meet a condition."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        split = _split(spark, sf_dir) if needs else None
        return scoring.features(_clean(spark, sf_dir), set(needs), LIMITS, split).where(condition).selectExpr(*shown)

    return query


def _scores(spark: SparkSession, sf_dir: str, which: scoring.Rules = rules.DEFAULT_RULES,
            policy: ScoringPolicy = ScoringPolicy(), hot: HotKeyPolicy | None = None) -> DataFrame:
    return scoring.score(_clean(spark, sf_dir), which, policy, LIMITS, _split(spark, sf_dir, hot))


def _score_rows(scores: DataFrame) -> DataFrame:
    return scores.selectExpr("event_id", "transaction_id", "customer_id", *_shown("amount"), "fraud_risk_score",
                             "risk_bucket", "triggered_rules", "reasons")


def _score_query(**options: object) -> Query:
    return lambda spark, sf_dir: _score_rows(_scores(spark, sf_dir, **options))


def _from_scores(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_scores(spark, sf_dir))


def _from_clean(build: Callable[..., DataFrame], *shown: str) -> Query:
    return lambda spark, sf_dir: build(_clean(spark, sf_dir), split=_split(spark, sf_dir)).select(*shown)


# -- a custom check and custom rules --------------------------------------------------
BIG_AMOUNT = checks.Check("validity.amount_over_limit", checks.WARNING, 1.0, "amount > 400", ("amount",))
CUSTOM_POLICY = ScoringPolicy(weights={**ScoringPolicy().weights, "big_amount": 15, "failing_merchant": 5})


def _failing_merchants(tx: DataFrame) -> DataFrame:
    """Flags each failed transaction at a merchant where over a fifth fail."""
    rates = report.aggregate(tx, ["merchant"], "count_if(status = 'failed') AS f", "count(*) AS n")
    bad = rates.where("f * 5 > n").select("merchant")
    return tx.where("status = 'failed'").join(bad, "merchant", "left_semi").selectExpr(
        "ingest_seq", "concat('failed at ', merchant) AS reason")


CUSTOM_RULES = (
    *rules.DEFAULT_RULES,
    rules.Rule("big_amount", lambda _: rules.one_if("amount > 400"),
               lambda _: ["CASE WHEN amount > 400 THEN 'amount over 400' END"]),
    rules.FlagRule("failing_merchant", _failing_merchants),
)


def _kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curated.kpis(_report(_raw(spark, sf_dir)), _scores(spark, sf_dir))


def _gated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores if the batch passes; the one-row gate is the only thing read here."""
    passed = report.gate(_report(_raw(spark, sf_dir), LOOSE)).first().all_critical_passed
    scores = _score_rows(_scores(spark, sf_dir))
    return scores if passed else scores.where("false")


SINCE = dt.date(2024, 1, 20)


def _incremental(spark: SparkSession, sf_dir: str, hot: HotKeyPolicy | None = None) -> DataFrame:
    """Scores since a date, from the state before it and a short look back."""
    clean = _clean(spark, sf_dir).selectExpr("*", "to_date(transaction_ts) AS transaction_date")
    before = state.amounts(clean.where(f"transaction_date < DATE'{SINCE}'"))
    return _score_rows(incremental.rescore(clean, SINCE, before, split=_split(spark, sf_dir, hot)))


def _label_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = "event_id % 13 = 0"
    fraud = evaluate.label_eval(_scores(spark, sf_dir), {
        "geo_impossible_travel": ("contains(triggered_rules, 'geo_impossible_travel')", moved),
        "medium_or_high": ("risk_bucket <> 'Low'", moved),
    })

    def flag(name: str) -> str:
        return checks.by_name(name).on_row(NOW)

    defects = evaluate.label_eval(_raw(spark, sf_dir), {
        "non_positive_amount": (flag("validity.negative_or_zero_amount"), "event_id % 199 = 3"),
        "future_dated": (flag("consistency.future_dated_transaction"), "event_id % 331 = 7"),
        "missing_customer": (flag("completeness.missing_customer_id"), "event_id % 101 = 17 OR event_id % 211 = 5"),
    })
    return fraud.unionByName(defects)


def _pattern_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many transactions of each injected pattern its own rule flags, and how well Medium and High tell all of them."""
    clean = _clean(spark, sf_dir)
    drawn = injection.injected(clean)
    labels = drawn.select("ingest_seq", "pattern")
    whole = clean.unionByName(drawn.drop("pattern"))
    scores = scoring.score(whole, limits=LIMITS, split=split_for(whole, None, LIMITS, at_most=30 * events.events(spark, sf_dir).count()))
    patterns = {name: (f"contains(triggered_rules, '{name}')", f"pattern = '{name}'") for name in injection.PATTERNS}
    return evaluate.label_eval(scores.join(labels, "ingest_seq", "left"), {
        **patterns, "any_medium_or_high": ("risk_bucket <> 'Low'", "pattern IS NOT NULL")})


def _velocity(count: str) -> Query:
    return _rule_rows((rules.VELOCITY,), f"{count} > {LIMITS.velocity_over}", "event_id", "transaction_id", f"{count} AS n")


def _velocity_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = _clean(spark, sf_dir).selectExpr("event_id", "transaction_id", "customer_id", "unix_micros(transaction_ts) AS at")
    found = range_counts.over(timed, "customer_id", "at", LIMITS.velocity_minutes * MINUTE_US, LIMITS.velocity_over)
    return found.select("event_id", "transaction_id", "n")


def queries() -> dict[str, Query]:
    in_run = rules.in_run(LIMITS)
    return {
        "transactions_raw": _from_raw(_rows),
        "raw_sanity": _from_raw(lambda raw: report.sanity(raw, NOW)),
        "dq_missing_customer_id": _affected("completeness.missing_customer_id"),
        "dq_missing_required_fields": _affected("completeness.missing_required_fields"),
        "dq_duplicate_transaction_id": _affected("uniqueness.duplicate_transaction_id"),
        "dq_negative_or_zero_amount": _affected("validity.negative_or_zero_amount"),
        "dq_invalid_currency": _affected("validity.invalid_currency_code"),
        "dq_future_dated": _affected("consistency.future_dated_transaction"),
        "dq_currency_country_mismatch": _affected("consistency.currency_country_mismatch"),
        "dq_report": _from_raw(_report),
        "dq_report_strict": _from_raw(lambda raw: _report(raw, STRICT)),
        "dq_custom_check": _from_raw(lambda raw: _report(raw, (*checks.DEFAULT_CHECKS, BIG_AMOUNT))),
        "dq_report_by_batch": _from_raw(lambda raw: report.report_by_batch(raw, NOW)),
        "dq_flagged_ids": _from_raw(lambda raw: quarantine.flagged_ids(raw, NOW)),
        "dq_quarantine": _from_raw(
            lambda raw: quarantine.quarantine(raw, NOW).select("event_id", "transaction_id", "failed_checks")),
        "dq_gate": _from_raw(lambda raw: report.gate(_report(raw))),
        "dq_alerts": _from_raw(lambda raw: report.alerts(_report(raw))),
        "dq_summary": _from_raw(lambda raw: report.summary(raw, NOW)),
        "dq_check_results": _from_raw(lambda raw: report.check_results(_report(raw))),
        "transactions_clean": lambda spark, sf_dir: _rows(_clean(spark, sf_dir)),
        "transactions_clean_by_id": _from_raw(lambda raw: _rows(quarantine.clean_by_id(raw, NOW))),
        "rule_velocity": _velocity("n_velocity"),
        "velocity_range_join": _velocity_range_join,
        "rule_velocity_sequential": _velocity("n_velocity_seq"),
        "amount_baseline": _rule_rows(
            (rules.BASELINE,), "true", "event_id", "n_prior", f"{cents(moments.TOTAL)} AS sum_prior_cents"),
        "rule_amount_anomaly": _rule_rows(
            (rules.BASELINE,), rules.unusual_amount(LIMITS),
            "event_id", "transaction_id", "n_prior", f"round({moments.Z}, 3) AS z"),
        "geo_pairs": _rule_rows(
            (rules.NEIGHBOURS,), rules.arrived(LIMITS), "prev.ingest_seq div 2 AS prev_event_id",
            "event_id AS curr_event_id", "customer_id", "prev.country AS prev_country", "country AS curr_country",
            f"{whole_minutes(rules.GAP_BEFORE)} AS gap_minutes"),
        "rule_geo_impossible": _rule_rows(
            (rules.NEIGHBOURS,), f"{rules.travel_flags(LIMITS)} > 0",
            "event_id", "transaction_id", f"{rules.travel_flags(LIMITS)} AS n_flags"),
        "rule_repeated_failures": _rule_rows(
            (rules.NEIGHBOURS, rules.RUNS), f"{in_run} OR {rules.after_run(LIMITS)}", "event_id", "transaction_id",
            f"CASE WHEN {in_run} THEN 'failure' ELSE 'success' END AS role",
            f"CASE WHEN {in_run} THEN run_size ELSE follows_run END AS cluster_size"),
        "rule_failures_windowed": _rule_rows(
            (rules.WINDOWED,), rules.in_cluster(LIMITS), "event_id", "transaction_id", "n_failures AS n"),
        "rule_success_after_failures": _rule_rows(
            (rules.WINDOWED,), "n_clusters > 0", "event_id", "transaction_id", "n_clusters AS n"),
        "rule_odd_hour": _rule_rows(
            (), rules.at_odd_hour(LIMITS), "event_id", "transaction_id", f"CAST({rules.hour_of(LIMITS)} AS BIGINT) AS hour"),
        "flag_reasons": _from_clean(scoring.flag_reasons, "event_id", "rule_name", "reason"),
        "all_flags": _from_clean(scoring.all_flags, "event_id", "transaction_id", "rule_name", "weight"),
        "fraud_scores": _score_query(),
        "fraud_scores_split": _score_query(hot=SPLIT_ALL),
        "fraud_scores_windowed": _score_query(which=rules.WINDOWED_RULES),
        "fraud_scores_windowed_split": _score_query(which=rules.WINDOWED_RULES, hot=SPLIT_ALL),
        "fraud_scores_incremental": _incremental,
        "fraud_scores_incremental_split": lambda spark, sf_dir: _incremental(spark, sf_dir, SPLIT_ALL),
        "custom_rule_scores": _score_query(which=CUSTOM_RULES, policy=CUSTOM_POLICY),
        "risk_bucket_counts": _from_scores(curated.bucket_counts),
        "bucket_distribution_filled": _from_scores(curated.bucket_distribution_filled),
        "fraud_bucket_distribution": _from_scores(
            lambda scores: curated.bucket_distribution(scores, report.BATCH_DATE)),
        "dq_health_trend": _from_raw(lambda raw: curated.health_trend(report.report_by_batch(raw, NOW), report.BATCH)),
        "rule_trigger_counts": _from_clean(scoring.trigger_counts, "rule_name", "n_flags", "n_transactions"),
        "top_flagged": _from_scores(lambda scores: _score_rows(curated.top_flagged(scores))),
        "top_flagged_10": _from_scores(lambda scores: _score_rows(curated.top_flagged(scores, 10, 0))),
        "dashboard_kpis": _kpis,
        "gated_scores": _gated_scores,
        "label_eval": _label_eval,
        "pattern_eval": _pattern_eval,
    }
