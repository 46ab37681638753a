"""The small tables a dashboard reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.config import BUCKETS
from tallywatch.operators.checks import CRITICAL
from tallywatch.operators.report import aggregate


def health_trend(issues: DataFrame, run_date: str) -> DataFrame:
    """Share of passed checks per run date."""
    dated = issues.selectExpr(f"{run_date} AS run_date", "passed")
    return aggregate(dated, ["run_date"], "try_divide(count_if(passed), count(*)) AS pass_rate")


def bucket_distribution(scores: DataFrame, run_date: str) -> DataFrame:
    dated = scores.selectExpr(f"{run_date} AS run_date", "risk_bucket")
    return aggregate(dated, ["run_date", "risk_bucket"], "count(*) AS n")


def bucket_counts(scores: DataFrame) -> DataFrame:
    return aggregate(scores, ["risk_bucket"], "count(*) AS n").orderBy(F.desc("n"), "risk_bucket")


def bucket_distribution_filled(scores: DataFrame) -> DataFrame:
    """All three buckets in order, with zeros."""
    counts = aggregate(scores, [], *[f"count_if(risk_bucket = '{b}') AS {b}" for b in BUCKETS])
    rows = ", ".join(f"struct('{b}' AS risk_bucket, {b} AS n)" for b in BUCKETS)
    return counts.selectExpr(f"inline(array({rows}))")


def top_flagged(scores: DataFrame, rows: int = 25, min_score: int = 25) -> DataFrame:
    """The highest scores; equal scores in ingest order."""
    return (
        scores.where(f"fraud_risk_score >= {int(min_score)}")
        .orderBy(F.desc("fraud_risk_score"), "ingest_seq")
        .limit(rows)
    )


def latest(issues: DataFrame) -> DataFrame:
    """The results of the latest run."""
    newest = aggregate(issues, [], "max(run_ts) AS run_ts")
    return issues.join(F.broadcast(newest), "run_ts", "left_semi")


def current(scores: DataFrame) -> DataFrame:
    """One score for each transaction: the latest run's, where days were scored again. Rows are known by their
    ``ingest_seq``, so missing and reused ids count once for each row."""
    newest = F.max_by(F.struct(*scores.columns), F.struct(*[c for c in ("run_ts", "run") if c in scores.columns])).alias("newest")
    return scores.groupBy("ingest_seq").agg(newest).select("newest.*")


def check_counts(issues: DataFrame, run: str) -> DataFrame:
    """One row of a run's checks, by which the trend is kept up to date."""
    return aggregate(issues.selectExpr(f"{run} AS run", "to_date(run_ts) AS run_date", "passed"), ["run", "run_date"],
                     "count_if(passed) AS n_passed", "count(*) AS n_checks")


def trend_of(counts: DataFrame) -> DataFrame:
    return aggregate(counts, ["run_date"], "try_divide(sum(n_passed), sum(n_checks)) AS pass_rate")


def bucket_counts_by_day(scores: DataFrame) -> DataFrame:
    """Current scores counted for each transaction date, which a run replaces as a whole."""
    return aggregate(
        current(scores).selectExpr("transaction_date", "to_date(run_ts) AS run_date", "risk_bucket", "fraud_risk_score"),
        ["transaction_date", "run_date", "risk_bucket"], "count(*) AS n", "max(fraud_risk_score) AS max_score")


def distribution_of(counts: DataFrame) -> DataFrame:
    return aggregate(counts, ["run_date", "risk_bucket"], "sum(n) AS n")


def published_kpis(issues: DataFrame, counts: DataFrame) -> DataFrame:
    """The headline numbers: checks of the latest run, and current scores by their counts."""
    return _kpis(latest(issues), aggregate(
        counts, [], "coalesce(sum(n), 0L) AS transactions_scored",
        "coalesce(sum(n) FILTER (WHERE risk_bucket = 'High'), 0L) AS high_risk", "max(max_score) AS max_score"))


def kpis(issues: DataFrame, scores: DataFrame) -> DataFrame:
    """One row of headline numbers; with no critical results the status is PASS."""
    return _kpis(issues, aggregate(
        scores, [],
        "count(*) AS transactions_scored", "count_if(risk_bucket = 'High') AS high_risk",
        "max(fraud_risk_score) AS max_score"))


def _kpis(issues: DataFrame, scored: DataFrame) -> DataFrame:
    checks = aggregate(
        issues.where(f"severity = '{CRITICAL}'"), [],
        "bool_and(passed) AS passed", "count_if(passed) AS critical_passing", "count(*) AS critical_total")
    numbers = ("transactions_scored", "high_risk", "critical_passing", "critical_total", "max_score")
    return aggregate(
        checks.unionByName(scored, allowMissingColumns=True), [],
        "CASE WHEN coalesce(bool_and(passed), true) THEN 'PASS' ELSE 'FAIL' END AS overall_status",
        *[f"max({n}) AS {n}" for n in numbers])
