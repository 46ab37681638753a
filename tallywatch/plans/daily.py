"""The gated daily run: load, check, set aside, then score or alert, and refresh.

Curated tables are kept up to date, not rebuilt: a run counts its own scores and the scores of the dates it
replaces, and puts the counts in place of those dates' former ones.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallywatch import schemas
from tallywatch.config import HotKeyPolicy, RuleLimits, ScoringPolicy
from tallywatch.functions.columns import timestamp
from tallywatch.operators import known_ids, quarantine, report
from tallywatch.operators.checks import DEFAULT_CHECKS, Check
from tallywatch.operators.duplicates import repeated_ids
from tallywatch.operators.rules import DEFAULT_RULES
from tallywatch.plans import curated, incremental, scoring, states
from tallywatch.plans.history import split_for
from tallywatch.session import prepare
from tallywatch.sources.files import read_csv, rejected_csv, typed, write_csv
from tallywatch.sources.tables import DATE, Tables

LOAD, RUN = "load_date", "run_date"
# What a run covers: its load by itself; its load checked by itself but scored after
# the transactions of earlier loads; or everything loaded so far, anew. In each of them a
# row whose id an earlier load holds counts as repeated.
LOAD_ONLY, AFTER_EARLIER, ALL_LOADS = "load_only", "after_earlier", "all_loads"


@dataclass(frozen=True)
class Settings:
    checks: tuple[Check, ...] = DEFAULT_CHECKS
    rules: scoring.Rules = DEFAULT_RULES
    policy: ScoringPolicy = ScoringPolicy()
    limits: RuleLimits = RuleLimits()
    hot: HotKeyPolicy = HotKeyPolicy()
    scope: str = LOAD_ONLY
    snapshot_runs: int = states.SNAPSHOT_RUNS
    id_index: known_ids.IdIndex = known_ids.IdIndex()
    csv_folder: str | None = None  # where a run also leaves its issues, clean rows and scores as CSV


@dataclass(frozen=True)
class Outcome:
    passed: bool
    next_step: str
    issues: DataFrame
    clean: DataFrame
    scores: DataFrame | None


def run_day(tables: Tables, rows: DataFrame, run_date: dt.date, now: dt.datetime,
            settings: Settings = Settings()) -> Outcome:
    """One daily run: ``rows`` become ``run_date``'s load, and that load (or all loads
    so far) is checked, split into clean and quarantined rows, and scored.

    ``now`` is the one point in time of the run: the bound for future-dated rows and
    the run_ts of every result. The load is written first, so that report, quarantine
    and scores all see the same rows; the only value read here is the one-row gate.
    """
    prepare(tables.spark)
    at = timestamp(now)
    limits = settings.limits
    load = tables.write_dated(typed(rows, run_date, now, limits.wall_clock_hours), "transactions_raw", LOAD, run_date)
    raw = load
    if settings.scope == ALL_LOADS:
        schema = T.StructType([*raw.schema.fields, T.StructField(LOAD, T.DateType())])
        raw = tables.read("transactions_raw", schema=schema).where(f"{LOAD} <= DATE'{run_date.isoformat()}'").drop(LOAD)
    raw = raw.drop(DATE)

    ids = known_ids.record(tables, load, run_date, settings.id_index)
    if settings.scope == ALL_LOADS:
        twice = repeated_ids(raw)
    else:  # repeated in the load, or in it and an earlier one
        twice = ids.where("copies > 1").unionByName(known_ids.seen_before(tables, ids.where("copies = 1"), run_date, settings.id_index))
    # Written once: then their real size decides how they are joined.
    repeated = tables.write(twice, "repeated_ids", RUN, run_date)
    results = report.report(raw, at, settings.checks, repeated).selectExpr("*", f"{at} AS run_ts")
    issues = tables.write(results, "dq_issues", RUN, run_date)
    trusted = quarantine.clean(raw, at, repeated=repeated).drop("load_ts")
    dates = tables.values("transactions_clean", RUN, run_date, DATE)
    clean = tables.write_clustered(trusted, "transactions_clean", RUN, run_date)
    states.record(tables, clean, run_date)
    tables.write(quarantine.quarantine(raw, at, settings.checks, repeated), "transactions_quarantined", RUN, run_date)

    gate = report.gate(issues).first()
    to_score, since, before = clean, None, None
    dates += tables.values("transactions_clean", RUN, run_date, DATE)
    if settings.scope == AFTER_EARLIER and dates:
        schema = T.StructType([*clean.schema.fields, T.StructField(RUN, T.DateType())])
        every = tables.read("transactions_clean", schema=schema).where(f"{RUN} <= DATE'{run_date.isoformat()}'").drop(RUN)
        since = incremental.rescore_from(every, min(dates), limits)
        before = states.before(tables, run_date, since, settings.snapshot_runs)
        to_score = incremental.with_context(every, since, limits)

    scores = None
    rescored = tables.values("fraud_scores", RUN, run_date, DATE)
    if gate.all_critical_passed:
        split = split_for(to_score, settings.hot, limits)
        scored = scoring.score(to_score, settings.rules, settings.policy, limits, split, before)
        if since:
            scored = scored.where(f"{DATE} >= DATE'{since}'")
        published = scoring.scores_table(scored, at).repartitionByRange(DATE, "ingest_seq")
        scores = tables.write(published, "fraud_scores", RUN, run_date, by=(DATE,))
    else:  # nothing of an earlier, passed run of this date may stay
        tables.write(tables.spark.createDataFrame([], schemas.FRAUD_SCORES), "fraud_scores", RUN, run_date, by=(DATE,))
    rescored += tables.values("fraud_scores", RUN, run_date, DATE)
    tables.write(report.alerts(issues).selectExpr("*", f"{at} AS run_ts"), "dq_alerts", RUN, run_date)
    refresh_curated(tables, issues, run_date, sorted(set(rescored)))
    if settings.csv_folder:
        none = tables.spark.createDataFrame([], schemas.FRAUD_SCORES)
        written = {"dq_issues": issues.select(*schemas.DQ_ISSUES.fieldNames()), "transactions_clean": clean.select(*schemas.FIELDS),
                   "fraud_scores": (none if scores is None else scores).drop("ingest_seq", DATE)}
        for name, df in written.items():
            write_csv(df, f"{settings.csv_folder}/{run_date.isoformat()}/{name}")
    return Outcome(gate.all_critical_passed, gate.next_step, issues, clean, scores)


def run_csv(tables: Tables, path: str, run_date: dt.date, now: dt.datetime, settings: Settings = Settings(), multi_line: bool = True) -> Outcome:
    """``run_day`` over CSV files. Broken lines are checked with what they hold, and are
    kept as they were written in ``rejected_lines``."""
    tables.write(rejected_csv(tables.spark, path, multi_line), "rejected_lines", LOAD, run_date)
    return run_day(tables, read_csv(tables.spark, path, multi_line, keep_broken=True), run_date, now, settings)


def refresh_curated(tables: Tables, issues: DataFrame, run_date: dt.date, dates: list[dt.date]) -> None:
    """Bring the small tables up to date after a run that (re)placed the scores of these transaction dates."""
    run = f"DATE'{run_date.isoformat()}'"
    others = tables.read_or_empty("check_counts", schemas.CHECK_COUNTS).where(f"run <> {run}")
    checks = tables.write(others.unionByName(curated.check_counts(issues, run)).coalesce(1), "check_counts")
    tables.write(curated.trend_of(checks).coalesce(1), "dq_health_trend")

    counts = tables.read_or_empty("fraud_bucket_counts", schemas.BUCKET_COUNTS)
    if dates:
        days = ", ".join(f"DATE'{d.isoformat()}'" for d in dates)
        stored = T.StructType([*schemas.FRAUD_SCORES.fields, T.StructField(RUN, T.DateType())])
        scores = tables.read("fraud_scores", schema=stored).where(f"{DATE} IN ({days})").withColumnRenamed(RUN, "run")
        counts = counts.where(f"{DATE} NOT IN ({days})").unionByName(curated.bucket_counts_by_day(scores))
    counts = tables.write(counts.coalesce(1), "fraud_bucket_counts")
    tables.write(curated.distribution_of(counts).coalesce(1), "fraud_bucket_distribution")
    tables.write(curated.published_kpis(issues, counts).coalesce(1), "published_kpis")
