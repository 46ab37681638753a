"""From clean transactions to flags, scores, buckets and reasons, in one exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallywatch.config import RuleLimits, ScoringPolicy
from tallywatch.functions.columns import quoted
from tallywatch.operators.report import aggregate
from tallywatch.operators.rules import (
    BASELINE, DEFAULT_RULES, NEIGHBOURS, RUNS, VELOCITY, WINDOWED, FlagRule, Rule,
)
from tallywatch.plans import history
from tallywatch.plans.hot import Split
from tallywatch.plans.state import with_state

Rules = tuple[Rule | FlagRule, ...]


def features(tx: DataFrame, needs: set[str], limits: RuleLimits = RuleLimits(), split: Split | None = None,
             state: DataFrame | None = None) -> DataFrame:
    """Clean transactions with the history columns the named parts provide; ``state``
    holds each customer's amounts before these transactions, if there are any."""
    if not needs:
        return tx
    h = history.start(tx, limits, split, velocity=VELOCITY in needs, windowed=WINDOWED in needs)
    if VELOCITY in needs:
        h = h.add_velocity()
    if WINDOWED in needs:
        h = h.add_failure_windows()
    h = h.rows_only()
    if NEIGHBOURS in needs or RUNS in needs:
        h = h.add_neighbours()
    if BASELINE in needs:
        h = h.add_baseline()
    if RUNS in needs:
        h = h.add_failure_runs()
    return with_state(h.df, state, split) if state is not None and BASELINE in needs else h.df


def flagged(tx: DataFrame, rules: Rules = DEFAULT_RULES, limits: RuleLimits = RuleLimits(),
            split: Split | None = None, state: DataFrame | None = None) -> DataFrame:
    """Each transaction with ``n_i`` flags and sorted distinct reasons ``r_i`` of the
    i-th rule, NULL without flags. Expression rules add no shuffle; each ``FlagRule`` adds one aggregate
    and one join on the unique ingest sequence."""
    written = {i: r for i, r in enumerate(rules) if isinstance(r, Rule)}
    df = features(tx, {n for r in written.values() for n in r.needs}, limits, split, state)
    flags = [f"CAST({r.flags(limits)} AS BIGINT) AS n_{i}" for i, r in written.items()]
    reasons = [f"CASE WHEN n_{i} > 0 THEN {_distinct(r.reasons(limits))} END AS r_{i}" for i, r in written.items()]
    rest = [c for c in df.columns if c not in tx.columns]
    df = df.selectExpr(*tx.columns, *rest, *flags).selectExpr(*tx.columns, *[f"n_{i}" for i in written], *reasons)
    for i, rule in enumerate(rules):
        if isinstance(rule, FlagRule):
            found = aggregate(rule.detect(tx), ["ingest_seq"], f"count(*) AS n_{i}",
                              f"array_sort(collect_set(reason)) AS r_{i}")
            df = df.join(found, "ingest_seq", "left").selectExpr(*df.columns, f"coalesce(n_{i}, 0L) AS n_{i}", f"r_{i}")
    return df


def _distinct(texts: list[str]) -> str:
    listed = f"array({', '.join(texts)})"
    return listed if len(texts) == 1 else f"array_sort(array_distinct(array_compact({listed})))"


def bucket(score: str, policy: ScoringPolicy = ScoringPolicy()) -> str:
    return f"CASE WHEN {score} >= {policy.high_from} THEN 'High' WHEN {score} >= {policy.medium_from} THEN 'Medium' ELSE 'Low' END"


def score(tx: DataFrame, rules: Rules = DEFAULT_RULES, policy: ScoringPolicy = ScoringPolicy(),
          limits: RuleLimits = RuleLimits(), split: Split | None = None, state: DataFrame | None = None) -> DataFrame:
    """Score, bucket, triggered rules and reasons of every transaction. A rule's
    weight counts once per flag; the columns of ``tx`` are kept."""
    total = " + ".join(f"n_{i} * {int(policy.weights[r.name])}L" for i, r in enumerate(rules)) or "0L"
    by_name = {name: " OR ".join(f"n_{i} > 0" for i, r in enumerate(rules) if r.name == name)
               for name in sorted({r.name for r in rules})}
    names = ", ".join(f"CASE WHEN {fired} THEN {quoted(name)} END" for name, fired in by_name.items())
    reasons = ", ".join(f"r_{i}" for i in range(len(rules)))
    return flagged(tx, rules, limits, split, state).selectExpr(
        *tx.columns,
        f"{total} AS fraud_risk_score",
        f"{bucket(f'({total})', policy)} AS risk_bucket",
        f"concat_ws(';', {names}) AS triggered_rules",
        f"concat_ws(' | ', {reasons}) AS reasons",
    )


def all_flags(tx: DataFrame, rules: Rules = DEFAULT_RULES, policy: ScoringPolicy = ScoringPolicy(),
              limits: RuleLimits = RuleLimits(), split: Split | None = None) -> DataFrame:
    """One row per flag, with the rule's name and weight. Many flags of one row are
    spelled out in portions, so that no single array grows with them."""
    portion = 10_000
    per_rule = ", ".join(
        f"struct({quoted(r.name)} AS rule_name, {int(policy.weights[r.name])}L AS weight, n_{i} AS _n)"
        for i, r in enumerate(rules))
    return (
        flagged(tx, rules, limits, split)
        .selectExpr(*tx.columns, f"inline(array({per_rule}))")
        .where("_n > 0")
        .selectExpr("*", f"explode(sequence(0L, (_n - 1) div {portion})) AS _portion")
        .selectExpr(*tx.columns, "rule_name", "weight",
                    f"explode(array_repeat(0, CAST(least({portion}L, _n - _portion * {portion}) AS INT))) AS _flag")
        .drop("_flag")
    )


def flag_reasons(tx: DataFrame, rules: Rules = DEFAULT_RULES, limits: RuleLimits = RuleLimits(),
                 split: Split | None = None) -> DataFrame:
    """One row per distinct reason of a transaction."""
    per_rule = ", ".join(f"struct({quoted(r.name)} AS rule_name, r_{i} AS _texts)" for i, r in enumerate(rules))
    return (
        flagged(tx, rules, limits, split)
        .selectExpr(*tx.columns, f"inline(array({per_rule}))")
        .selectExpr(*tx.columns, "rule_name", "explode(_texts) AS reason")
    )


def trigger_counts(tx: DataFrame, rules: Rules = DEFAULT_RULES, limits: RuleLimits = RuleLimits(),
                   split: Split | None = None) -> DataFrame:
    """Flags and flagged transactions per rule, added up before any exchange."""
    measures = [m for i in range(len(rules))
                for m in (f"coalesce(sum(n_{i}), 0L) AS f_{i}", f"count_if(n_{i} > 0) AS t_{i}")]
    rows = ", ".join(f"struct({quoted(r.name)} AS rule_name, f_{i} AS n_flags, t_{i} AS n_transactions)"
                     for i, r in enumerate(rules))
    return aggregate(flagged(tx, rules, limits, split), [], *measures).selectExpr(f"inline(array({rows}))")


def scores_table(scores: DataFrame, run_ts: str) -> DataFrame:
    """Scores in the published layout."""
    return scores.selectExpr(
        "transaction_id", "customer_id", "amount", "fraud_risk_score", "risk_bucket", "triggered_rules", "reasons",
        f"{run_ts} AS run_ts", "ingest_seq", "to_date(transaction_ts) AS transaction_date")
