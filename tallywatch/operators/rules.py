"""The fraud rules, as expressions over a customer's ordered history.

A rule says what it needs from the history, how many flags it puts on a row and the
reason text of each, all as SQL text. Rules of any other shape are ``FlagRule``: a
function from the transactions to one row per flag.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallywatch.config import PHRASES, RuleLimits
from tallywatch.functions import moments
from tallywatch.functions.columns import (
    MINUTE_US, money_text, mean_text, phrase, rounded_minutes, tenths_text, whole_minutes,
)

VELOCITY, BASELINE, NEIGHBOURS, RUNS, WINDOWED = "velocity", "baseline", "neighbours", "runs", "windowed"


@dataclass(frozen=True)
class Rule:
    """``flags`` counts the row's flags; ``reasons`` are texts, NULL where not flagged."""

    name: str
    flags: Callable[[RuleLimits], str]
    reasons: Callable[[RuleLimits], list[str]]
    needs: tuple[str, ...] = ()


@dataclass(frozen=True)
class FlagRule:
    """``detect`` returns one row per flag: ingest_seq, reason."""

    name: str
    detect: Callable[[DataFrame], DataFrame]


def one_if(condition: str) -> str:
    return f"CAST(coalesce({condition}, false) AS BIGINT)"


def told_if(condition: str, name: str, plain: dict[str, object] | None = None, **values: str) -> str:
    """The phrase where the condition holds: plain values as they are, others as SQL expressions."""
    return f"CASE WHEN {condition} THEN {phrase(PHRASES[name], plain or {}, values)} END"


# -- velocity ----------------------------------------------------------------------
def too_fast(limits: RuleLimits) -> str:
    return f"(n_velocity > {limits.velocity_over})"


def _velocity_reasons(limits: RuleLimits) -> list[str]:
    plain = {"minutes": limits.velocity_minutes, "over": limits.velocity_over}
    return [told_if(too_fast(limits), "velocity", plain, n="n_velocity", customer="customer_id")]


# -- amount anomaly ----------------------------------------------------------------
def unusual_amount(limits: RuleLimits) -> str:
    return f"(n_prior >= {limits.min_history} AND {moments.z_above(limits.sigma_over)})"


def _amount_reasons(limits: RuleLimits) -> list[str]:
    return [told_if(
        unusual_amount(limits), "amount", amount=money_text("amount"), z=tenths_text(moments.Z), customer="customer_id",
        mean=mean_text(moments.TOTAL, "n_prior", moments.MEAN), n="n_prior")]


# -- impossible travel ---------------------------------------------------------------
GAP_BEFORE, GAP_AFTER = "(key - prev.key)", "(next.key - key)"


def travelled(other: str, gap: str, limits: RuleLimits) -> str:
    """Is the neighbour in another country, too close in time?"""
    return f"({other}.country <> country AND {gap} < {limits.travel_under_minutes * MINUTE_US})"


def arrived(limits: RuleLimits) -> str:
    return travelled("prev", GAP_BEFORE, limits)


def left(limits: RuleLimits) -> str:
    return travelled("next", GAP_AFTER, limits)


def travel_flags(limits: RuleLimits) -> str:
    return f"({one_if(arrived(limits))} + {one_if(left(limits))})"


def _travel_reasons(limits: RuleLimits) -> list[str]:
    def trip(condition: str, first: str, second: str, gap: str) -> str:
        return told_if(condition, "travel", {"minutes": limits.travel_under_minutes}, customer="customer_id",
                       first=first, second=second, gap=whole_minutes(gap))

    return [trip(arrived(limits), "prev.country", "country", GAP_BEFORE),
            trip(left(limits), "country", "next.country", GAP_AFTER)]


# -- repeated failures, as runs of adjacent failures ----------------------------------
def in_run(limits: RuleLimits) -> str:
    return f"(run_size >= {limits.min_failures})"


def after_run(limits: RuleLimits) -> str:
    return f"(follows_run >= {limits.min_failures})"


def _failed_text(condition: str, n: str, limits: RuleLimits) -> str:
    return told_if(condition, "failures", {"minutes": limits.failure_minutes, "least": limits.min_failures},
                   n=n, customer="customer_id")


def _run_reasons(limits: RuleLimits) -> list[str]:
    followed = told_if(after_run(limits), "after_run", n="follows_run", gap=rounded_minutes("follows_us"))
    return [_failed_text(in_run(limits), "run_size", limits), followed]


# -- repeated failures, as windows ----------------------------------------------------
def in_cluster(limits: RuleLimits) -> str:
    return f"(n_failures >= {limits.min_failures})"


def _window_reasons(limits: RuleLimits) -> list[str]:
    followed = told_if("n_clusters > 0", "after_cluster", {"minutes": limits.failure_minutes}, customer="customer_id")
    return [_failed_text(in_cluster(limits), "n_failures", limits), followed]


# -- odd hour --------------------------------------------------------------------------
def hour_of(limits: RuleLimits) -> str:
    """The UTC hour, or the hour on the clock as written where the load kept it."""
    utc = "hour(transaction_ts)"
    return f"coalesce(wall_clock_hour, {utc})" if limits.wall_clock_hours else utc


def at_odd_hour(limits: RuleLimits) -> str:
    return f"({hour_of(limits)} BETWEEN {limits.odd_hour_first} AND {limits.odd_hour_last})"


def _odd_hour(dash: str) -> Rule:
    def reasons(limits: RuleLimits) -> list[str]:
        plain = {"first": limits.odd_hour_first, "last": limits.odd_hour_last, "dash": dash}
        return [told_if(at_odd_hour(limits), "odd_hour", plain, hour=f"lpad(CAST({hour_of(limits)} AS STRING), 2, '0')")]

    return Rule("odd_hour", lambda m: one_if(at_odd_hour(m)), reasons)


_VELOCITY = Rule("velocity", lambda m: one_if(too_fast(m)), _velocity_reasons, (VELOCITY,))
_AMOUNT = Rule("amount_anomaly", lambda m: one_if(unusual_amount(m)), _amount_reasons, (BASELINE,))
_TRAVEL = Rule("geo_impossible_travel", travel_flags, _travel_reasons, (NEIGHBOURS,))
_RUNS = Rule("repeated_failure_cardtesting", lambda m: one_if(f"{in_run(m)} OR {after_run(m)}"), _run_reasons,
             (NEIGHBOURS, RUNS))
_WINDOWS = Rule("repeated_failure_cardtesting", lambda m: f"{one_if(in_cluster(m))} + coalesce(n_clusters, 0L)",
                _window_reasons, (WINDOWED,))

DEFAULT_RULES: tuple[Rule, ...] = (_VELOCITY, _AMOUNT, _TRAVEL, _RUNS, _odd_hour("—"))
# Failures counted in windows, each success flagged once per cluster it follows.
WINDOWED_RULES: tuple[Rule, ...] = (_VELOCITY, _AMOUNT, _TRAVEL, _WINDOWS, _odd_hour("--"))
