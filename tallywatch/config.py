"""Policy values: lookups, rule limits, weights, buckets and the hot-key limits."""

from __future__ import annotations

from dataclasses import dataclass, field

# They must match the checked and scored results.
REQUIRED_FIELDS = (
    "transaction_id", "customer_id", "amount", "currency", "transaction_ts", "status",
)
VALID_CURRENCIES = ("USD", "EUR", "GBP", "INR", "JPY", "AUD")
HOME_CURRENCY = {
    "US": "USD", "GB": "GBP", "DE": "EUR", "IN": "INR",
    "JP": "JPY", "AU": "AUD", "FR": "EUR", "SG": "USD",
}
MERCHANTS = (
    "Amazon", "Walmart", "Target", "BestBuy", "Starbucks",
    "Uber", "Netflix", "Apple", "IKEA", "Shell",
)
BUCKETS = ("Low", "Medium", "High")
WEIGHTS = {
    "velocity": 25,
    "amount_anomaly": 30,
    "geo_impossible_travel": 35,
    "repeated_failure_cardtesting": 30,
    "odd_hour": 10,
}
# Fixed phrases of the reasons, which must match the scored results; braces are values.
PHRASES = {
    "velocity": "{n} transactions by {customer} within {minutes} min (threshold: >{over})",
    "amount": "amount {amount} is {z} std devs above {customer}'s rolling average of {mean} (n={n} prior txns)",
    "travel": "{customer} transacted in {first} then {second} only {gap} min apart (threshold: <{minutes} min)",
    "failures": "{n} failed transactions by {customer} within {minutes} min windows (card-testing pattern, threshold: >={least})",
    "after_run": "success followed a {n}-failure card-testing cluster within {gap} min",
    "after_cluster": "success followed a card-testing failure cluster by {customer} within {minutes} min",
    "odd_hour": "transaction at {hour}:00 local (odd-hour window: {first}-{last}am) {dash} weak signal, contributing factor only",
}


@dataclass(frozen=True)
class RuleLimits:
    """Limits of the five built-in rules."""

    velocity_over: int = 5
    velocity_minutes: int = 3
    sigma_over: float = 3.0
    min_history: int = 4
    travel_under_minutes: int = 120
    min_failures: int = 2
    failure_minutes: int = 2
    success_minutes: int = 2
    odd_hour_first: int = 1
    odd_hour_last: int = 4
    wall_clock_hours: bool = False


@dataclass(frozen=True)
class ScoringPolicy:
    """Rule weights and the lower score limits of the upper two buckets."""

    weights: dict[str, int] = field(default_factory=lambda: dict(WEIGHTS))
    medium_from: int = 25
    high_from: int = 50


@dataclass(frozen=True)
class HotKeyPolicy:
    """When to split a customer's history over several tasks.

    A customer is split once it holds more than ``max(min_rows, rows / max_blocks)``
    rows, so there are never more than a few times ``max_blocks`` pieces in all:
    that bounds the split points held by the driver and the tables broadcast.
    """

    min_rows: int = 1_000_000
    max_blocks: int = 65_536
    samples_per_block: int = 16


# An id with more copies than this, and more than one in HOT_IDS of all repeated copies, is hot: fewer than HOT_IDS ids
# are, whatever the table's size, so their list may be broadcast.
HOT_COPIES = 1_000_000
HOT_IDS = 10_000
