"""Transactions of known fraud patterns, put among others to evaluate the rules.

Some transactions, chosen by remainders of ``event_id``, draw further ones of the same customer after them: a burst, an
amount far above, a stop in another country, a cluster of failures, an odd hour. The labels are a table of their own
and never reach the rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallywatch.functions.columns import MINUTE_US

SECOND_US = MINUTE_US // 60
#: pattern -> (which transactions draw it, how many, microseconds after the drawing one, the first and each further)
PATTERNS = {
    "velocity": ("event_id % 53 = 40", 8, 20 * SECOND_US, 20 * SECOND_US),
    "amount_anomaly": ("event_id % 59 = 41", 1, 60 * MINUTE_US, 0),
    "geo_impossible_travel": ("event_id % 61 = 42", 1, 40 * MINUTE_US, 0),
    "repeated_failure_cardtesting": ("event_id % 67 = 43", 3, 10 * MINUTE_US, 30 * SECOND_US),
    "odd_hour": ("event_id % 71 = 44", 1, 0, 0),
}


def injected(clean: DataFrame) -> DataFrame:
    """Further transactions drawn by clean ones, with their ``pattern``; columns of ``clean``, a unique negative ``ingest_seq``."""
    drawn = ", ".join(
        f"CASE WHEN {chosen} THEN transform(sequence(1, {n}), k -> named_struct('pattern', '{name}', 'i', {i}, 'k', k,"
        f" 'later', {first}L + (k - 1) * {step}L)) ELSE array() END"
        for i, (name, (chosen, n, first, step)) in enumerate(PATTERNS.items()))
    made = {
        "transaction_id": "concat('INJ', event_id, '-', made.i, '-', made.k)",
        "amount": "CASE WHEN made.pattern = 'amount_anomaly' THEN CAST(CAST(amount AS DECIMAL(18,9)) * 20 AS DECIMAL(38,9)) ELSE amount END",
        "country": "CASE WHEN made.pattern <> 'geo_impossible_travel' THEN country WHEN country = 'US' THEN 'GB' ELSE 'US' END",
        "transaction_ts": "CASE WHEN made.pattern = 'odd_hour' THEN date_trunc('DAY', transaction_ts) + INTERVAL 150 MINUTE"
                          " ELSE timestamp_micros(unix_micros(transaction_ts) + made.later) END",
        "status": "CASE WHEN made.pattern = 'repeated_failure_cardtesting' THEN 'failed' ELSE 'success' END",
        "ingest_seq": "-1L - (ingest_seq * 64 + made.i * 8 + made.k - 1)",
    }
    return clean.selectExpr("*", f"explode(concat({drawn})) AS made").selectExpr(
        *[f"{made[c]} AS {c}" if c in made else c for c in clean.columns], "made.pattern AS pattern")
