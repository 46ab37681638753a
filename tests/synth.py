"""Synthetic transactions with known defects, drawn from a column of row numbers.

All randomness is arithmetic on the row number and a seed, so a lost task redraws
the same rows and an exact copy is an exact copy.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.config import HOME_CURRENCY, MERCHANTS
from tallywatch.functions.columns import HOUR_US, MINUTE_US, lookup, padded, pick, timestamp

PRIME = 2_147_483_647
DAYS = 30
CUSTOMERS = 400
COPIES = 15


def draw(n: str, stream: int, seed: int) -> str:
    """A whole number in [0, PRIME) for each row number and stream."""
    x = f"(({n} * 7919 + {104_729 * stream + seed}) % {PRIME} * 48271 % {PRIME})"
    return f"({x} * ({x} % 65521 + 1) % {PRIME} * 69621 % {PRIME})"


def uniform(n: str, stream: int, seed: int) -> str:
    return f"({draw(n, stream, seed)} / {PRIME}D)"


def transactions(numbers: DataFrame, as_of: dt.datetime, seed: int = 42, customers: int = CUSTOMERS) -> DataFrame:
    """One transaction per row number ``n`` (from 1), over the days before ``as_of``."""
    now = f"unix_micros({timestamp(as_of)})"
    country = pick(HOME_CURRENCY, f"{draw('n', 3, seed)} % {len(HOME_CURRENCY)}")
    return numbers.selectExpr(
        "n AS ingest_seq",
        f"{padded('TXN', 'n', 6)} AS transaction_id",
        f"{padded('CUST', f'({draw("n", 1, seed)} % {customers} + 1)', 4)} AS customer_id",
        f"CAST(round(exp({uniform('n', 2, seed)} * 4 + 2), 2) AS DECIMAL(38,9)) AS amount",
        f"{lookup(HOME_CURRENCY, country)} AS currency",
        f"{pick(MERCHANTS, f'{draw("n", 4, seed)} % {len(MERCHANTS)}')} AS merchant",
        f"{country} AS country",
        f"timestamp_micros({now} - {draw('n', 5, seed)} % {DAYS * 24 * 60} * {MINUTE_US}) AS transaction_ts",
        f"CASE WHEN {uniform('n', 6, seed)} < 0.05D THEN 'failed' ELSE 'success' END AS status",
    )


def with_defects(tx: DataFrame, as_of: dt.datetime, seed: int = 42, copies: int = COPIES) -> DataFrame:
    """Inject defects: 1 % without customer, 0.5 % negative, 0.6 % with a bad currency,
    1 % with EUR, 0.3 % in the future, and ``copies`` rows loaded twice."""
    n = "ingest_seq"
    later = f"timestamp_micros(unix_micros({timestamp(as_of)}) + ({draw(n, 16, seed)} % 500 + 1) * {HOUR_US})"
    bad = tx.selectExpr(
        n, "transaction_id",
        f"CASE WHEN {uniform(n, 11, seed)} >= 0.01D THEN customer_id END AS customer_id",
        f"CASE WHEN {uniform(n, 12, seed)} < 0.005D THEN -amount ELSE amount END AS amount",
        f"CASE WHEN {uniform(n, 13, seed)} < 0.006D THEN 'XYZ' WHEN {uniform(n, 14, seed)} < 0.01D THEN 'EUR'"
        " ELSE currency END AS currency",
        "merchant", "country",
        f"CASE WHEN {uniform(n, 15, seed)} < 0.003D THEN {later} ELSE transaction_ts END AS transaction_ts",
        "status",
    )
    twice = bad.orderBy(F.expr(draw(n, 17, seed)), n).limit(copies)
    return bad.unionByName(twice)
