"""Transactions derived from the ``events`` table.

Every user-day is squeezed into six minutes at a shifting hour, and defects are set
by remainders of ``event_id``, so that each check and each rule finds rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tallywatch.config import HOME_CURRENCY, MERCHANTS
from tallywatch.functions.columns import DAY_US, HOUR_US, lookup, padded, pick, timestamp

AS_OF = dt.datetime(2024, 2, 1, 12, 0, 0, tzinfo=dt.timezone.utc)
NOW = timestamp(AS_OF)
COUNTRIES = (*HOME_CURRENCY, "BR")

_US = "unix_micros(CAST(ts AS TIMESTAMP))"
_DAY, _IN_DAY = f"({_US} div {DAY_US})", f"({_US} % {DAY_US})"
_TIME = (
    f"{_DAY} * {DAY_US} + (user_id * 7 + {_DAY} * 5) % 24 * {HOUR_US} + {_IN_DAY} div 240000000 * 1000000"
    f" + CASE WHEN event_id % 331 = 7 THEN {60 * DAY_US} ELSE 0 END"
)
_COUNTRY = pick(COUNTRIES, f"(user_id + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END) % {len(COUNTRIES)}")
_AMOUNT = "CAST(value AS DECIMAL(38,9))"
_TRANSACTION = (
    "event_id",
    f"CASE WHEN event_id % 503 <> 1 THEN {padded('TXN', 'event_id', 9)} END AS transaction_id",
    f"CASE WHEN event_id % 101 = 17 THEN NULL WHEN event_id % 211 = 5 THEN '' ELSE {padded('CUST', 'user_id', 6)} END"
    " AS customer_id",
    f"CAST(CASE WHEN event_id % 499 = 21 THEN NULL WHEN event_id % 199 = 3 THEN -{_AMOUNT} ELSE {_AMOUNT} END"
    " AS DECIMAL(38,9)) AS amount",
    "CASE WHEN event_id % 401 = 8 THEN NULL WHEN event_id % 409 = 6 THEN '' WHEN event_id % 167 = 9 THEN 'XYZ'"
    " WHEN event_id % 173 = 4 THEN 'eur' WHEN event_id % 97 = 11 THEN 'EUR'"
    f" ELSE coalesce({lookup(HOME_CURRENCY, _COUNTRY)}, 'USD') END AS currency",
    f"{pick(MERCHANTS, f'event_id % {len(MERCHANTS)}')} AS merchant",
    f"{_COUNTRY} AS country",
    f"timestamp_micros({_TIME}) AS transaction_ts",
    "CASE WHEN event_id % 307 = 2 THEN '' WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status",
    "event_id * 2 + copy AS ingest_seq",
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def transactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw transactions, with ``event_id`` and a unique ``ingest_seq``."""
    copies = "explode(CASE WHEN event_id % 331 = 13 THEN array(0, 1) ELSE array(0) END) AS copy"
    return events(spark, sf_dir).selectExpr("*", copies).selectExpr(*_TRANSACTION)
