"""Building small transaction tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tallywatch.functions.columns import timestamp
from tallywatch.schemas import TRANSACTIONS_CLEAN
from pyspark.sql import types as T

NOW = dt.datetime(2025, 3, 2, tzinfo=dt.timezone.utc)
AT = timestamp(NOW)
SCHEMA = T.StructType(TRANSACTIONS_CLEAN.fields + [T.StructField("ingest_seq", T.LongType())])


def at(text: str) -> dt.datetime:
    """``10:00:00`` on the base day, or a full ISO time; UTC unless it says otherwise."""
    full = text if "-" in text else f"2025-03-01T{text}"
    when = dt.datetime.fromisoformat(full)
    return when if when.tzinfo else when.replace(tzinfo=dt.timezone.utc)


def row(transaction_id: str | None = "TXN1", ts: str | None = "10:00:00", **changes) -> dict:
    base = dict(transaction_id=transaction_id, customer_id="CUST1", amount="50.00", currency="USD", merchant="Amazon",
                country="US", transaction_ts=at(ts) if ts else None, status="success")
    return {**base, **changes}


def table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    def value(r: dict, name: str):
        return Decimal(r[name]) if name == "amount" and r[name] is not None else r[name]

    data = [tuple([value(r, f.name) for f in TRANSACTIONS_CLEAN.fields]) + (r.get("ingest_seq", i),)
            for i, r in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def series(times: list[str], **changes) -> list[dict]:
    """Numbered transactions of one customer; list values vary by row."""
    return [row(f"TXN{i + 1}", t, **{k: v[i] if isinstance(v, list) else v for k, v in changes.items()})
            for i, t in enumerate(times)]
