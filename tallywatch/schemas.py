"""Fixed table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(38, 9)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# The eight business fields, as text (CSV) and typed.
FIELDS = (
    "transaction_id", "customer_id", "amount", "currency",
    "merchant", "country", "transaction_ts", "status",
)
TRANSACTION_TEXT = _schema(*[(name, T.StringType()) for name in FIELDS])

TRANSACTIONS_CLEAN = _schema(
    ("transaction_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("amount", AMOUNT),
    ("currency", T.StringType()),
    ("merchant", T.StringType()),
    ("country", T.StringType()),
    ("transaction_ts", T.TimestampType()),
    ("status", T.StringType()),
)
TRANSACTIONS_RAW = T.StructType(
    TRANSACTIONS_CLEAN.fields + [T.StructField("load_ts", T.TimestampType(), True)]
)

DQ_ISSUES = _schema(
    ("check_name", T.StringType()),
    ("severity", T.StringType()),
    ("affected_row_count", T.LongType()),
    ("total_row_count", T.LongType()),
    ("affected_pct", T.DoubleType()),
    ("threshold_pct", T.DoubleType()),
    ("passed", T.BooleanType()),
    ("run_ts", T.TimestampType()),
)

FRAUD_SCORES = _schema(
    ("transaction_id", T.StringType()),
    ("customer_id", T.StringType()),
    ("amount", AMOUNT),
    ("fraud_risk_score", T.LongType()),
    ("risk_bucket", T.StringType()),
    ("triggered_rules", T.StringType()),
    ("reasons", T.StringType()),
    ("run_ts", T.TimestampType()),
    ("ingest_seq", T.LongType()),
    ("transaction_date", T.DateType()),
)

DQ_HEALTH_TREND = _schema(("run_date", T.DateType()), ("pass_rate", T.DoubleType()))

# What the curated tables are kept up to date from: one row per run, and one per date, day of scoring and bucket.
CHECK_COUNTS = _schema(
    ("run", T.DateType()), ("run_date", T.DateType()), ("n_passed", T.LongType()), ("n_checks", T.LongType()),
)
BUCKET_COUNTS = _schema(
    ("transaction_date", T.DateType()), ("run_date", T.DateType()), ("risk_bucket", T.StringType()),
    ("n", T.LongType()), ("max_score", T.LongType()),
)

FRAUD_BUCKET_DISTRIBUTION = _schema(
    ("run_date", T.DateType()), ("risk_bucket", T.StringType()), ("n", T.LongType())
)
