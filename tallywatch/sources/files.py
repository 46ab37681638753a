"""Reading and writing transaction files."""

from __future__ import annotations

import csv
import datetime as dt
import io
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from tallywatch.functions.columns import quoted, timestamp
from tallywatch.schemas import FIELDS, TRANSACTION_TEXT
from tallywatch.sources.csv_records import records

# Ingest sequence: day of the load above Spark's own row number, which holds the input
# partition above 33 bits for the row in it. More partitions than fit are read together.
NUMBER_BITS, PARTITIONS = 49, 1 << 16
FIRST_DAY = "DATE'2000-01-01'"


def load_path(root: str, run_date: dt.date) -> str:
    return f"{root}/transactions/{run_date.isoformat()}"


CORRUPT = "_corrupt_record"
# Different headers that the files of one load may have.
MOST_HEADERS = 200


def _headers(records: DataFrame) -> DataFrame:
    """file, header, and the place (at) of the header's record: the first of each file."""
    first = F.min_by(F.struct("record", "at"), F.struct("block", "at"))
    # The first record that isn't blank starts in a file's first split, but for files that begin with many blank lines.
    return records.groupBy("file").agg(first.alias("first")).selectExpr(
        "file", "regexp_replace(first.record, '^\\uFEFF', '') AS header", "first.at AS header_at")


def csv_rows(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The eight fields as text, taken by header name, and the line of a broken record.

    Columns may stand in any order, in each file its own; further ones are ignored and
    missing ones are NULL; quotes double inside quoted fields. A line with more or fewer
    fields than the header is broken. ``multi_line`` allows line feeds in quoted fields;
    large files are split either way. Headers are found by the executors; the driver
    sees the different ones, at most MOST_HEADERS.
    """
    found = records(spark, path, multi_line)
    headers = _headers(found)
    kinds = [r.header for r in headers.select("header").distinct().orderBy("header").limit(MOST_HEADERS + 1).collect()]
    if len(kinds) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers below {path}")
    # One row a file: Spark sees its size when it joins.
    rows = found.join(headers, "file").where("NOT at <=> header_at")
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    listed = ", ".join(f"'{k}', {quoted(v)}" for k, v in options.items())
    read = []
    for kind in kinds:
        names = next(csv.reader(io.StringIO(kind, newline=""), doublequote=True))
        schema = ", ".join([*(f"_{i} STRING" for i in range(len(names))), f"{CORRUPT} STRING"])
        parsed = rows.where(F.col("header") == kind).selectExpr(f"from_csv(record, {quoted(schema)}, map({listed})) AS r")
        places = {n.lower(): i for i, n in reversed(list(enumerate(names)))}
        read.append(parsed.selectExpr(
            *[f"r._{places[f]} AS {f}" if f in places else f"CAST(NULL AS STRING) AS {f}" for f in FIELDS], f"r.{CORRUPT} AS {CORRUPT}"))
    if not read:
        nothing = T.StructType([*TRANSACTION_TEXT.fields, T.StructField(CORRUPT, T.StringType())])
        return spark.createDataFrame([], nothing)
    return reduce(DataFrame.unionByName, read)


def read_csv(spark: SparkSession, path: str, multi_line: bool = True, keep_broken: bool = False) -> DataFrame:
    """Transactions as text; ``rejected_csv`` has the lines left out. ``keep_broken`` keeps
    those too, with the fields they lack as NULL and further ones ignored, for the checks."""
    kept = "true" if keep_broken else f"{CORRUPT} IS NULL"
    return csv_rows(spark, path, multi_line).where(kept).select(*FIELDS)


def rejected_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The broken records as far as they were read, and their whole lines, to be kept and counted."""
    return csv_rows(spark, path, multi_line).where(f"{CORRUPT} IS NOT NULL").withColumnRenamed(CORRUPT, "line")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*FIELDS)


def typed(rows: DataFrame, run_date: dt.date, load_ts: dt.datetime, wall_clock: bool = False) -> DataFrame:
    """Raw transactions with types, load time and ingest sequence.

    What does not parse becomes NULL and is counted as missing; times without an
    offset are UTC. ``wall_clock`` also keeps the hour as written.
    """
    day = f"datediff(DATE'{run_date.isoformat()}', {FIRST_DAY})"
    seq = f"shiftleft(CAST({day} AS BIGINT), {NUMBER_BITS}) + monotonically_increasing_id()"
    is_text = isinstance(rows.schema["transaction_ts"].dataType, T.StringType)
    hour = ["hour(try_cast(transaction_ts AS TIMESTAMP_NTZ)) AS wall_clock_hour"] if wall_clock and is_text else []
    kinds = {"amount": "DECIMAL(38,9)", "transaction_ts": "TIMESTAMP"}
    columns = [f"try_cast({f} AS {kinds[f]}) AS {f}" if f in kinds else f for f in FIELDS]
    return rows.coalesce(PARTITIONS).selectExpr(
        *columns, *hour, f"{timestamp(load_ts)} AS load_ts", f"{seq} AS ingest_seq")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'").csv(path)
