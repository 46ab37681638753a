"""What the operators share: worker set-up, tables kept in the shared folder, Arrow columns as numpy."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Arrow batches handed to Python: so many rows and bytes at most, so that long texts don't add up.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, and bound what one Arrow batch holds."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is set and all run on one machine, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def saved(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now; it does so when the JVM collects its garbage.

    The second round finds what the first has let go: frames are held from Python, plans by frames.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def texts_of(docs: DataFrame, *columns: str) -> DataFrame:
    """The columns and the text, null as empty."""
    return docs.select(*columns, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def rowed(docs: DataFrame) -> DataFrame:
    """row (all columns but the text), doc_id, text (null as empty): names that no further column of docs can clash with."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def unrowed(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs from row and text."""
    return rows.select(*(F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings one after the other, and n + 1 offsets into them."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0]: at[-1]], at - at[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 on unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
