"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the time zone: hours, dates and epoch conversions are all UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
