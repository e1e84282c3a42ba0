"""K3: a log kept for a time, as date partitions that reads prune and expiry drops."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.sources import storage

DAY = "day"


def append(df: DataFrame, path: str, ts: str = "timestamp") -> None:
    """Append rows by the day of ``ts``."""
    df.withColumn(DAY, F.to_date(F.col(ts))).write.mode("append").partitionBy(DAY).parquet(path)


def read(spark: SparkSession, path: str, newest: datetime, hours: int = 24, ts: str = "timestamp") -> DataFrame:
    """Rows younger than ``hours`` before ``newest``; only the days in question are listed for the scan."""
    oldest = newest - timedelta(hours=hours)
    rows = spark.read.parquet(path).filter((F.col(DAY) >= F.lit(oldest.date())) & (F.col(ts) > F.lit(oldest)))
    return rows.drop(DAY)


def drop_expired(spark: SparkSession, path: str, newest: datetime, hours: int = 24) -> list[str]:
    """Delete the days that end before the retention begins; returns their names."""
    first = f"{DAY}={(newest - timedelta(hours=hours)).date().isoformat()}"
    old = [n for n in storage.names(spark, path) if n.startswith(f"{DAY}=") and n < first]
    for name in old:
        storage.delete(spark, f"{path}/{name}")
    return old
