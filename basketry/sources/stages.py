"""Datasets, per-week stage tables and the submission file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import Dataset


def save_dataset(data: Dataset, folder: str, mode: str = "overwrite") -> None:
    """Three parquet tables. Transactions are sorted by date, so that the statistics of their row
    groups let date filters skip the rest; a busy day is spread over files by customer and item.
    """
    keys = [c for c in ("t_dat", "customer_id", "article_id") if c in data.inter.columns]
    inter = data.inter.repartitionByRange(*keys).sortWithinPartitions(*keys)
    data.user.write.mode(mode).parquet(f"{folder}/user.parquet")
    data.item.write.mode(mode).parquet(f"{folder}/item.parquet")
    inter.write.mode(mode).parquet(f"{folder}/inter.parquet")


def load_dataset(spark: SparkSession, folder: str) -> Dataset:
    """Raises ``AnalysisException`` when the folder does not exist."""
    return Dataset(
        user=spark.read.parquet(f"{folder}/user.parquet"),
        item=spark.read.parquet(f"{folder}/item.parquet"),
        inter=spark.read.parquet(f"{folder}/inter.parquet"),
    )


def save_week(df: DataFrame, path: str, week: int | None = None) -> None:
    """Write a stage table partitioned by week; only the weeks in ``df`` are replaced."""
    if week is not None:
        df = df.withColumn("week", F.lit(week))
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("week").parquet(path))


def load_weeks(spark: SparkSession, path: str, weeks: list[int] | None = None) -> DataFrame:
    """Read a stage table; the week filter prunes partitions."""
    df = spark.read.parquet(path)
    return df if weeks is None else df.filter(F.col("week").isin(weeks))


def write_submission(df: DataFrame, path: str) -> None:
    df.select("customer_id", "prediction").write.mode("overwrite").option("header", True).csv(path)
