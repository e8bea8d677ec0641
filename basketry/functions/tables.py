"""Stage tables: results written once so that later steps do not recompute them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for stage tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without the setting gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="basketry-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative Spark ML trainers cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage and survives the loss of executors; later readers prune columns from it.
    """
    path = f"{checkpoint_root(df.sparkSession).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
