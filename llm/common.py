"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import ctypes.util
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
from pyspark.sql import DataFrame, SparkSession

#: Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def stage_folder(spark: SparkSession) -> str:
    """The shared folder of the session; only a session without the setting (tests) gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="stages-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def durable(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def trim() -> None:
    """Gives this process's free memory back to the system."""
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim_heap = getattr(ctypes.CDLL(ctypes.util.find_library("c")), "malloc_trim", None)
    if trim_heap is not None:
        trim_heap(0)


def lean(run: Callable) -> Callable:
    """A function over batches that gives its worker's free memory back when a task ends: workers live on between tasks, and
    several share one executor."""
    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        trim()

    return wrapped


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of at most ``limit`` in total; a larger item stands alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` of all i in a row."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
