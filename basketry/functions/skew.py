"""Joins and numbering that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import durable

SALTS = 16


def names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def salted_lookup(
    fact: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    salt_on: str | Sequence[str],
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Join ``fact`` to ``lookup`` with every key of ``fact`` spread over ``salts`` partitions.

    The salt is a hash of ``salt_on``, so a retried task sends its rows to the same place.
    The lookup is copied ``salts`` times, by a product with the salts and not by ``explode``: the
    planner takes an exploded table to be as small as before, and would broadcast all copies of a
    lookup that it reckons to be just small enough. A product it reckons to be ``8 * salts`` times
    as large. When the copies are small at run time, adaptive execution turns the join into a
    broadcast; when not, no key is bound to one task.
    """
    keys = names(on)
    left = fact.withColumn(
        "_salt", F.pmod(F.xxhash64(*names(salt_on)), F.lit(salts)).cast("int"))
    copies = lookup.sparkSession.range(0, salts, 1, 1).select(F.col("id").cast("int").alias("_salt"))
    right = lookup.crossJoin(F.broadcast(copies))  # a fixed number of rows
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def dense_index(rows: DataFrame, order_by: str | Sequence[str], index: str = "index") -> DataFrame:
    """Number ``rows`` 1, 2, 3, .. in the order of ``order_by``.

    A distributed sort numbers the rows inside each partition; the partitions' sizes (one row
    per partition of the sort) give the offsets. The sorted rows are written once, because both
    steps must see the same partitions.
    """
    ordered = durable(
        rows.orderBy(*names(order_by)).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = F.col("_id") - F.shiftleft(F.col("_part"), 33)
    return (
        ordered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per sort partition
        .withColumn(index, local + F.col("_offset") + 1)
        .drop("_part", "_id", "_offset")
    )


def top_rows(
    df: DataFrame, by: str | Sequence[str], order: Sequence[Column], n: float, rank: str = "rank"
) -> DataFrame:
    """First ``n`` rows of every group, numbered from 1 in ``rank``."""
    window = Window.partitionBy(*names(by)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= int(n))
