"""Time-decayed value of a sale, scaled by how the item sells in the latest period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# value = SLOW / sqrt(x) + FAST * exp(-RATE * x) - FLOOR, x = max(age in days, 1).
SLOW, FAST, RATE, FLOOR = 25000.0, 150000.0, 0.2, 1000.0
# From this age on the value is 0: 25000 / sqrt(625) = 1000.
HORIZON = 625


def decay(gap: Column) -> Column:
    x = F.greatest(gap, F.lit(1)).cast("double")
    return F.greatest(
        F.lit(0.0), F.lit(SLOW) / F.sqrt(x) + F.lit(FAST) * F.exp(F.lit(-RATE) * x) - F.lit(FLOOR))


def horizon(days: int) -> int:
    """First age beyond both the last paying day and the end of its period."""
    return -(-HORIZON // days) * days


def sale_values(trans: DataFrame, days: int, last: Column, item_id: str = "article_id") -> DataFrame:
    """(item, t_dat, n, value): sales of an item on a day, and what one of them is worth.

    value = decay(age) * sales in the latest period / sales in the day's period. It depends on
    item and day only, so it is computed on daily totals.
    """
    daily = (trans.filter(F.col(item_id).isNotNull())
             .groupBy(item_id, "t_dat").agg(F.count(F.lit(1)).alias("n")))
    gap = F.datediff(last, "t_dat")
    daily = daily.withColumn("_gap", gap).withColumn("_period", F.floor(F.col("_gap") / days))
    period_sale = F.sum("n").over(Window.partitionBy(item_id, "_period"))
    target = F.sum(F.when(F.col("_period") == 0, F.col("n")).otherwise(0)).over(Window.partitionBy(item_id))
    return daily.select(
        item_id, "t_dat", "n", (decay(F.col("_gap")) * (target / period_sale)).alias("value"))
