"""Items that sell best, or gain most, over all customers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions.calendar import Day, last_or
from ...functions.stats import tie_key
from .base import GlobalRule, labelled, serve_all
from .decay import sale_values


@dataclass(frozen=True)
class TimeHistory(GlobalRule):
    """The ``n`` items with most buyers (``unique``) or most sales."""

    customers: DataFrame
    trans: DataFrame
    n: float = 12
    name: str = "1"
    unique: bool = True
    item_id: str = "article_id"

    def ranked(self) -> DataFrame:
        rows = self.trans.filter(F.col(self.item_id).isNotNull()).select("customer_id", self.item_id)
        rows = rows.distinct() if self.unique else rows
        counts = rows.groupBy(self.item_id).agg(F.count(F.lit(1)).alias("score"))
        return counts.orderBy(F.desc("score"), self.item_id).limit(int(self.n))

    def retrieve(self) -> DataFrame:
        served = serve_all(self.customers, self.ranked(), self.item_id)
        return labelled(served, self.item_id, f"TimeHistory_{self.name}")


@dataclass(frozen=True)
class TimeHistoryDecay(GlobalRule):
    """The ``n`` items with the highest sum of decayed sale values."""

    customers: DataFrame
    trans: DataFrame
    days: int = 7
    n: float = 12
    name: str = "1"
    item_id: str = "article_id"
    last_date: Day | None = None

    def values(self) -> DataFrame:
        value = sale_values(self.trans, self.days, last_or(self.trans, self.last_date), self.item_id)
        return value.groupBy(self.item_id).agg(F.sum(F.col("n") * F.col("value")).alias("score"))

    def ranked(self) -> DataFrame:
        return self.values().orderBy(tie_key("score").desc(), self.item_id).limit(int(self.n))

    def retrieve(self) -> DataFrame:
        served = serve_all(self.customers, self.ranked(), self.item_id)
        return labelled(served, self.item_id, f"TimeHistoryDecay_{self.name}")


def sale_counts(
    trans: DataFrame, days: int, last: Column, by: list[str]
) -> DataFrame:
    """(by.., recent, previous): sales of the last ``days`` days and of the ``days`` before."""
    gap = F.datediff(last, "t_dat")
    rows = trans.filter(F.col("t_dat") > F.date_sub(last, 2 * days))
    for c in by:
        rows = rows.filter(F.col(c).isNotNull())
    return rows.groupBy(*by).agg(
        F.count_if(gap <= days - 1).alias("recent"), F.count_if(gap > days - 1).alias("previous"))


@dataclass(frozen=True)
class SaleTrend(GlobalRule):
    """Items whose sales grew by more than ``t``; items without earlier sales have no trend."""

    customers: DataFrame
    trans: DataFrame
    days: int = 7
    n: float = 12
    name: str = "1"
    t: float = 0.8
    item_id: str = "article_id"
    last_date: Day | None = None

    def ranked(self) -> DataFrame:
        counts = sale_counts(self.trans, self.days, last_or(self.trans, self.last_date), [self.item_id])
        growth = F.try_divide(F.col("recent") - F.col("previous"), F.col("previous"))
        rising = counts.withColumn("score", growth).filter(
            (F.col("recent") > 0) & (F.col("previous") > 0) & (F.col("score") > self.t))
        return rising.orderBy(F.desc("recent"), F.desc("score"), self.item_id).limit(int(self.n))

    def retrieve(self) -> DataFrame:
        served = serve_all(self.customers, self.ranked(), self.item_id)
        return labelled(served, self.item_id, f"SaleTrend_{self.name}")


def item_pool(
    trans: DataFrame, days: int, size: int = 1000, item_id: str = "article_id", last_date: Day | None = None
) -> DataFrame:
    """(item, sales, rank): best sellers of the last ``days`` days, at most ``size`` of them."""
    last = last_or(trans, last_date)
    rows = trans.filter((F.col("t_dat") > F.date_sub(last, days)) & F.col(item_id).isNotNull())
    top = (rows.groupBy(item_id).agg(F.count(F.lit(1)).alias("sales"))
           .orderBy(F.desc("sales"), item_id).limit(size))
    # numbering a list of at most ``size`` rows
    listed = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("sales")).alias("_k"), item_id))).alias("_l"))
    return listed.select(F.posexplode("_l").alias("rank", "_r")).select(
        F.col(f"_r.{item_id}").alias(item_id), (-F.col("_r._k")).alias("sales"),
        (F.col("rank") + 1).alias("rank"))
