"""A customer's own purchases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions.calendar import Day, last_or
from ...functions.skew import salted_lookup, top_rows
from ...functions.stats import tie_key
from .base import PersonalRule, labelled
from .decay import horizon, sale_values

MIN_VALUE = 150


@dataclass(frozen=True)
class OrderHistory(PersonalRule):
    """Items bought within ``days`` of the customer's own last purchase; the latest score highest."""

    trans: DataFrame
    days: int = 7
    n: float | None = None
    name: str = "1"
    item_id: str = "article_id"

    def retrieve(self) -> DataFrame:
        rows = self.trans.filter(F.col("customer_id").isNotNull())
        latest = rows.groupBy("customer_id", self.item_id).agg(F.max("t_dat").alias("t_dat"))
        # at most one row per customer and item from here on
        last = F.max("t_dat").over(Window.partitionBy("customer_id"))
        recent = latest.withColumn("_gap", F.datediff(last, "t_dat")).filter(
            (F.col("_gap") < self.days) & F.col(self.item_id).isNotNull())
        if self.n is not None:
            recent = top_rows(recent, "customer_id", [F.col("_gap"), F.col(self.item_id)], self.n)
        return labelled(recent.withColumn("score", -F.col("_gap")), self.item_id, f"OrderHistory_{self.name}")


@dataclass(frozen=True)
class OrderHistoryDecay(PersonalRule):
    """Own purchases weighted by age and by the item's current sales; small values are left out."""

    trans: DataFrame
    days: int = 7
    n: float | None = None
    name: str = "1"
    item_id: str = "article_id"
    last_date: Day | None = None

    def values(self) -> DataFrame:
        """(customer_id, item, score) before the threshold; pairs worth nothing are absent."""
        last = last_or(self.trans, self.last_date)
        paying = self.trans.filter(F.col("t_dat") > F.date_sub(last, horizon(self.days)))
        value = sale_values(paying, self.days, last, self.item_id).filter(F.col("value") > 0)
        own = (paying.filter(F.col("customer_id").isNotNull() & F.col(self.item_id).isNotNull())
               .groupBy("customer_id", self.item_id, "t_dat").agg(F.count(F.lit(1)).alias("_n")))
        priced = salted_lookup(
            own, value.select(self.item_id, "t_dat", "value"), [self.item_id, "t_dat"], "customer_id", "inner")
        return priced.groupBy("customer_id", self.item_id).agg(
            F.sum(F.col("_n") * F.col("value")).alias("score"))

    def retrieve(self) -> DataFrame:
        kept = self.values().filter(F.col("score") > MIN_VALUE)
        if self.n is not None:
            kept = top_rows(kept, "customer_id", [tie_key("score").desc(), F.col(self.item_id)], self.n)
        return labelled(kept, self.item_id, f"OrderHistoryDecay_{self.name}")
