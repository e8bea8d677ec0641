"""Ranking metrics on long tables.

``actual`` is (customer_id, article_id, n): purchases with their repetitions. ``predicted`` is
(customer_id, article_id, rank), ranks from 1. Lists never meet in one row, and a customer without
predictions counts 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _top(predicted: DataFrame, k: int) -> DataFrame:
    """First appearance of every item within the top ``k``."""
    return predicted.filter(F.col("rank") <= k).groupBy("customer_id", "article_id").agg(F.min("rank").alias("rank"))


def _hits(actual: DataFrame, predicted: DataFrame, k: int) -> DataFrame:
    return actual.join(_top(predicted, k), ["customer_id", "article_id"])


def average_precision(actual: DataFrame, predicted: DataFrame, k: int = 12) -> DataFrame:
    """(customer_id, ap) for every customer with purchases."""
    order = Window.partitionBy("customer_id").orderBy("rank")  # at most k rows
    hits = _hits(actual, predicted, k).withColumn("_nth", F.row_number().over(order))
    gains = hits.groupBy("customer_id").agg(F.sum(F.col("_nth") / F.col("rank")).alias("_gain"))
    sizes = actual.groupBy("customer_id").agg(F.sum("n").alias("_size"))
    return sizes.join(gains, "customer_id", "left").select(
        "customer_id", (F.coalesce("_gain", F.lit(0.0)) / F.least("_size", F.lit(k))).alias("ap"))


def map_at_k(actual: DataFrame, predicted: DataFrame, k: int = 12) -> DataFrame:
    return average_precision(actual, predicted, k).agg(F.avg("ap").alias("map"))


def customer_recall(actual: DataFrame, predicted: DataFrame, k: int = 12) -> DataFrame:
    """(customer_id, recall): share of purchases, repeats counted, found in the top ``k``."""
    found = _hits(actual, predicted, k).groupBy("customer_id").agg(F.sum("n").alias("_found"))
    sizes = actual.groupBy("customer_id").agg(F.sum("n").alias("_size"))
    return sizes.join(found, "customer_id", "left").select(
        "customer_id", (F.coalesce("_found", F.lit(0)) / F.col("_size")).alias("recall"))


def recall_at_k(actual: DataFrame, predicted: DataFrame, k: int = 12) -> DataFrame:
    return customer_recall(actual, predicted, k).agg(F.avg("recall").alias("recall"))


def hit_rate_at_k(actual: DataFrame, predicted: DataFrame, k: int = 10) -> DataFrame:
    hit = _hits(actual, predicted, k).select("customer_id").distinct().withColumn("_hit", F.lit(1.0))
    buyers = actual.select("customer_id").distinct()
    return buyers.join(hit, "customer_id", "left").agg(
        F.avg(F.coalesce("_hit", F.lit(0.0))).alias("hit_rate"))


def ranking_metrics(actual: DataFrame, predicted: DataFrame, k: int = 12) -> DataFrame:
    """One row (map, recall, hit_rate) from one join of purchases and predictions."""
    order = Window.partitionBy("customer_id").orderBy("rank")  # at most k rows
    hits = _hits(actual, predicted, k).withColumn("_nth", F.row_number().over(order))
    gains = hits.groupBy("customer_id").agg(
        F.sum(F.col("_nth") / F.col("rank")).alias("_gain"), F.sum("n").alias("_found"))
    sizes = actual.groupBy("customer_id").agg(F.sum("n").alias("_size"))
    return sizes.join(gains, "customer_id", "left").agg(
        F.avg(F.coalesce("_gain", F.lit(0.0)) / F.least("_size", F.lit(k))).alias("map"),
        F.avg(F.coalesce("_found", F.lit(0)) / F.col("_size")).alias("recall"),
        F.avg(F.when(F.col("_found") > 0, 1.0).otherwise(0.0)).alias("hit_rate"))
