"""Candidates of all rules: scale, remove, cut, union, pivot, combine.

Every step works on the long table of all rules at once, by the ``method`` column.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import Day, week_end, week_start
from ..functions.skew import salted_lookup
from ..functions.stats import average_rank
from ..functions.tables import durable
from .quantiles import QuantileNormal, min_max
from .rules.base import Rule


def week_labels(trans: DataFrame, week: int, anchor: Day, item_id: str = "article_id") -> DataFrame:
    """Distinct (customer_id, item) bought in a week."""
    rows = trans.filter((F.col("t_dat") >= week_start(week, anchor)) & (F.col("t_dat") < week_end(week, anchor)))
    rows = rows.filter(F.col("customer_id").isNotNull() & F.col(item_id).isNotNull())
    return rows.select("customer_id", item_id).distinct()


def remove_items(candidates: DataFrame, items: DataFrame, item_id: str = "article_id") -> DataFrame:
    """Candidates whose item is not listed; rows without an item stay.

    Rules for everybody put few items into all lists, so an item's candidates are spread by customer.
    """
    listed = items.select(item_id).distinct()
    return salted_lookup(candidates, listed, item_id, "customer_id", "left_anti").select(*candidates.columns)


def mark_labels(candidates: DataFrame, labels: DataFrame, item_id: str = "article_id") -> DataFrame:
    """Adds ``served`` (the customer has labels) and ``label`` (0/1)."""
    buyers = labels.select("customer_id").distinct().withColumn("served", F.lit(True))
    hits = labels.select("customer_id", item_id).distinct().withColumn("label", F.lit(1))
    return (candidates.join(buyers, "customer_id", "left").join(hits, ["customer_id", item_id], "left")
            .fillna({"served": False, "label": 0}))


def positive_rates(candidates: DataFrame, labels: DataFrame, item_id: str = "article_id") -> DataFrame:
    """(method, rows, positives, rate) over the customers that have labels."""
    marked = mark_labels(candidates, labels, item_id).filter("served")
    return _rates(marked)


def _rates(marked: DataFrame) -> DataFrame:
    return marked.groupBy("method").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives")
    ).withColumn("rate", F.col("positives") / F.col("rows"))


def best_cuts(ranked: DataFrame, min_rate: float) -> DataFrame:
    """(method, keep_all, best_rank): how deep to keep the list of each rule.

    ``ranked`` has the rows of label customers with ``rank`` and ``label``. A rule whose rate
    reaches ``min_rate`` keeps everything. For the others the depths max, max - 1, .. are tried
    until the rate exceeds ``min_rate``; the best depth seen wins, the deepest on ties. A rule
    whose best rate stays below ``min_rate`` has no row.
    """
    overall = _rates(ranked).select("method", F.col("rate").alias("_overall"))
    depth = (ranked.filter(F.col("rank").isNotNull()).groupBy("method", "rank")
             .agg(F.count(F.lit(1)).alias("_n"), F.sum("label").alias("_p")))
    # at most one row per rule and distinct rank from here on
    order = Window.partitionBy("method").orderBy("rank")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    depth = depth.select(
        "method", "rank",
        (F.sum("_p").over(upto) / F.sum("_n").over(upto)).alias("_rate"),
        F.lead("rank").over(order).alias("_next"),
        F.max("rank").over(Window.partitionBy("method")).alias("_max"))
    # steps k with rank <= max - k < next
    first = F.coalesce(F.floor(F.col("_max") - F.col("_next")) + 1, F.lit(0))
    last = F.floor(F.col("_max") - F.col("rank"))
    steps = depth.filter(first <= last).select(
        "method", "_max", "_rate", F.explode(F.sequence(first, last)).alias("_k"))
    stop = F.min(F.when(F.col("_rate") > min_rate, F.col("_k"))).over(Window.partitionBy("method"))
    tried = steps.withColumn("_stop", stop).filter(F.col("_stop").isNull() | (F.col("_k") <= F.col("_stop")))
    best = tried.groupBy("method").agg(
        F.max(F.struct("_rate", (-F.col("_k")).alias("_k"), (F.col("_max") - F.col("_k")).alias("_rank"))).alias("_b"))
    decided = overall.join(best, "method", "left")
    keep_all = F.col("_overall") >= min_rate
    return decided.filter(keep_all | (F.col("_b._rate") >= min_rate)).select(
        "method", keep_all.alias("keep_all"), F.col("_b._rank").alias("best_rank"))


def cut_by_rate(
    candidates: DataFrame, labels: DataFrame, min_rate: float, item_id: str = "article_id"
) -> DataFrame:
    """Rules with a good rate keep all rows; others keep the best depth for label customers.

    A rule without any row of a label customer keeps its rows.
    """
    marked = mark_labels(candidates, labels, item_id)
    # read by the search and by the cut
    marked = durable(marked.withColumn("rank", average_rank(["method", "customer_id"], "score")))
    cuts = best_cuts(marked.filter("served"), min_rate)
    unseen = marked.groupBy("method").agg(F.max("served").alias("_seen")).filter(~F.col("_seen")).select(
        "method", F.lit(True).alias("keep_all"), F.lit(None).cast("double").alias("best_rank"))
    cuts = cuts.unionByName(unseen)
    kept = marked.join(F.broadcast(cuts), "method")  # one row per rule
    return kept.filter(
        F.col("keep_all") | (F.col("served") & (F.col("rank") <= F.col("best_rank")))
    ).select(*candidates.columns)


def union_rules(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def scale_scores(candidates: DataFrame, norm_type: str) -> DataFrame:
    if norm_type == "quantile":
        return QuantileNormal.fit(candidates).transform(candidates)
    if norm_type == "minmax":
        return min_max(candidates)
    raise ValueError(f"unknown norm_type {norm_type!r}")


def collect(
    rules: Sequence[Rule],
    labels: DataFrame | None,
    filters: Sequence[Rule] = (),
    min_pos_rate: float = 0.01,
    item_id: str = "article_id",
    norm: bool = True,
    norm_type: str = "quantile",
) -> DataFrame:
    """Long candidate table of all rules. ``labels`` is None for the week to predict.

    The rows of the rules are written once, as scaling and cutting read them again.
    """
    candidates = durable(union_rules([r.retrieve() for r in rules]))
    if norm:
        candidates = scale_scores(candidates, norm_type)
    for f in filters:
        candidates = remove_items(candidates, f.retrieve(), item_id)
    if labels is not None and min_pos_rate > 0:
        candidates = cut_by_rate(candidates, labels, min_pos_rate, item_id)
    return candidates


def compress(customers: DataFrame, candidates: DataFrame, item_id: str = "article_id") -> DataFrame:
    """(customer_id, items): one row per customer, candidates by rule, score and item; an empty list where none."""
    rows = candidates.filter(F.col(item_id).isNotNull())
    score = F.col("score")
    order = F.struct("method", score.isNull().alias("_last"), (-score).alias("_down"), F.col(item_id).alias("_item"))
    lists = rows.groupBy("customer_id").agg(F.sort_array(F.collect_list(order)).alias("_l"))
    nothing = F.array().cast(f"array<{candidates.schema[item_id].dataType.simpleString()}>")
    return customers.select("customer_id").join(lists, "customer_id", "left").select(
        "customer_id", F.coalesce(F.col("_l._item"), nothing).alias(item_id))


def pivot_rules(candidates: DataFrame, methods: Sequence[str], item_id: str = "article_id") -> DataFrame:
    """One row per (customer_id, item) and one column per rule; repeated scores add up."""
    rows = candidates.filter(F.col(item_id).isNotNull())
    return rows.groupBy("customer_id", item_id).pivot("method", list(methods)).agg(F.sum("score"))


def combined_score(wide: DataFrame, methods: Sequence[str]) -> DataFrame:
    """Adds ``score``: the sum of the rule columns, each scaled to [0, 1]."""
    ranges = wide.agg(F.struct(*[
        F.struct(F.min(m).alias("lo"), F.max(m).alias("hi")).alias(m) for m in methods]).alias("r")).scalar()

    def scaled(m: str) -> Column:
        r = F.col("_r").getField(m)
        value = F.col(m) - r.getField("lo")
        return F.coalesce(F.try_divide(value, r.getField("hi") - r.getField("lo")),
                          F.when(F.col(m).isNotNull(), F.lit(0.0)), F.lit(0.0))

    return (wide.withColumn("_r", ranges)
            .withColumn("score", sum((scaled(m) for m in methods), F.lit(0.0))).drop("_r"))


def rank_and_cut(wide: DataFrame, limit: float) -> DataFrame:
    """Adds ``rank`` by score within the customer (ties averaged) and keeps ranks up to ``limit``."""
    return wide.withColumn("rank", average_rank("customer_id", "score")).filter(F.col("rank") <= limit)
