"""Kinds of rules, and how group and global results reach the customers to serve.

Higher scores are better in every rule.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.skew import salted_lookup


class Rule(ABC):
    @abstractmethod
    def retrieve(self) -> DataFrame:
        """(customer_id, item, method, score); a filter rule returns one column of items."""


class PersonalRule(Rule):
    """Items from a customer's own rows."""


class UserGroupRule(Rule):
    """The same items for every customer of a group."""


class ItemGroupRule(Rule):
    """Items chosen within groups of items. No rule of this kind exists yet."""


class GlobalRule(Rule):
    """The same items for every customer."""


class FilterRule(Rule):
    """Items to remove from the candidates of all rules."""


def labelled(df: DataFrame, item_id: str, method: str) -> DataFrame:
    return df.select(
        "customer_id", item_id, F.lit(method).alias("method"), F.col("score").cast("double").alias("score"))


def serve_groups(
    customers: DataFrame, users: DataFrame, ranked: DataFrame, cat_cols: Sequence[str], item_id: str
) -> DataFrame:
    """Items of a customer's group; a customer whose group has none keeps one row without item.

    A group's items (at most ``n`` of the rule) travel as one array, and big groups are spread
    over tasks.
    """
    lists = ranked.groupBy(*cat_cols).agg(F.collect_list(F.struct(item_id, "score")).alias("_items"))
    members = customers.select("customer_id").join(
        users.select("customer_id", *cat_cols), "customer_id", "left")
    joined = salted_lookup(members, lists, list(cat_cols), "customer_id")
    return joined.select("customer_id", F.inline_outer("_items"))


def serve_all(customers: DataFrame, ranked: DataFrame, item_id: str) -> DataFrame:
    """Every item of a short list for every customer; the list is a scalar subquery, not a join."""
    items = ranked.agg(F.collect_list(F.struct(item_id, "score"))).scalar()
    return customers.select("customer_id", F.inline(items))
