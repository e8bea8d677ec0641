"""The driver's tables seen as transactions, customers, items and vectors; and the same in SQL."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.tables import checkpoint_root

PRODUCT_TYPES = ["Dress", "Boots", "Trousers", "Cap", "Sunglasses", "Leggings/Tights", "Socks", "Beanie", "Blouse", "Coat"]
DEPARTMENTS = ["Young Boy", "Girls Dresses", "Women Casual", "Ladies Knit", "Basics", "Kids"]
INDEX_GROUPS = ["Ladieswear", "Menswear", "Baby/Children", "Divided", "Sport"]
NEWS = ["NONE", "Regularly", "Monthly"]


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stage_path(self) -> str:
        """A new path in the shared folder of the session."""
        return f"{checkpoint_root(self.spark).rstrip('/')}/query-{uuid.uuid4().hex}"

    @cached_property
    def ev(self) -> DataFrame:
        """Events as transactions: 30 days, many repeats."""
        return self.table("events").select(
            F.col("user_id").alias("customer_id"),
            F.get_json_object("props", "$.k").cast("int").alias("article_id"),
            F.to_date("ts").alias("t_dat"), F.col("value").alias("price"))

    @cached_property
    def tx(self) -> DataFrame:
        """Order lines as transactions: six years."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_linenumber")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("article_id"),
            F.to_date("o_orderdate").alias("t_dat"), F.col("l_extendedprice").alias("price"),
            (F.col("l_linenumber") % 2 + 1).alias("sales_channel_id"))

    @cached_property
    def item(self) -> DataFrame:
        def pick(values: list[str], at) -> F.Column:
            return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))

        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("article_id"),
            F.substring("p_brand", 7, 10).cast("int").alias("product_code"),
            (F.col("p_size") % 10).alias("product_type_no"),
            pick(PRODUCT_TYPES, F.col("p_size") % 10).alias("product_type_name"),
            F.col("p_type").alias("product_group_name"),
            F.col("p_size").alias("graphical_appearance_no"),
            (key % 7).cast("int").alias("colour_group_code"),
            (key % 5).cast("int").alias("perceived_colour_value_id"),
            (key % 11).cast("int").alias("perceived_colour_master_id"),
            (key % 13).cast("int").alias("department_no"),
            F.concat(F.col("p_name"), F.lit(" "), pick(DEPARTMENTS, key % 6)).alias("department_name"),
            F.substring("p_type", 1, 1).alias("index_code"),
            (key % 5).cast("int").alias("index_group_no"),
            pick(INDEX_GROUPS, key % 5).alias("index_group_name"),
            (key % 17).cast("int").alias("section_no"),
            (key % 19).cast("int").alias("garment_group_no"),
            F.when(key % 50 != 0, F.concat_ws(" ", "p_name", "p_type", "p_brand")).alias("detail_desc"))

    @cached_property
    def user(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("customer_id"),
            F.when(key % 3 == 0, 1.0).alias("FN"),
            F.when(key % 4 == 0, 1.0).alias("Active"),
            F.when(key % 20 != 0, F.col("c_mktsegment")).alias("club_member_status"),
            F.element_at(F.array(*[F.lit(v) for v in NEWS]), F.col("c_nationkey") % 3 + 1)
            .alias("fashion_news_frequency"),
            F.when(key % 25 != 0, F.floor(F.abs("c_acctbal") / 100).cast("double")).alias("age"))

    @cached_property
    def segments(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"))

    @cached_property
    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label")

    @cached_property
    def anchor(self) -> dt.date:
        """Anchor of the event weeks, as a literal date that reaches the scan."""
        return self.table("events").agg(F.to_date(F.max("ts"))).first()[0] + dt.timedelta(7)

    @cached_property
    def tx_anchor(self) -> dt.date:
        lines = self.table("lineitem").select("l_orderkey")
        orders = self.table("orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
        return orders.agg(F.to_date(F.max("o_orderdate"))).first()[0] + dt.timedelta(7)


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


EV = """ev AS (
  SELECT user_id AS customer_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS article_id,
         CAST(ts AS DATE) AS t_dat, value AS price FROM events)"""
TX = """tx AS (
  SELECT o_custkey AS customer_id, l_partkey AS article_id, CAST(o_orderdate AS DATE) AS t_dat,
         l_extendedprice AS price, l_linenumber % 2 + 1 AS sales_channel_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
ITEM = f"""item AS (
  SELECT p_partkey AS article_id, CAST(substr(p_brand, 7) AS INTEGER) AS product_code,
         p_size % 10 AS product_type_no,
         ({_sql_list(PRODUCT_TYPES)})[p_size % 10 + 1] AS product_type_name,
         p_type AS product_group_name, p_size AS graphical_appearance_no,
         CAST(p_partkey % 7 AS INTEGER) AS colour_group_code,
         CAST(p_partkey % 5 AS INTEGER) AS perceived_colour_value_id,
         CAST(p_partkey % 11 AS INTEGER) AS perceived_colour_master_id,
         CAST(p_partkey % 13 AS INTEGER) AS department_no,
         p_name || ' ' || ({_sql_list(DEPARTMENTS)})[p_partkey % 6 + 1] AS department_name,
         substr(p_type, 1, 1) AS index_code, CAST(p_partkey % 5 AS INTEGER) AS index_group_no,
         ({_sql_list(INDEX_GROUPS)})[p_partkey % 5 + 1] AS index_group_name,
         CAST(p_partkey % 17 AS INTEGER) AS section_no, CAST(p_partkey % 19 AS INTEGER) AS garment_group_no,
         CASE WHEN p_partkey % 50 <> 0 THEN p_name || ' ' || p_type || ' ' || p_brand END AS detail_desc
  FROM part)"""
USER = f"""usr AS (
  SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 3 = 0 THEN 1.0::DOUBLE END AS FN,
         CASE WHEN c_custkey % 4 = 0 THEN 1.0::DOUBLE END AS Active,
         CASE WHEN c_custkey % 20 <> 0 THEN c_mktsegment END AS club_member_status,
         ({_sql_list(NEWS)})[c_nationkey % 3 + 1] AS fashion_news_frequency,
         CASE WHEN c_custkey % 25 <> 0 THEN CAST(floor(abs(c_acctbal) / 100) AS DOUBLE) END AS age
  FROM customer)"""
SEG = "seg AS (SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM customer)"
# Weeks of the events: week(d) = floor((last day + 7 - d) / 7).
EVA = "a AS (SELECT max(t_dat) + 7 AS anchor FROM ev)"
TXA = "a AS (SELECT max(t_dat) + 7 AS anchor FROM tx)"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
