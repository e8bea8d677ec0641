"""Physical plans: filters and columns reach the scan, and nothing becomes a product of tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.operators import collector as c
from basketry.operators import features as f
from basketry.operators import rules as r
from basketry.schema import Dataset
from basketry.sources.stages import load_dataset, save_dataset
from workload.tables import Tables

SF = "/root/testdata/sf0.001"
LAST = dt.date(2001, 7, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    t = Tables(spark, SF)
    folder = str(tmp_path_factory.mktemp("data"))
    save_dataset(Dataset(t.user, t.item, t.tx), folder)
    return load_dataset(spark, folder)


def test_date_filter_and_columns_reach_the_scan(stored):
    recent = r.OrderHistoryDecay(stored.inter, days=7, last_date=LAST).retrieve()
    text = plan(recent)
    assert "GreaterThan(t_dat" in text
    assert "price" not in text.split("ReadSchema:")[1].splitlines()[0]
    counts = r.SaleTrend(stored.user.select("customer_id"), stored.inter, last_date=LAST).ranked()
    assert "GreaterThan(t_dat" in plan(counts)


def rules(stored):
    customers = stored.user.select("customer_id")
    users = stored.user.select("customer_id", "club_member_status")
    group = ("club_member_status",)
    inter = stored.inter
    return {
        "history": r.OrderHistory(inter), "decay": r.OrderHistoryDecay(inter), "pairs": r.ItemPair(inter),
        "cf": r.ItemCF(inter, inter), "top": r.TimeHistory(customers, inter),
        "top_decay": r.TimeHistoryDecay(customers, inter), "trend": r.SaleTrend(customers, inter),
        "group_top": r.UserGroupTimeHistory(users, customers, inter, group),
        "group_trend": r.UserGroupSaleTrend(users, customers, inter, group),
    }


@pytest.mark.parametrize("name", ["history", "decay", "pairs", "cf", "top", "top_decay", "trend", "group_top", "group_trend"])
def test_rules_have_no_product_of_tables(stored, name):
    text = plan(rules(stored)[name].retrieve())
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_counts_are_partial_before_the_shuffle(stored):
    base = stored.inter.withColumn("week", F.lit(1)).withColumn("valid", F.lit(1))
    text = plan(f.full_sale(base, "article_id"))
    assert "partial_count" in text


def test_pivot_needs_no_extra_job(stored, spark):
    rows = stored.inter.select("customer_id", "article_id", F.lit("m").alias("method"), F.lit(1.0).alias("score"))
    assert c.pivot_rules(rows, ["m", "n"]).columns == ["customer_id", "article_id", "m", "n"]


def test_global_list_is_a_subquery(stored):
    text = plan(r.TimeHistory(stored.user.select("customer_id"), stored.inter).retrieve())
    assert "Subquery" in text and "TakeOrderedAndProject" in text
