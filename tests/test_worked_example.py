"""The worked example: three customers, four items, 14 purchases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.operators import features as f
from basketry.operators import rules as r
from basketry.operators.preprocess import label_lists, split
from basketry.operators.rules.itemcf import similar_items
from basketry.operators.rules.pairs import frequent_pairs

ANCHOR = dt.date(2020, 9, 29)
ROWS = [
    ("2020-09-01", 1, 11), ("2020-09-01", 2, 11), ("2020-09-03", 1, 12), ("2020-09-05", 2, 12),
    ("2020-09-08", 3, 13), ("2020-09-09", 1, 11), ("2020-09-10", 3, 11), ("2020-09-12", 2, 13),
    ("2020-09-14", 3, 12), ("2020-09-15", 1, 13), ("2020-09-15", 2, 13), ("2020-09-17", 1, 13),
    ("2020-09-18", 2, 12), ("2020-09-22", 3, 14),
]


@pytest.fixture(scope="module")
def trans(spark):
    rows = [(dt.date.fromisoformat(d), c, i) for d, c, i in ROWS]
    return spark.createDataFrame(rows, "t_dat date, customer_id int, article_id int")


@pytest.fixture(scope="module")
def train(trans):
    return split(trans, cal.week_start(1, ANCHOR), cal.week_end(1, ANCHOR))[0]


@pytest.fixture(scope="module")
def base(trans):
    return cal.with_week(trans, ANCHOR).withColumn("valid", F.lit(1))


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame([(1,), (2,), (3,)], "customer_id int")


def scores(df, *keys, value="score", digits=4):
    return {tuple(x[k] for k in keys) if len(keys) > 1 else x[keys[0]]: round(x[value], digits) for x in df.collect()}


def test_weeks(spark):
    weeks = {x.week: (str(x.start_date), str(x.end_date)) for x in cal.week_table(spark, ANCHOR, range(6)).collect()}
    assert weeks[0] == ("2020-09-23", "2020-09-30")
    assert weeks[1] == ("2020-09-16", "2020-09-23")
    assert weeks[5] == ("2020-08-19", "2020-08-26")


def test_split(trans, train):
    held_out = split(trans, cal.week_start(1, ANCHOR), cal.week_end(1, ANCHOR))[1]
    assert train.count() == 11
    assert {x.customer_id: x.article_id for x in label_lists(held_out).collect()} == {1: [13], 2: [12], 3: [14]}
    with pytest.raises(KeyError):
        split(trans, "2020-09-16", "2020-09-23", "product_code")


def test_order_history(train):
    got = scores(r.OrderHistory(train, days=7).retrieve(), "customer_id", "article_id")
    assert got == {(1, 11): -6, (1, 13): 0, (2, 13): 0, (3, 11): -4, (3, 12): 0, (3, 13): -6,
                   **{(2, 13): 0}}


def test_order_history_decay(train):
    got = scores(r.OrderHistoryDecay(train, days=7).values(), "customer_id", "article_id")
    want = {(1, 11): 69188.3795, (1, 12): 9912.2857, (1, 13): 146809.6130, (2, 11): 14803.0404, (2, 12): 13602.9933,
            (2, 13): 242565.1151, (3, 11): 65362.2561, (3, 12): 146809.6130, (3, 13): 136315.9692}
    assert got == pytest.approx(want, abs=1e-3)


def test_time_history_decay(train, customers):
    got = scores(r.TimeHistoryDecay(customers, train, days=7).ranked(), "article_id")
    assert got == pytest.approx({13: 525690.6973, 12: 170324.8920, 11: 149353.6760}, abs=1e-3)


def test_time_history(train, customers):
    ranked = r.TimeHistory(customers, train, n=2).ranked().collect()
    assert [(x.article_id, x.score) for x in ranked] == [(11, 3), (12, 3)]


def test_sale_trend(train, customers):
    assert scores(r.SaleTrend(customers, train, days=7, t=-9).ranked(), "article_id") == {13: 2.0, 12: -0.5}
    assert scores(r.SaleTrend(customers, train, days=7, t=0.8).ranked(), "article_id") == {13: 2.0}


def test_group_sale_trend(train, customers):
    users = customers.withColumn("g", F.lit("all"))
    ranked = r.UserGroupSaleTrend(users, customers, train, ("g",), days=7, t=-9).ranked()
    assert scores(ranked, "article_id", digits=6) == {13: 1.0, 12: -0.333333}


@pytest.mark.parametrize("large", [500, 2, 1])
def test_frequent_pairs(train, large):
    got = {x.article_id: (x.pair, x.score) for x in frequent_pairs(train, large=large).collect()}
    assert got == {11: (12, 3), 12: (11, 3), 13: (11, 3)}


def test_item_cf(train):
    got = scores(similar_items(train, min_related=1), "src", "dst", value="sim", digits=6)
    want = {(11, 11): 0.826375, (11, 12): 2.523219, (11, 13): 2.314390, (12, 11): 1.739738, (12, 13): 1.491204,
            (13, 11): 1.112789, (13, 12): 1.064145, (13, 13): 0.621335}
    assert got == pytest.approx(want, abs=2e-6)
    assert similar_items(train).count() == 0


def weekly(df, value, digits=6):
    out = {}
    for x in df.collect():
        out.setdefault(x.week, {})[x.article_id] = round(x[value], digits)
    return out


def test_features(base):
    full = weekly(f.full_sale(base, "article_id"), "sale")
    assert full[1] == {11: 4, 12: 4, 13: 5, 14: 1}
    assert full[2] == {11: 4, 12: 3, 13: 4}
    assert full[3] == {11: 2, 12: 2, 13: 1}
    week = weekly(f.week_sale(base, "article_id"), "sale")
    assert week[1] == {12: 1, 13: 1, 14: 1}
    assert week[2] == {11: 2, 12: 1, 13: 3}
    assert weekly(f.week_sale(base, "article_id", step=1), "sale")[1] == week[2]
    period = weekly(f.period_sale(base, "article_id", ANCHOR, 14), "sale")
    assert period[1] == {11: 2, 12: 2, 13: 5, 14: 1}
    assert period[2] == {11: 4, 12: 3, 13: 4}
    ratio = weekly(f.repurchase_ratio(base, "article_id"), "ratio", 4)
    assert ratio[1] == {11: 0.3333, 12: 0.3333, 13: 0.6667, 14: 0}
    assert ratio[2] == {11: 0.3333, 12: 0, 13: 0.3333}
    pop = weekly(f.popularity(base), "popularity")
    assert pop[1] == {11: 0.239261, 12: 0.416667, 13: 0.574242, 14: 1}
    assert pop[2] == {11: 0.442857, 12: 0.667832, 13: 2.375}
    assert pop[3] == {11: 0.25, 12: 0.416667, 13: 1}
