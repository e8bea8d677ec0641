"""Hand-computed cases and edges."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from basketry.operators import blend, collector as c, metrics
from basketry.operators import preprocess as p
from basketry.operators import rules as r
from basketry.operators.embeddings import tfidf
from basketry.operators.quantiles import QuantileNormal, min_max
from basketry.sources.stages import load_dataset


def long_lists(spark, lists):
    rows = [(cust, item, k + 1) for cust, items in lists.items() for k, item in enumerate(items)]
    return spark.createDataFrame(rows, "customer_id int, article_id int, rank int")


def test_metrics(spark):
    actual = spark.createDataFrame(
        [(1, 1, 1), (1, 2, 1), (2, 3, 2), (2, 4, 1), (3, 5, 1)], "customer_id int, article_id int, n int")
    predicted = long_lists(spark, {1: [2, 9, 1], 2: [3, 3, 8], 3: [7]})
    ap = {x.customer_id: round(x.ap, 6) for x in metrics.average_precision(actual, predicted, 3).collect()}
    assert ap == {1: 0.833333, 2: 0.333333, 3: 0}
    recall = {x.customer_id: round(x.recall, 6) for x in metrics.customer_recall(actual, predicted, 3).collect()}
    assert recall == {1: 1, 2: 0.666667, 3: 0}
    row = metrics.ranking_metrics(actual, predicted, 3).first()
    assert [round(x, 6) for x in row] == [0.388889, 0.555556, 0.666667]
    assert metrics.hit_rate_at_k(actual, predicted, 3).first()[0] == pytest.approx(2 / 3)
    nothing = predicted.filter("false")
    assert metrics.map_at_k(actual, nothing, 3).first()[0] == 0


def test_fusion(spark):
    lists = [long_lists(spark, {1: x}) for x in ([10, 20, 30], [20, 10], [40, 10], [20])]
    got = {x.article_id: round(x.score, 6) for x in blend.fuse(lists, (1, 1.3, 1, 1.3)).collect()}
    assert got == {20: 3.1, 10: 2.15, 40: 1.0, 30: 0.333333}


def rule_scores(spark, values, method="a"):
    return spark.createDataFrame(
        [(i, i, method, None if v is None else float(v)) for i, v in enumerate(values)],
        "customer_id int, article_id int, method string, score double")


def test_quantile_normal(spark):
    rows = rule_scores(spark, [1, 2, 2, 4, 9, None])
    got = QuantileNormal.fit(rows).transform(rows).orderBy("customer_id").collect()
    assert [x.score if x.score is None else round(x.score, 6) for x in got] == pytest.approx(
        [-5.199338, -0.318639, -0.318639, 0.674490, 5.199338, None], abs=1e-5)


def test_min_max_of_a_constant_rule(spark):
    assert {x.score for x in min_max(rule_scores(spark, [3, 3])).collect()} == {0.0}


def test_cut_search(spark):
    rows = [(cust, 10 * cust + k, "a", float(-k)) for cust in (1, 2, 3) for k in (1, 2, 3)]
    cands = spark.createDataFrame(rows, "customer_id int, article_id int, method string, score double")
    labels = spark.createDataFrame([(1, 11), (2, 22), (3, 99)], "customer_id int, article_id int")
    assert c.cut_by_rate(cands, labels, 0.2).count() == 9
    assert c.cut_by_rate(cands, labels, 0.3).count() == 6
    assert c.cut_by_rate(cands, labels, 0.4).count() == 0


def literal_cut(rows, least):
    """The search as a loop over depths."""
    rate = sum(x[2] for x in rows) / len(rows)
    if rate >= least:
        return "all"
    depth = best_rank = max(x[1] for x in rows)
    best = rate
    while depth > 0:
        here = [x[2] for x in rows if x[1] <= depth]
        if here:
            now = sum(here) / len(here)
            if now > best:
                best, best_rank = now, depth
            if now > least:
                break
        depth -= 1
    return None if best < least else best_rank


def test_cut_search_against_a_loop(spark):
    import random

    rng = random.Random(7)
    rows, want = [], {}
    for case in range(60):
        method, mine = f"m{case}", []
        for cust in range(rng.randint(1, 6)):
            values = sorted((rng.randint(0, 6) for _ in range(rng.randint(1, 9))), reverse=True)
            for v in values:
                rank = sum(x > v for x in values) + (values.count(v) + 1) / 2
                mine.append((cust, rank, int(rng.random() < 0.15)))
        rows += [(method, x[0], x[1], x[2]) for x in mine]
        want[method] = literal_cut(mine, 0.2)
    ranked = spark.createDataFrame(rows, "method string, customer_id int, rank double, label int")
    got = {x.method: "all" if x.keep_all else x.best_rank for x in c.best_cuts(ranked, 0.2).collect()}
    assert {m: got.get(m) for m in want} == want


def test_tfidf_weights(spark):
    counts = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "a", 1), (1, "b", 1)], "id int, term string, n int")
    docs = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    got = {(x.id, x.term): x.weight for x in tfidf(counts, docs, 1).collect()}
    assert got[(2, "a")] == pytest.approx(1.0)
    assert got[(1, "b")] / got[(1, "a")] == pytest.approx(1.693147, abs=1e-6)


def test_article_gender(spark):
    rows = [("Ladieswear", "x", "Dress", 2), ("Menswear", "x", "Dress", 1), ("Kids", "Young Boy", "Socks", 1),
            ("Kids", "Girls Dresses", "Socks", 2), ("Kids", "Women Casual", "Socks", 1), ("Kids", "Baby", "Dress", 2),
            ("Kids", "Baby", "Trousers", 0)]
    df = spark.createDataFrame(rows, "index_group_name string, department_name string, product_type_name string, want int")
    assert all(x.got == x.want for x in df.withColumn("got", p.article_gender()).collect())


def test_user_gender(spark):
    item = spark.createDataFrame([(1, 2), (2, 0)], "article_id int, article_gender int")
    inter = spark.createDataFrame([(1, 1)] * 4 + [(1, 2)] + [(2, 1)] * 3 + [(2, 2)] * 2, "customer_id int, article_id int")
    user = spark.createDataFrame([(1,), (2,), (3,)], "customer_id int")
    got = {x.customer_id: x.user_gender for x in p.with_user_gender(user, inter, item).collect()}
    assert got == {1: 2, 2: 0, 3: 0}


def test_age_bins(spark):
    df = spark.createDataFrame([(0,), (19,), (20,), (119,), (120,)], "age int")
    assert [x[0] for x in df.select(p.age_bin()).collect()] == [1, 1, 2, 7, None]


def test_out_of_stock(spark):
    rows = []
    for item, (prev, cur) in enumerate([(10, 1), (10, 2), (0, 5), (5, 0)]):
        rows += [(dt.date(2020, 8, 3), 1, item)] * prev + [(dt.date(2020, 9, 3), 1, item)] * cur
    trans = spark.createDataFrame(rows, "t_dat date, customer_id int, article_id int")
    assert {x.article_id for x in r.OutOfStock(trans).retrieve().collect()} == {0, 3}


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 300, 1.5, None), (2, -5, 2.0, 7)], "a long, b long, c double, d long")
    out, filled = p.narrow_types(df)
    assert [x.dataType.simpleString() for x in out.schema.fields] == ["tinyint", "smallint", "float", "tinyint"]
    assert filled == ["d"] and out.orderBy("a").first().d == 6


def test_missing_dataset(spark, tmp_path):
    with pytest.raises(AnalysisException):
        load_dataset(spark, str(tmp_path / "nothing"))


def test_empty_input(spark):
    empty = spark.createDataFrame([], "t_dat date, customer_id int, article_id int")
    customers = spark.createDataFrame([(1,)], "customer_id int")
    users = customers.withColumn("g", F.lit(1))
    for rule in (r.OrderHistory(empty), r.OrderHistoryDecay(empty), r.ItemPair(empty), r.ItemCF(empty, empty),
                 r.TimeHistory(customers, empty), r.TimeHistoryDecay(customers, empty), r.SaleTrend(customers, empty)):
        assert rule.retrieve().count() == 0
    # a customer whose group has nothing keeps one row without item
    assert r.UserGroupTimeHistory(users, customers, empty, ("g",)).retrieve().count() == 1


def test_serve_unknown_customer(spark):
    customers = spark.createDataFrame([(1,), (9,)], "customer_id int")
    users = spark.createDataFrame([(1, "g")], "customer_id int, g string")
    trans = spark.createDataFrame([(dt.date(2020, 9, 1), 1, 5)], "t_dat date, customer_id int, article_id int")
    got = {x.customer_id: x.article_id for x in r.UserGroupTimeHistory(users, customers, trans, ("g",)).retrieve().collect()}
    assert got == {1: 5, 9: None}
