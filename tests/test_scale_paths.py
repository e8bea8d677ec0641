"""The paths that only large data takes, forced on small data and checked against brute force."""

import datetime as dt
import math
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.skew import dense_index, salted_lookup
from basketry.functions.stats import average_rank_by_value
from basketry.operators import embeddings as e
from basketry.operators import rules as r
from basketry.operators.quantiles import exact_quantiles
from basketry.operators.rules import itemcf
from basketry.operators.rules.bpr import train_bpr
from basketry.operators.rules.pairs import frequent_pairs
from basketry.operators.sequences import item_lists


def purchases(spark, seed, customers, items, rows, hot=0.4):
    """Random purchases; one customer and one item hold a large share."""
    rng = random.Random(seed)
    out = []
    for _ in range(rows):
        c = 1 if rng.random() < hot else rng.randint(2, customers)
        i = 1 if rng.random() < hot else rng.randint(2, items)
        out.append((dt.date(2020, 1, 1) + dt.timedelta(rng.randint(0, 40)), c, i))
    return out, spark.createDataFrame(out, "t_dat date, customer_id int, article_id int")


def test_dense_index(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k")).repartition(7)
    got = [(x.k, x.n) for x in dense_index(df, "k", "n").orderBy("k").collect()]
    assert [x[1] for x in got] == list(range(1, 1001))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_lookup_equals_join(spark, how):
    fact = spark.createDataFrame([(1 if i % 3 else None, i) for i in range(60)] + [(5, 99)], "k int, v int")
    lookup = spark.createDataFrame([(1, "a"), (2, "b")], "k int, t string")
    got = sorted(map(tuple, salted_lookup(fact, lookup, "k", "v", how).collect()), key=str)
    assert got == sorted(map(tuple, fact.join(lookup, "k", how).collect()), key=str)


def test_salted_lookup_broadcasts_no_copies_by_the_estimate_of_one(spark, tmp_path):
    spark.range(5000).selectExpr("id AS k", "id % 7 AS t").write.parquet(f"{tmp_path}/lookup")
    lookup, fact = spark.read.parquet(f"{tmp_path}/lookup"), spark.range(100).selectExpr("id AS k", "id AS v")
    fact = fact.unionByName(fact)
    size = int(str(lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    planned = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 4 * size)
        assert "BroadcastHashJoin" in planned(fact.join(lookup, "k", "left"))
        joined = salted_lookup(fact, lookup, "k", "v")
        assert "BroadcastHashJoin" not in planned(joined)  # 16 copies are more than four times one
        assert sorted(map(tuple, joined.collect())) == sorted((i, i, i % 7) for i in range(100) for _ in range(2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_average_rank_by_value(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([5, 3, 3, 9, 3])], "g string, k int, v int")
    got = {x.k: x.r for x in average_rank_by_value(df, "g", "v", "k", "r").collect()}
    assert got == {0: 2.0, 1: 4.0, 2: 4.0, 3: 1.0, 4: 4.0}


@pytest.mark.parametrize("n", [1, 2, 5, 999, 1000, 1001, 2500])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.normal(size=n), 2 if n % 2 else 9)
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 4.0)], "g string, v double")
    got = exact_quantiles(df, "g", "v")
    steps = min(1000, n)
    want = np.quantile(values, np.linspace(0, 1, steps)) if steps > 1 else values
    assert np.allclose(got["a"], want, atol=1e-12) and got["b"] == [4.0]
    probs = [0, 0.2, 0.5, 0.9, 1.0]
    assert np.allclose(exact_quantiles(df, "g", "v", probs)["a"], np.quantile(values, probs))


@pytest.mark.parametrize("large", [500, 8, 3, 1])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pairs_of_large_baskets(spark, large, seed):
    rows, df = purchases(spark, seed, 14, 25, 160)
    owned = defaultdict(set)
    for _, c, i in rows:
        owned[c].add(i)
    counts = Counter((x, y) for items in owned.values() for x in items for y in items if x != y)
    want = {}
    for (x, y), n in counts.items():
        want[x] = min(want.get(x, (0, 0)), (-n, y))
    got = {x.article_id: (-x.score, x.pair) for x in frequent_pairs(df, large=large).collect()}
    assert got == want


def brute_similarity(rows):
    seqs = defaultdict(list)
    for d, c, i in sorted(rows, key=lambda x: (x[1], x[0], x[2])):
        seqs[c].append(i)
    sim = Counter()
    for items in seqs.values():
        for i, a in enumerate(items[:-1]):
            for j, b in enumerate(items):
                if i != j:
                    w = (1.0 if j > i else 0.9) * 0.7 ** (abs(j - i) - 1)
                    sim[a, b] += w / math.log(1 + len(items))
    return sim


@pytest.mark.parametrize("seed", [1, 2])
def test_similarity_with_runs(spark, seed):
    rows, df = purchases(spark, seed, 6, 9, 300)
    want = brute_similarity(rows)
    got = {(x.src, x.dst): x.sim for x in itemcf.similar_items(df, top_k=1000, min_related=1).collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_similarity_over_blocks(spark, monkeypatch):
    """With a short reach, pairs of runs further apart weigh nothing but stay related."""
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(i), 1, i) for i in range(40)]
    df = spark.createDataFrame(rows, "t_dat date, customer_id int, article_id int")
    monkeypatch.setattr(itemcf, "REACH", 7)
    got = {(x.src, x.dst): x.sim for x in itemcf.similar_items(df, top_k=1000, min_related=1).collect()}
    full = brute_similarity(rows)
    assert got.keys() == full.keys()
    assert all(math.isclose(v, full[k], rel_tol=1e-9) if abs(k[0] - k[1]) <= 7 else v == 0 for k, v in got.items())


def test_similarity_beyond_reach(spark):
    """Items further apart than the reach count as related, as in a literal loop over the sequence."""
    days = [1] + [2] * 2200 + [3, 4, 5, 6, 7]
    rows = [(dt.date(2020, 1, 1), 1, 1)] + [(dt.date(2020, 1, 2), 1, 2)] * 2200 + [
        (dt.date(2020, 1, k), 1, k) for k in (3, 4, 5, 6, 7)]
    assert [x[2] for x in rows] == days
    df = spark.createDataFrame(rows, "t_dat date, customer_id int, article_id int")
    got = {(x.src, x.dst): x.sim for x in itemcf.similar_items(df, top_k=6).collect()}
    seq, want = np.array(days), defaultdict(dict)
    for a in sorted(set(days[:-1])):
        at = np.flatnonzero(seq[:-1] == a)
        for b in sorted(set(days)):
            to = np.flatnonzero(seq == b)
            gap = to[None, :] - at[:, None]
            w = np.where(gap == 0, 0.0, np.where(gap > 0, 1.0, 0.9) * 0.7 ** (np.abs(gap) - 1.0))
            if (gap != 0).any():
                want[a][b] = w.sum() / math.log(1 + len(days))
    expected = {(a, b): v for a, row in want.items() if len(row) >= 5
                for b, v in sorted(row.items(), key=lambda kv: (-round(kv[1], 9), kv[0]))[:6]}
    assert got.keys() == expected.keys() and any(a == 1 for a, _ in got)
    assert all(math.isclose(v, expected[k], rel_tol=1e-9) for k, v in got.items())


def test_reach_loses_nothing():
    assert 0.7 ** itemcf.REACH == 0.0


def test_long_lists_are_one_row(spark):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(i % 5), 1, i % 3) for i in range(2500)] + [(dt.date(2020, 1, 9), 2, 7)]
    df = spark.createDataFrame(rows, "t_dat date, customer_id int, article_id int")
    got = {x.customer_id: x.article_id for x in item_lists(df).collect()}
    assert got == {1: [i for _, _, i in sorted(rows[:-1])], 2: [7]}


def test_bpr_settings_do_not_follow_the_data():
    import inspect

    assert inspect.signature(train_bpr).parameters["blocks"].default == r.BPR.blocks == r.UserGroupBPR.blocks == 8


def test_items_of_another_name_get_groups(spark):
    trans = spark.createDataFrame([(1, 5), (1, 5), (2, 6)], "customer_id int, thing int")
    users = spark.createDataFrame([(1, "a"), (2, "b")], "customer_id int, g string")
    got = r.UserGroupTimeHistory(users, users, trans, ("g",), item_id="thing").retrieve().collect()
    assert {(x.customer_id, x.thing) for x in got} == {(1, 5), (2, 6)}


def test_empty_svd(spark):
    vectors, values = e.truncated_svd(spark.createDataFrame([], "id int, term string, weight double"), 3)
    assert vectors.count() == 0 and len(values) == 0


def test_raw_reader_checks(spark, tmp_path):
    from basketry.sources.raw import read_csv

    (tmp_path / "good.csv").write_text('id,note\n1,"two\nlines"\n2,plain\n')
    (tmp_path / "turned.csv").write_text("note,id\nx,1\n")
    (tmp_path / "broken.csv").write_text("id,note\nx,plain\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("note", T.StringType())])
    rows = read_csv(spark, str(tmp_path / "good.csv"), schema, multi_line=True).orderBy("id").collect()
    assert [tuple(x) for x in rows] == [(1, "two\nlines"), (2, "plain")]
    for name in ("turned", "broken"):
        with pytest.raises(Exception, match="CSV|MALFORMED|header"):
            read_csv(spark, str(tmp_path / f"{name}.csv"), schema).collect()


def test_truncated_svd(spark):
    rng = np.random.default_rng(3)
    dense = rng.random((30, 5)) @ rng.random((5, 18))
    rows = [(i, f"t{j}", float(dense[i, j])) for i in range(30) for j in range(18)]
    vectors, values = e.truncated_svd(spark.createDataFrame(rows, "id int, term string, weight double"), 3)
    want = np.linalg.svd(dense, compute_uv=False)[:3]
    assert np.allclose(values, want, rtol=1e-6)
    got = np.array([x.vec for x in vectors.orderBy("id").collect()])
    u, s, _ = np.linalg.svd(dense, full_matrices=False)
    assert np.allclose(np.abs(got), np.abs(u[:, :3] * s[:3]), atol=1e-6)


def clustered(spark, groups=3, users=20, items=12, seed=5):
    """Customers buy only items of their own cluster."""
    rng = random.Random(seed)
    rows = []
    for u in range(groups * users):
        mine = [g for g in range(groups * items) if g % groups == u % groups]
        rows += [(dt.date(2020, 1, 20), u, i) for i in rng.sample(mine, 6)]
    return spark.createDataFrame(rows, "t_dat date, customer_id int, article_id int")


@pytest.mark.parametrize("rule", ["als", "bpr", "bpr_blocks", "bpr_passes"])
def test_factorisation_finds_clusters(spark, rule):
    trans = clustered(spark)
    customers = spark.range(61).select(F.col("id").cast("int").alias("customer_id"))
    make = {
        "als": lambda: r.ALS(customers, trans, n=5, factors=6, iter_num=8),
        "bpr": lambda: r.BPR(customers, trans, n=5, factors=6, iter_num=60, blocks=1, rate=0.2),
        "bpr_blocks": lambda: r.BPR(customers, trans, n=5, factors=6, iter_num=40, blocks=2, rate=0.2),
        "bpr_passes": lambda: r.BPR(customers, trans, n=5, factors=6, iter_num=80, blocks=2, rate=0.2, passes=10),
    }[rule]
    rows = make().retrieve().collect()
    assert len(rows) == 61 * 5 and all(math.isfinite(x.score) for x in rows)
    known = [x for x in rows if x.customer_id < 60]
    assert sum(x.article_id % 3 == x.customer_id % 3 for x in known) / len(known) > 0.75
    cold = [x for x in rows if x.customer_id == 60]
    assert {x.score for x in cold} == {0.0}


def test_bpr_repeats(spark):
    pairs = clustered(spark).select(F.lit("g").alias("grp"), F.col("customer_id").alias("customer"),
                                    F.col("article_id").alias("item")).distinct()
    runs = [train_bpr(x, 4, 3, blocks=2)[1].orderBy("id").collect() for x in (pairs, pairs.repartition(5))]
    assert runs[0] == runs[1]


@pytest.mark.parametrize("rule", ["als", "bpr"])
def test_group_factorisation(spark, rule):
    """Groups are fitted side by side and apart: a customer gets items of the own group's customers first."""
    trans = clustered(spark)
    users = spark.range(60).select(F.col("id").cast("int").alias("customer_id"), F.concat(F.lit("g"), F.col("id") % 3).alias("grp"))
    make = {"als": r.UserGroupALS, "bpr": r.UserGroupBPR}[rule]
    rows = make(users, users.select("customer_id"), trans, "grp", n=4, factors=4, iter_num=6).retrieve().collect()
    assert Counter(x.customer_id for x in rows) == {c: 4 for c in range(60)}
    if rule == "als":  # its pools are the groups' own
        assert all(x.article_id % 3 == x.customer_id % 3 for x in rows)


def test_attach_vectors(spark):
    from basketry.operators.assemble import attach_vectors

    rows = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, None)], "customer_id int, article_id int")
    vectors = spark.createDataFrame([(10, [1.0, 2.0, 3.0, 4.0])], "id int, vec array<double>")
    got = {x.customer_id: x.v for x in attach_vectors(rows, vectors, 4, "v").collect()}
    assert got == {1: [1.0, 2.0, 3.0, 4.0], 2: [1.0, 2.0, 3.0, 4.0], 3: [0.5] * 4, 4: [0.5] * 4}


@pytest.mark.skipif(not os.environ.get("RUN_SLOW"), reason="takes minutes; set RUN_SLOW=1")
def test_full_run(spark):
    """Rule scores reach the models, lists come from both strategies, and items not bought before are in them."""
    from basketry.plans import full_run, weekly
    from workload.models import event_dataset
    from workload.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    data = event_dataset(t)
    small = full_run.Settings(rounds=1, depth=2, trend=0.0, parallel=8, second={
        "n": 10, "factors": (2, 2), "iterations": (1, 1), "top_k": 3, "limit": 50})
    made = full_run.run(data, t.anchor, (2,), settings=small)
    first, second = (set(weekly.model_features(x)) for x in made.rows)
    assert {"OrderHistory_1", "TimeHistory_1"} <= first and {"ALS_1", "BPR_1", "ItemCF_1", "score"} <= second
    test = made.test.collect()
    lists = Counter(x.customer_id for x in test)
    assert set(lists) == {x.customer_id for x in data.user.select("customer_id").collect()} and max(lists.values()) <= 12
    bought = {(x.customer_id, x.article_id) for x in data.inter.collect()}
    assert any((x.customer_id, x.article_id) not in bought for x in test)
    assert weekly.evaluate(data.inter, made.valid, t.anchor).first()["map"] > 0


def test_list_ranker_learns(spark):
    from basketry.operators.ranking import ListwiseRanker

    rng = random.Random(2)
    rows = []
    for cust in range(40):
        good = rng.randint(0, 9)
        rows += [(2, cust, k, float(k == good) * 2 + rng.random(), rng.random(), int(k == good)) for k in range(10)]
    df = spark.createDataFrame(rows, "week int, customer_id int, article_id int, x double, noise double, label int")
    scored = ListwiseRanker(["x", "noise"], rounds=5, depth=3, step=0.5).fit(df).transform(df)
    best = scored.groupBy("customer_id").agg(F.max_by("label", "prob").alias("hit")).agg(F.avg("hit")).first()[0]
    assert best > 0.95
