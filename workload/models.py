"""Vectors, TF-IDF, ranking models and full weekly runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.functions.tables import durable
from basketry.operators import assemble, blend, embeddings as e, ranking as m
from basketry.plans import candidates as plans
from basketry.plans import full_run, weekly
from basketry.schema import ITEM_CODE_COLUMNS, ITEM_FEATURES, Dataset

from .collecting import cut_cte
from .feats import CANDS, EV_LABELS, event_candidates, event_labels, item_week_sql
from .prep import AGE_BIN, GENDER, IMPUTED, SEASON, USER_CODED, USER_GENDER, _codes
from .registry import query
from .rules import decay_cte, pair_cte
from .tables import EV, EVA, ITEM, TX, USER, with_

DIM = 64


def round_vec(df, digits=6):
    return df.withColumn("vec", F.transform("vec", lambda x: F.round(x, digits)))


def sql_round_vec(expr: str, digits: int = 6) -> str:
    return f"list_transform({expr}, lambda x: round(x, {digits}))"


# ---------------------------------------------------------------- vectors

@query("e02_item_vectors")
def e02(t):
    return round_vec(e.train_item_vectors(t.ev, size=16, window=8, epochs=2))


VEC = "vec AS (SELECT vec_id AS id, unnest(range(1, 65)) AS k, unnest(embedding)::DOUBLE AS x, label FROM embeddings)"
UNIT = """SELECT id, list(round(x / norm, 6) ORDER BY k) AS vec
FROM (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY id)) AS norm FROM s) GROUP BY id"""


@query("e03_customer_vectors", with_(EV, VEC, """
s AS (SELECT customer_id AS id, k, avg(x) AS x FROM ev JOIN vec ON vec.id = article_id GROUP BY ALL)""", f"u AS ({UNIT})") + """
SELECT c_custkey AS id, coalesce(vec, list_transform(range(0, 64), lambda i: round(1 / 64, 6))) AS vec
FROM customer LEFT JOIN u ON id = c_custkey""")
def e03(t):
    users = t.table("customer").select(F.col("c_custkey").alias("customer_id"))
    return round_vec(e.customer_vectors(t.ev, t.vectors.select("id", "vec"), users, DIM))


@query("e04_unit_item_vectors", with_(VEC, """
s AS (SELECT p_partkey AS id, coalesce(k, j) AS k, coalesce(x, 1 / 64) AS x FROM
  (SELECT p_partkey, unnest(range(1, 65)) AS j FROM part) LEFT JOIN vec ON id = p_partkey AND k = j)""") + UNIT)
def e04(t):
    items = t.table("part").select(F.col("p_partkey").alias("article_id"))
    return round_vec(e.unit_item_vectors(t.vectors.select("id", "vec"), items, DIM))


@query("e05_product_vectors", with_(ITEM, VEC, """
s AS (SELECT product_code AS id, k, sum(x) AS x FROM item JOIN vec ON id = article_id GROUP BY ALL)""") + UNIT)
def e05(t):
    return round_vec(e.product_vectors(t.vectors.select("id", "vec"), t.item))


def tfidf_sql(counts: str, documents: str) -> str:
    return f"""cn AS ({counts}),
df AS (SELECT term, count(*) AS df FROM cn GROUP BY term HAVING count(*) >= 3),
w AS (SELECT id, term, n * (ln((1 + (SELECT count(*) FROM {documents})) / (1 + df)) + 1) AS w FROM cn JOIN df USING (term))
SELECT id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM w"""


ITEM_TEXT = """tk AS (SELECT article_id AS id, unnest(regexp_extract_all(lower(concat_ws(' ', product_type_name,
  product_group_name, department_name, index_group_name, coalesce(detail_desc, ''))), '[\\p{L}\\p{N}_]{2,}')) AS term FROM item)"""
NAMES = ["product_type_name", "product_group_name", "department_name", "index_group_name", "detail_desc"]


def rounded_weight(df):
    return df.withColumn("weight", F.round("weight", 6))


@query("e06_item_text_tfidf", with_(ITEM, ITEM_TEXT) + ", " + tfidf_sql(
    "SELECT id, term, count(*) AS n FROM tk GROUP BY ALL", "item"))
def e06(t):
    return rounded_weight(e.tfidf(e.text_counts(t.item, "article_id", NAMES), t.item))


@query("e06_document_tfidf", """
WITH tk AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM documents), """ + tfidf_sql(
    "SELECT id, term, count(*) AS n FROM tk GROUP BY ALL", "documents"))
def e06_documents(t):
    docs = t.table("documents")
    return rounded_weight(e.tfidf(e.text_counts(docs, "doc_id", ["text"]), docs))


@query("e07_item_customer_tfidf", with_(EV) + ", " + tfidf_sql(
    "SELECT article_id AS id, CAST(customer_id AS VARCHAR) AS term, count(*) AS n FROM ev WHERE customer_id >= 10 GROUP BY ALL",
    "(SELECT DISTINCT article_id FROM ev)"))
def e07(t):
    counts = e.id_counts(t.ev, "article_id", "customer_id")
    return rounded_weight(e.tfidf(counts, t.ev.select("article_id").distinct()))


@query("e08_customer_product_tfidf", with_(TX, ITEM) + ", " + tfidf_sql(
    """SELECT customer_id AS id, CAST(product_code AS VARCHAR) AS term, count(*) AS n FROM tx JOIN item USING (article_id)
       WHERE product_code >= 10 GROUP BY ALL""", "(SELECT DISTINCT customer_id FROM tx)"))
def e08(t):
    from basketry.operators.preprocess import with_product

    rows = with_product(t.tx, t.item)
    counts = e.id_counts(rows, "customer_id", "product_code")
    return rounded_weight(e.tfidf(counts, rows.select("customer_id").distinct()))


@query("e09_truncated_svd")
def e09(t):
    counts = e.id_counts(t.ev, "article_id", "customer_id")
    matrix = e.tfidf(counts, t.ev.select("article_id").distinct())
    vectors, _ = e.truncated_svd(matrix, 8, iterations=3, oversample=4)
    items = t.table("part").select(F.col("p_partkey").alias("id"))
    return round_vec(e.with_fallback(vectors, items, e.uniform(8)), 4)


# ---------------------------------------------------------------- training rows

CD = f"""{EV},
{EVA},
own AS (SELECT customer_id, article_id, week, count(*) AS bought, avg(price) AS spent,
    date_diff('day', max(t_dat), start) AS age
  FROM ev JOIN (SELECT w AS week, anchor - CAST(7 * w + 6 AS INTEGER) AS start FROM a, (SELECT unnest([1, 2, 3]) AS w))
  ON t_dat < start GROUP BY customer_id, article_id, week, start),
el AS (SELECT DISTINCT customer_id, article_id, CAST(floor((anchor - t_dat) / 7) AS INTEGER) AS week FROM ev, a),
rows AS (SELECT own.*, CASE WHEN el.customer_id IS NULL THEN 0 ELSE 1 END AS label
  FROM own LEFT JOIN el USING (customer_id, article_id, week)
  WHERE (own.customer_id, own.week) IN (SELECT (customer_id, week) FROM el))"""


def small_rows(t):
    """Items bought before weeks 1 to 3 with simple features and labels."""
    out = None
    for w in (1, 2, 3):
        start = cal.week_start(w, t.anchor)
        rows = t.ev.filter(F.col("t_dat") < start).groupBy("customer_id", "article_id").agg(
            F.count("*").alias("bought"), F.avg("price").alias("spent"),
            F.datediff(start, F.max("t_dat")).alias("age")).withColumn("week", F.lit(w))
        out = rows if out is None else out.unionByName(rows)
    return assemble.attach_labels(out, event_labels(t))


FEATURES = ["bought", "spent", "age"]


@query("m01_train_valid", with_(CD) + """
SELECT CASE WHEN week > 1 THEN 'train' ELSE 'valid' END AS part, count(*) AS n_rows, sum(label)::BIGINT AS positives FROM rows GROUP BY 1""")
def m01(t):
    rows = small_rows(t)
    parts = m.train_rows(rows).withColumn("part", F.lit("train")).unionByName(
        m.valid_rows(rows).withColumn("part", F.lit("valid")))
    return parts.groupBy("part").agg(F.count("*").alias("n_rows"), F.sum("label").alias("positives"))


@query("m02_groups_with_positives", with_(CD) + """
SELECT customer_id, article_id, week, label FROM rows
WHERE week > 1 AND (week, customer_id) IN (SELECT (week, customer_id) FROM rows WHERE label = 1)""")
def m02(t):
    return m.groups_with_positives(m.train_rows(small_rows(t))).select("customer_id", "article_id", "week", "label")


@query("m03_group_sizes", with_(CD) + "SELECT week, customer_id, count(*) AS size FROM rows GROUP BY ALL")
def m03(t):
    return m.group_sizes(small_rows(t))


def fitted(t):
    rows = small_rows(t)
    return rows, m.fit_boosted_classifier(m.train_rows(rows), FEATURES, rounds=5, depth=3, step=0.3)


@query("m04_boosted_classifier")
def m04(t):
    rows, model = fitted(t)
    scored = m.score(model, m.valid_rows(rows), FEATURES)
    return scored.select("customer_id", "article_id", F.round("prob", 6).alias("prob"))


@query("m05_list_ranker")
def m05(t):
    rows = small_rows(t)
    ranker = m.ListwiseRanker(FEATURES, rounds=4, depth=3, step=0.3).fit(m.train_rows(rows))
    return ranker.transform(m.valid_rows(rows)).select("customer_id", "article_id", F.round("prob", 6).alias("prob"))


@query("m06_dense_classifier")
def m06(t):
    rows = assemble.attach_vectors(small_rows(t), t.vectors.select("id", "vec"), DIM, "item_vec")
    model = m.fit_dense_classifier(m.train_rows(rows), FEATURES, ["item_vec"], hidden=(16, 8), width=DIM, iterations=15)
    scored = m.score(model, m.valid_rows(rows), FEATURES, ["item_vec"])
    return scored.select("customer_id", "article_id", F.round("prob", 6).alias("prob"))


@query("m07_score_candidates")
def m07(t):
    rows, model = fitted(t)
    scored = m.score(model, rows, FEATURES)
    return scored.groupBy("week").agg(
        F.count("*").alias("n_rows"), F.round(F.min("prob"), 6).alias("lowest"), F.round(F.max("prob"), 6).alias("highest"))


# a fixed formula stands for a model, so that lists have an exact SQL form
PROB = "round(bought / (1 + age) + spent / 1000, 6)"


def scored_rows(t):
    prob = F.round(F.col("bought") / (1 + F.col("age")) + F.col("spent") / 1000, 6)
    return small_rows(t).withColumn("prob", prob)


@query("m08_best_scores", with_(CD) + f"SELECT customer_id, article_id, max({PROB}) AS prob FROM rows GROUP BY ALL")
def m08(t):
    return blend.best_scores(scored_rows(t))


@query("m09_prediction_lists", with_(CD) + f"""
SELECT customer_id, list(article_id ORDER BY rank) AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY prob DESC, article_id) AS rank
  FROM (SELECT customer_id, article_id, max({PROB}) AS prob FROM rows GROUP BY ALL)) WHERE rank <= 12 GROUP BY customer_id""")
def m09(t):
    return blend.as_arrays(blend.ranked_lists(blend.best_scores(scored_rows(t))))


@query("m10_feature_importance")
def m10(t):
    _, model = fitted(t)
    rows = [(i + 1, name, round(v, 6)) for i, (name, v) in enumerate(m.feature_importance(model, FEATURES))]
    return t.spark.createDataFrame(rows, "place int, feature string, importance double")


@query("m11_positive_rate", with_(CD) + "SELECT round(avg(label), 6) AS positive_rate FROM rows WHERE week > 1")
def m11(t):
    return m.positive_rate(m.train_rows(small_rows(t))).withColumn("positive_rate", F.round("positive_rate", 6))


# ---------------------------------------------------------------- full runs

def event_dataset(t) -> Dataset:
    """Event log with user and item attributes as codes."""
    from basketry.operators import preprocess as p

    item = p.with_item_flags(t.item)
    inter = t.ev.withColumn("sales_channel_id", F.lit(1)).withColumn("price", F.col("price").cast("double"))
    user = p.with_user_gender(t.user, inter, item)
    return Dataset(user=p.encode_users(user), item=p.encode_items(item), inter=inter)


def _first_strategy_sql(min_rate: float) -> str:
    """All sixteen rules of the first strategy for week 1, scaled, cut and pivoted."""
    def own(days: int, name: str) -> str:
        return f"SELECT customer_id, article_id, 'OrderHistory_{name}' AS method, CAST(-gap AS DOUBLE) AS score FROM h0 WHERE gap < {days}"

    def decayed(prefix: str) -> str:
        return f"""{prefix}d AS (SELECT customer_id, article_id, s FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY round(s, 6) DESC, article_id) AS k
  FROM (SELECT customer_id, article_id, sum(value) AS s FROM {prefix}v GROUP BY ALL)) WHERE k <= 50 AND s > 150)"""

    def pairs(prefix: str, name: str) -> str:
        return f"""SELECT customer_id, pair, 'ItemPairRetrieve_{name}', CAST(max(score) AS DOUBLE)
  FROM {prefix}o JOIN {prefix}fp USING (article_id) GROUP BY customer_id, pair"""

    def group_top(source: str, name: str) -> str:
        return f"""SELECT customer_id, article_id, 'UGTimeHistory_{name}', CAST(n AS DOUBLE) FROM served LEFT JOIN ub USING (customer_id)
  LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY age_bins ORDER BY n DESC, article_id) AS k FROM (
    SELECT age_bins, article_id, count(*) AS n FROM (SELECT DISTINCT customer_id, article_id, age_bins FROM {source})
    WHERE age_bins IS NOT NULL GROUP BY ALL)) WHERE k <= 50) USING (age_bins)"""

    def top(source: str, name: str) -> str:
        return f"""SELECT customer_id, article_id, 'TimeHistory_{name}', CAST(n AS DOUBLE) FROM served, (
  SELECT article_id, count(*) AS n FROM (SELECT DISTINCT customer_id, article_id FROM {source}) GROUP BY article_id
  ORDER BY n DESC, article_id LIMIT 50)"""

    def top_decay(prefix: str, name: str) -> str:
        return f"""SELECT customer_id, article_id, 'TimeHistoryDecay_{name}', s FROM served, (
  SELECT article_id, sum(value) AS s FROM {prefix}v GROUP BY article_id ORDER BY round(s, 6) DESC, article_id LIMIT 50)"""

    counts = """count(*) FILTER (gap <= 6) AS x, count(*) FILTER (gap > 6) AS y
  FROM (SELECT *, date_diff('day', t_dat, (SELECT max(t_dat) FROM train)) AS gap FROM tu) WHERE gap <= 13"""
    ctes = [
        EV, EVA, USER,
        "train AS (SELECT ev.* FROM ev, a WHERE t_dat < anchor - 13)",
        "held AS (SELECT ev.* FROM ev, a WHERE t_dat >= anchor - 13 AND t_dat < anchor - 6)",
        "lab AS (SELECT DISTINCT customer_id, article_id FROM held)",
        "served AS (SELECT DISTINCT customer_id FROM held)",
        f"ub AS (SELECT customer_id, {AGE_BIN} AS age_bins FROM (SELECT customer_id, coalesce(age, 0) AS age FROM usr))",
        "tu AS (SELECT train.*, age_bins FROM train LEFT JOIN ub USING (customer_id))",
        "lw AS (SELECT tu.* FROM tu, a WHERE t_dat >= anchor - 20)",
        "l3 AS (SELECT tu.* FROM tu, a WHERE t_dat >= anchor - 16)",
        """h0 AS (SELECT customer_id, article_id, min(gap) AS gap FROM (
  SELECT *, date_diff('day', t_dat, max(t_dat) OVER (PARTITION BY customer_id)) AS gap FROM train) GROUP BY ALL)""",
        "h1 AS (SELECT * FROM h0 WHERE gap < 3)", "h2 AS (SELECT * FROM h0 WHERE gap < 7)",
        decay_cte("train", 3, "x"), decay_cte("train", 7, "y"), decayed("x"), decayed("y"),
        pair_cte("h1", "pa"), pair_cte("h2", "pb"), pair_cte("xd", "pc_"), pair_cte("yd", "pd"),
        f"gn AS (SELECT age_bins, article_id, {counts} AND age_bins IS NOT NULL GROUP BY ALL)",
        f"tn AS (SELECT article_id, {counts} GROUP BY ALL)",
        "cand AS (" + "\nUNION ALL ".join([
            own(3, "1"), own(7, "2"),
            "SELECT customer_id, article_id, 'OrderHistoryDecay_1', s FROM xd",
            "SELECT customer_id, article_id, 'OrderHistoryDecay_2', s FROM yd",
            pairs("pa", "1"), pairs("pb", "2"), pairs("pc_", "3"), pairs("pd", "4"),
            group_top("lw", "1"), group_top("l3", "2"),
            """SELECT customer_id, article_id, 'UGSaleTrend_1', trend FROM served LEFT JOIN ub USING (customer_id) LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY age_bins ORDER BY x DESC, trend DESC, article_id) AS k
    FROM (SELECT *, (x - y) / (y + 1) AS trend FROM gn WHERE x > 0 AND y > 0) WHERE trend > 0) WHERE k <= 50) USING (age_bins)""",
            top("lw", "1"), top("l3", "2"), top_decay("x", "1"), top_decay("y", "2"),
            """SELECT customer_id, article_id, 'SaleTrend_1', trend FROM served, (
  SELECT *, (x - y) / y AS trend FROM tn WHERE x > 0 AND y > 0 AND (x - y) / y > 0 ORDER BY x DESC, trend DESC, article_id LIMIT 50)""",
        ]) + ")",
        """mm AS (SELECT customer_id, article_id, method, CASE WHEN score IS NOT NULL THEN
  coalesce((score - min(score) OVER (PARTITION BY method))
    / nullif(max(score) OVER (PARTITION BY method) - min(score) OVER (PARTITION BY method), 0), 0) END AS score FROM cand)""",
        cut_cte("mm", min_rate),
    ]
    columns = ", ".join(f"round(sum(score) FILTER (method = '{m_}'), 6) AS {m_}" for m_ in plans.FIRST_METHODS)
    return with_(*ctes) + f"SELECT customer_id, article_id, {columns} FROM kept WHERE article_id IS NOT NULL GROUP BY customer_id, article_id"


# no item of the event log is out of stock: all sell in its only month
@query("w01_first_strategy_week", _first_strategy_sql(0.12))
def w01(t):
    data = event_dataset(t)
    wide = plans.first_strategy(data, 1, t.anchor, norm_type="minmax", trend=0.0, min_pos_rate=0.12)
    return wide.select("customer_id", "article_id", *[F.round(x, 6).alias(x) for x in plans.FIRST_METHODS])


@query("w02_second_strategy_week")
def w02(t):
    data = event_dataset(t)
    wide = plans.second_strategy(
        data, 1, t.anchor, n=30, factors=(8, 8), iterations=(3, 2), top_k=10, limit=50)
    return wide.select("customer_id", "article_id", F.round("score", 4).alias("score"), F.round("rank", 1).alias("rank"))


def training(t):
    data = event_dataset(t)
    cands = event_candidates(t)
    vectors = {"wv": (t.vectors.select("id", "vec"), t.vectors.select("id", "vec"))}
    return data, weekly.training_rows(data, cands, t.anchor, 4, vectors, extended=True)


def _training_sql(weeks: int) -> str:
    """Labels, lagged item weeks, user and item codes, similarity and history in one statement."""
    ctes = [
        EV, EVA, TX, USER, ITEM.replace("item AS (", "raw_item AS (", 1),
        f"""item AS (SELECT article_id, {_codes('raw_item', ITEM_CODE_COLUMNS)}, {GENDER} AS article_gender,
  {SEASON} AS season_type FROM raw_item)""",
        USER_GENDER.replace("FROM tx", "FROM ev").replace("FROM item)", "FROM raw_item)"), IMPUTED,
        f"""users AS (SELECT customer_id, {_codes('imp', USER_CODED)}, CAST(age AS INTEGER) AS age,
  CASE WHEN f >= 0.8 THEN 2 WHEN m >= 0.8 THEN 1 ELSE 0 END AS user_gender FROM imp LEFT JOIN ug USING (customer_id))""",
        "base AS (SELECT ev.*, CAST(floor((anchor - t_dat) / 7) AS INTEGER) AS week, 1 AS valid FROM ev, a)",
        f"wk AS (SELECT CAST(unnest(range(1, {weeks + 1})) AS INTEGER) AS w)",
        CANDS, EV_LABELS,
        "wanted AS (SELECT DISTINCT article_id FROM cd)",
        f"cell AS (SELECT article_id, CAST(i AS INTEGER) AS week FROM wanted, range(1, {weeks + 2}) r(i))",
        f"""gr AS (
  SELECT customer_id, c.article_id, t_dat, price, c.week, coalesce(valid, 0) AS valid
  FROM cell c LEFT JOIN base b ON b.article_id = c.article_id AND b.week = c.week
  UNION ALL SELECT customer_id, article_id, t_dat, price, week, valid FROM base WHERE week > {weeks + 1})""",
        "gd AS (SELECT gr.* REPLACE (CASE WHEN valid = 0 THEN anchor - (7 * week - 1) ELSE t_dat END AS t_dat) FROM gr, a)",
        item_week_sql(weeks),
        "lastp AS (SELECT article_id, week, max_by(price, (t_dat, customer_id, price)) AS price FROM base GROUP BY ALL)",
        f"past AS (SELECT base.*, product_code FROM base LEFT JOIN item USING (article_id) WHERE week > {weeks - 1})",
        "am AS (SELECT article_id, avg(week) AS article_time_mean FROM past GROUP BY ALL)",
        """ch AS (SELECT customer_id, min(week) AS customer_id_last_time, max(week) AS customer_id_first_time,
  avg(week) AS customer_id_time_mean, max(week) - min(week) AS customer_id_gap,
  count(*) / nullif(max(week) - min(week), 0) AS customer_daily_bought, median(price) AS customer_id_price_median
  FROM past GROUP BY customer_id)""",
        """y1 AS (SELECT article_id, i AS week, count(*) AS article_id_week_shift52 FROM past, range(1, 6) r(i)
  WHERE week >= i + 1 AND week < i + 54 GROUP BY ALL)""",
        """y2 AS (SELECT product_code, i AS week, count(*) AS product_code_week_shift52 FROM past, range(1, 6) r(i)
  WHERE week >= i + 1 AND week < i + 54 GROUP BY ALL)""",
        f"""full_rows AS (
  SELECT cd.customer_id, cd.article_id, cd.week, CASE WHEN el.customer_id IS NULL THEN 0 ELSE 1 END AS label,
    iw.* EXCLUDE (article_id, week), lastp.price, users.* EXCLUDE (customer_id),
    {", ".join("item." + c for c in ITEM_FEATURES)}, am.article_time_mean, ch.* EXCLUDE (customer_id),
    list_sum(list_transform(range(1, 65), lambda i: u.embedding[i]::DOUBLE * v.embedding[i]::DOUBLE)) AS wv_similarity,
    customer_id_price_median - lastp.price AS customer_article_price_gap,
    article_id_week_shift52, product_code_week_shift52,
    i_sale / article_id_week_shift52 AS "article_id_week_1/52", i_sale / product_code_week_shift52 AS "product_code_week_1/52"
  FROM cd LEFT JOIN el ON el.customer_id = cd.customer_id AND el.article_id = cd.article_id AND el.week = cd.week
  LEFT JOIN iw ON iw.article_id = cd.article_id AND iw.week = cd.week + 1
  LEFT JOIN lastp ON lastp.article_id = cd.article_id AND lastp.week = cd.week + 1
  LEFT JOIN users ON users.customer_id = cd.customer_id LEFT JOIN item ON item.article_id = cd.article_id
  LEFT JOIN am ON am.article_id = cd.article_id LEFT JOIN ch ON ch.customer_id = cd.customer_id
  LEFT JOIN embeddings u ON u.vec_id = cd.customer_id LEFT JOIN embeddings v ON v.vec_id = cd.article_id
  LEFT JOIN y1 ON y1.article_id = cd.article_id AND y1.week = cd.week
  LEFT JOIN y2 ON y2.product_code = iw.product_code AND y2.week = cd.week
  WHERE (cd.customer_id, cd.week) IN (SELECT (customer_id, week) FROM el))""",
    ]
    return with_(*ctes) + """SELECT customer_id, article_id, week, label,
  round(CAST(COLUMNS(* EXCLUDE (customer_id, article_id, week, label, product_code)) AS DOUBLE), 3) FROM full_rows"""


@query("w03_training_rows", _training_sql(4))
def w03(t):
    _, rows = training(t)
    numbers = weekly.model_features(rows)
    return rows.select("customer_id", "article_id", "week", "label", *[
        F.round(F.col(f"`{c}`").cast("double"), 3).alias(c) for c in numbers])


@query("w04_rank_blend_submit")
def w04(t):
    data, rows = training(t)
    rows = durable(rows)
    ranker, model = weekly.rank_both(rows, rounds=3, depth=3)
    valid = m.valid_rows(rows)
    scored = [ranker.transform(valid), m.score(model, valid, weekly.model_features(rows))]
    fused = weekly.blend_predictions(scored, (1.0, 1.3))
    people = t.table("customer")
    user_map = people.select(F.col("c_name").alias("id"), F.col("c_custkey").alias("index"))
    item_map = t.item.select(F.col("article_id").alias("id"), F.col("article_id").alias("index"))
    return weekly.submit(fused, people.select(F.col("c_custkey").alias("customer_id")), user_map, item_map)


# The presets of both strategies: lists of 200, 200 and 300 factors, 25 and 350 iterations, 20 related items, quantile scaling,
# trends over 0.8, a rate of 0.006. 350 iterations go over a block's pairs 175 times per shuffle. The models have fewer rounds.
PRESET = full_run.Settings(rounds=8, depth=4, parallel=6, second={
    "n": 200, "factors": (200, 300), "iterations": (25, 350), "top_k": 20, "limit": 200, "passes": 175})


@query("w05_two_strategy_run")
def w05(t):
    """Both strategies over weeks 2 (training), 1 (validation) and 0, four ranked lists, fused and decoded."""
    data = event_dataset(t)
    data = Dataset(*(durable(x) for x in (data.user, data.item, data.inter)))
    vectors = {"wv": (t.vectors.select("id", "vec"), t.vectors.select("id", "vec"))}
    made = full_run.run(data, t.anchor, (2,), settings=PRESET, vectors=vectors)
    people = t.table("customer")
    user_map = people.select(F.col("c_name").alias("id"), F.col("c_custkey").alias("index"))
    item_map = t.item.select(F.col("article_id").alias("id"), F.col("article_id").alias("index"))
    parts = []
    for week, fused, ids in ((1, made.valid, made.valid.select("customer_id").distinct()), (0, made.test, data.user.select("customer_id"))):
        parts.append(weekly.submit(fused, ids, user_map, item_map).withColumn("week", F.lit(week)))
    return parts[0].unionByName(parts[1])
