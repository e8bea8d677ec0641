"""Sources, sinks and preprocessing."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions import calendar as cal
from basketry.operators import preprocess as p
from basketry.operators.sequences import item_lists
from basketry.plans import preprocessing as prep
from basketry.schema import Dataset
from basketry.sources import raw, stages

from .registry import query
from .tables import EV, EVA, ITEM, TX, TXA, USER, with_

ITEM_TYPES = {
    c: T.StringType() for c in (
        "product_type_name", "product_group_name", "department_name", "index_code", "index_group_name", "detail_desc")}


def raw_dataset(t) -> Dataset:
    """Tables with original ids: customer names and ten-digit item numbers."""
    names = t.table("customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("_id"))
    user = t.user.join(names, "customer_id").withColumn("customer_id", F.col("_id")).drop("_id")
    item = t.item.withColumn("article_id", F.col("article_id") + 100000000)
    inter = t.tx.join(names, "customer_id").select(
        F.col("_id").alias("customer_id"), (F.col("article_id") + 100000000).alias("article_id"),
        "t_dat", "price", "sales_channel_id")
    return Dataset(user=user, item=item, inter=inter)


RAW_TX = f"""{TX},
raw_tx AS (SELECT c_name AS customer_id, article_id + 100000000 AS article_id, t_dat, price, sales_channel_id
           FROM tx JOIN customer ON c_custkey = customer_id)"""


def _csv(t) -> str:
    data, folder = raw_dataset(t), t.stage_path()
    for df, name in ((data.user, "customers"), (data.item, "articles"), (data.inter, "transactions_train")):
        df.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}.csv")
    return folder


@query("s01_read_raw_csv", with_(RAW_TX) + """
SELECT article_id, count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers, min(t_dat) AS first_day,
       round(sum(price), 2) AS total FROM raw_tx GROUP BY article_id""")
def s01(t):
    data = raw_dataset(t)
    back = raw.read_raw(t.spark, _csv(t), data.user.schema, data.item.schema, data.inter.schema)
    return back.inter.groupBy("article_id").agg(
        F.count("*").alias("n_rows"), F.countDistinct("customer_id").alias("n_customers"),
        F.min("t_dat").alias("first_day"), F.round(F.sum("price"), 2).alias("total"))


@query("s01_read_raw_items", with_(ITEM) + "SELECT * REPLACE (article_id + 100000000 AS article_id) FROM item")
def s01_items(t):
    data = raw_dataset(t)
    return raw.read_raw(t.spark, _csv(t), data.user.schema, data.item.schema, data.inter.schema).item


@query("s02_save_dataset", with_(USER) + "SELECT * FROM usr")
def s02(t):
    folder = t.stage_path()
    stages.save_dataset(Dataset(t.user, t.item, t.ev), folder)
    return t.spark.read.parquet(f"{folder}/user.parquet")


@query("s03_load_dataset", with_(EV) + """
SELECT article_id, count(*) AS n_rows, round(sum(price), 2) AS total FROM ev GROUP BY article_id""")
def s03(t):
    folder = t.stage_path()
    stages.save_dataset(Dataset(t.user, t.item, t.ev), folder)
    inter = stages.load_dataset(t.spark, folder).inter
    return inter.groupBy("article_id").agg(F.count("*").alias("n_rows"), F.round(F.sum("price"), 2).alias("total"))


@query("s04_submission_customers", """
SELECT c_name AS id, CASE WHEN c_custkey % 2 = 0 THEN row_number() OVER (PARTITION BY c_custkey % 2 ORDER BY c_name) END
       AS customer_id FROM customer""")
def s04(t):
    path = t.stage_path()
    customers = t.table("customer")
    customers.select(F.col("c_name").alias("customer_id"), F.lit("0").alias("prediction")).write.option(
        "header", True).csv(path)
    mapped = p.id_map(customers.filter(F.col("c_custkey") % 2 == 0), "c_name")
    return raw.read_submission_customers(t.spark, path, mapped)


@query("s05_week_stages", with_(EV, EVA) + """
SELECT CAST(floor((anchor - t_dat) / 7) AS INTEGER) AS week, count(*) AS n_rows,
       count(DISTINCT customer_id) AS n_customers
FROM ev, a WHERE floor((anchor - t_dat) / 7) IN (1, 3) GROUP BY ALL""")
def s05(t):
    path = t.stage_path()
    stages.save_week(cal.with_week(t.ev, t.anchor), path)
    return stages.load_weeks(t.spark, path, [1, 3]).groupBy("week").agg(
        F.count("*").alias("n_rows"), F.countDistinct("customer_id").alias("n_customers"))


@query("s06_load_vectors", "SELECT vec_id AS id, embedding AS vec FROM embeddings")
def s06(t):
    return raw.read_vectors(t.spark, f"{t.sf_dir}/embeddings.parquet", "vec_id", "embedding")


@query("s07_write_submission", """
SELECT c_name AS customer_id, '0' || c_custkey || ' 0' || (c_custkey + 1) AS prediction FROM customer""")
def s07(t):
    path = t.stage_path()
    key = F.col("c_custkey")
    stages.write_submission(t.table("customer").select(
        F.col("c_name").alias("customer_id"),
        F.concat(F.lit("0"), key, F.lit(" 0"), key + 1).alias("prediction")), path)
    return t.spark.read.option("header", True).csv(path)


@query("p01_encode_ids", with_(RAW_TX) + """,
um AS (SELECT c_name AS id, row_number() OVER (ORDER BY c_name) AS ix FROM customer),
im AS (SELECT p_partkey + 100000000 AS id, row_number() OVER (ORDER BY p_partkey) AS ix FROM part)
SELECT CAST(um.ix AS INTEGER) AS customer_id, CAST(im.ix AS INTEGER) AS article_id, t_dat, price, sales_channel_id
FROM raw_tx LEFT JOIN um ON um.id = customer_id LEFT JOIN im ON im.id = article_id""".replace("\n,\num", ",\num"))
def p01(t):
    data = raw_dataset(t)
    user_map, item_map = p.id_map(data.user, "customer_id"), p.id_map(data.item, "article_id")
    return p.encode_dataset(data, user_map, item_map).inter


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


GENDER = f"""CASE WHEN index_group_name = 'Ladieswear' THEN 2 WHEN index_group_name = 'Menswear' THEN 1
  WHEN contains(lower(department_name), 'girl') OR contains(lower(department_name), 'ladies')
    OR product_type_name IN {_in(p.FEMALE_PRODUCT_TYPES)} THEN 2
  WHEN contains(lower(department_name), 'boy') OR contains(lower(department_name), 'men') THEN 1 ELSE 0 END"""
SEASON = f"""CASE WHEN product_type_name IN {_in(p.WINTER_PRODUCT_TYPES)} THEN 2
  WHEN product_type_name IN {_in(p.SUMMER_PRODUCT_TYPES)} THEN 1 ELSE 0 END"""
USER_GENDER = f"""g AS (SELECT article_id, {GENDER} AS article_gender FROM item),
ug AS (SELECT customer_id, avg(CASE WHEN article_gender = 1 THEN 1 ELSE 0 END) AS m,
              avg(CASE WHEN article_gender = 2 THEN 1 ELSE 0 END) AS f
       FROM tx LEFT JOIN g USING (article_id) GROUP BY customer_id)"""


@query("p02_article_gender", with_(ITEM) + f"SELECT article_id, {GENDER} AS article_gender FROM item")
def p02(t):
    return t.item.select("article_id", p.article_gender().alias("article_gender"))


@query("p03_season_type", with_(ITEM) + f"SELECT article_id, {SEASON} AS season_type FROM item")
def p03(t):
    return t.item.select("article_id", p.season_type().alias("season_type"))


@query("p04_user_gender", with_(ITEM, TX, USER, USER_GENDER) + """
SELECT customer_id, CASE WHEN f >= 0.8 THEN 2 WHEN m >= 0.8 THEN 1 ELSE 0 END AS user_gender
FROM usr LEFT JOIN ug USING (customer_id)""")
def p04(t):
    item = p.with_item_flags(t.item)
    return p.with_user_gender(t.user, t.tx, item).select("customer_id", "user_gender")


IMPUTED = """imp AS (SELECT customer_id, coalesce(FN, -1) AS FN, coalesce(Active, -1) AS Active,
  coalesce(club_member_status, '-1') AS club_member_status,
  coalesce(fashion_news_frequency, '-1') AS fashion_news_frequency, coalesce(age, 0) AS age FROM usr)"""


@query("p05_impute_users", with_(USER, IMPUTED) + "SELECT * FROM imp")
def p05(t):
    return p.impute_users(t.user)


def _codes(table: str, columns: list[str]) -> str:
    return ", ".join(f"CAST(dense_rank() OVER (ORDER BY CAST({c} AS VARCHAR)) AS INTEGER) AS {c}" for c in columns)


USER_CODED = ["FN", "Active", "club_member_status", "fashion_news_frequency"]


@query("p06_label_encode", with_(ITEM) + f"SELECT article_id, {_codes('item', p.ITEM_CODE_COLUMNS)} FROM item")
def p06(t):
    return p.label_encode(t.item.select("article_id", *p.ITEM_CODE_COLUMNS), p.ITEM_CODE_COLUMNS, "article_id")


@query("p07_narrow_transactions", with_(TX) + """
SELECT customer_id, article_id, t_dat, CAST(price AS FLOAT) AS price, CAST(sales_channel_id AS TINYINT) AS sales_channel_id
FROM tx""")
def p07(t):
    return p.narrow_transactions(t.tx)


@query("p08_preprocess_users", with_(ITEM, TX, USER, USER_GENDER, IMPUTED) + f"""
SELECT CAST(row_number() OVER (ORDER BY c_name) AS INTEGER) AS customer_id, {_codes('imp', USER_CODED)},
       CAST(age AS INTEGER) AS age, CASE WHEN f >= 0.8 THEN 2 WHEN m >= 0.8 THEN 1 ELSE 0 END AS user_gender
FROM imp JOIN customer ON c_custkey = customer_id LEFT JOIN ug USING (customer_id)""")
def p08_users(t):
    return p.preprocess(raw_dataset(t)).user


@query("p08_preprocess_items", with_(ITEM) + f"""
SELECT CAST(row_number() OVER (ORDER BY article_id) AS INTEGER) AS article_id, {_codes('item', p.ITEM_CODE_COLUMNS)},
       {GENDER} AS article_gender, {SEASON} AS season_type FROM item""")
def p08_items(t):
    return p.preprocess(raw_dataset(t)).item


@query("p08_preprocess_saved", with_(RAW_TX) + """
SELECT CAST(sales_channel_id AS TINYINT) AS sales_channel_id, count(*) AS n_rows,
       count(DISTINCT customer_id) AS n_customers, count(DISTINCT article_id) AS n_items
FROM raw_tx GROUP BY sales_channel_id""")
def p08_saved(t):
    data = raw_dataset(t)
    done = prep.run(
        t.spark, _csv(t), t.stage_path(), data.user.schema, data.item.schema, data.inter.schema)
    return done.inter.groupBy("sales_channel_id").agg(
        F.count("*").alias("n_rows"), F.countDistinct("customer_id").alias("n_customers"),
        F.countDistinct("article_id").alias("n_items"))


@query("p09_split_train", with_(EV, EVA) + """
SELECT customer_id, article_id, t_dat, price FROM ev, a WHERE t_dat < anchor - 13""")
def p09_train(t):
    return p.split(t.ev, cal.week_start(1, t.anchor), cal.week_end(1, t.anchor))[0]


@query("p09_split_labels", with_(EV, EVA) + """
SELECT customer_id, list(article_id ORDER BY t_dat, article_id) AS article_id
FROM ev, a WHERE t_dat >= anchor - 13 AND t_dat < anchor - 6 GROUP BY customer_id""")
def p09_labels(t):
    return p.label_lists(p.split(t.ev, cal.week_start(1, t.anchor), cal.week_end(1, t.anchor))[1])


@query("p10_week_dates", with_(EV, EVA, "w AS (SELECT unnest(range(0, 6)) AS week)") + """
SELECT CAST(week AS INTEGER) AS week, anchor - CAST(7 * week - 1 AS INTEGER) - 7 AS start_date,
       anchor - CAST(7 * week - 1 AS INTEGER) AS end_date,
       (SELECT count(*) FROM ev WHERE t_dat >= anchor - CAST(7 * week - 1 AS INTEGER) - 7
          AND t_dat < anchor - CAST(7 * week - 1 AS INTEGER)) AS n_rows
FROM w, a""")
def p10(t):
    weeks = cal.week_table(t.spark, t.anchor, range(0, 6))
    counts = cal.with_week(t.ev, t.anchor).groupBy("week").agg(F.count("*").alias("n_rows"))
    return weeks.join(counts, "week", "left").fillna({"n_rows": 0})


@query("p11_week_number", with_(TX, TXA) + """
SELECT CAST(floor((anchor - t_dat) / 7) AS INTEGER) AS week, count(*) AS n_rows, min(t_dat) AS first_day,
       max(t_dat) AS last_day FROM tx, a GROUP BY ALL""")
def p11(t):
    return cal.with_week(t.tx, t.tx_anchor).groupBy("week").agg(
        F.count("*").alias("n_rows"), F.min("t_dat").alias("first_day"), F.max("t_dat").alias("last_day"))


AGE_BIN = """CASE WHEN age <= -1 THEN NULL WHEN age <= 19 THEN 1 WHEN age <= 29 THEN 2 WHEN age <= 39 THEN 3
  WHEN age <= 49 THEN 4 WHEN age <= 59 THEN 5 WHEN age <= 69 THEN 6 WHEN age <= 119 THEN 7 END"""


@query("p12_age_bins", with_(USER) + f"SELECT customer_id, age, {AGE_BIN} AS age_bins FROM usr")
def p12(t):
    return t.user.select("customer_id", "age", p.age_bin("age").alias("age_bins"))


ABILITY = """m AS (SELECT customer_id, avg(price) AS mean FROM tx GROUP BY customer_id),
e AS (SELECT quantile_cont(mean, [0.2, 0.4, 0.6, 0.8]) AS q FROM m),
ability AS (SELECT customer_id, CAST(len(list_filter(q, lambda x: mean > x)) AS INTEGER) AS purchase_ability FROM m, e)"""


@query("p13_purchase_ability", with_(TX, ABILITY) + "SELECT * FROM ability")
def p13(t):
    return p.purchase_ability(t.tx)


@query("p14_recent_slices", with_(TX, TXA) + """
SELECT 'before_start' AS kind, d AS days, count(*) AS n_rows, count(DISTINCT article_id) AS n_items
FROM tx, a, (SELECT unnest([3, 7]) AS d) WHERE t_dat < anchor - 13 AND t_dat >= anchor - 13 - CAST(d AS INTEGER) GROUP BY ALL
UNION ALL
SELECT 'from_last_row', d, count(*), count(DISTINCT article_id)
FROM tx, a, (SELECT unnest([7, 14, 60, 80]) AS d)
WHERE t_dat < anchor - 13 AND t_dat > (SELECT max(t_dat) FROM tx, a WHERE t_dat < anchor - 13) - CAST(d AS INTEGER)
GROUP BY ALL""")
def p14(t):
    start = cal.week_start(1, t.tx_anchor)
    train = t.tx.filter(F.col("t_dat") < start)
    parts = [("before_start", d, cal.recent(train, d, start)) for d in (3, 7)]
    parts += [("from_last_row", d, cal.recent(train, d)) for d in (7, 14, 60, 80)]
    out = None
    for kind, d, rows in parts:
        one = rows.agg(F.count("*").alias("n_rows"), F.countDistinct("article_id").alias("n_items")).select(
            F.lit(kind).alias("kind"), F.lit(d).alias("days"), "n_rows", "n_items")
        out = one if out is None else out.unionByName(one)
    return out


@query("p15_narrow_types", with_(USER) + """
SELECT customer_id, coalesce(FN, 0) AS FN, coalesce(Active, 0) AS Active, club_member_status, fashion_news_frequency,
       coalesce(age, (SELECT min(age) - 1 FROM usr)) AS age FROM usr""")
def p15(t):
    return p.narrow_types(t.user)[0]


@query("p16_product_code", with_(EV, ITEM) + """
SELECT customer_id, article_id, t_dat, price, product_code FROM ev LEFT JOIN item USING (article_id)""")
def p16(t):
    return p.with_product(t.ev, t.item)


@query("e01_item_sequences", with_(TX) + """
SELECT customer_id, list(article_id ORDER BY t_dat, article_id) AS article_id
FROM tx WHERE t_dat < DATE '2001-01-01' GROUP BY customer_id""")
def e01(t):
    return item_lists(t.tx.filter(F.col("t_dat") < F.lit("2001-01-01").cast("date")))
