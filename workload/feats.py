"""Weekly sales features, history features and feature assembly, on order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.operators import assemble, features as f
from basketry.operators.preprocess import with_product

from .registry import query
from .tables import EV, EVA, ITEM, TX, TXA, with_

WEEKS = 6
BASE = f"""{TX},
{TXA},
base AS (SELECT tx.*, CAST(floor((anchor - t_dat) / 7) AS INTEGER) AS week, 1 AS valid FROM tx, a),
{ITEM},
pb AS (SELECT base.*, product_code, product_type_no FROM base LEFT JOIN item USING (article_id)),
wk AS (SELECT CAST(unnest(range(1, {WEEKS + 1})) AS INTEGER) AS w)"""


def base(t):
    return cal.with_week(t.tx, t.tx_anchor).withColumn("valid", F.lit(1))


def product_base(t):
    return with_product(base(t), t.item, ["product_code", "product_type_no"])


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("f01_full_sale", with_(BASE) + """
SELECT article_id, w AS week, count(*) AS sale FROM pb JOIN wk ON week >= w GROUP BY ALL""")
def f01(t):
    return f.full_sale(base(t), "article_id", week_num=WEEKS)


@query("f01_full_sale_unique", with_(BASE) + """
SELECT product_code, w AS week, count(*) AS sale
FROM (SELECT DISTINCT customer_id, week, product_code FROM pb) JOIN wk ON week >= w GROUP BY ALL""")
def f01_unique(t):
    return f.full_sale(product_base(t), "product_code", unique=True, week_num=WEEKS)


@query("f02_week_sale", with_(BASE) + """
SELECT article_id, week - 1 AS week, count(*) AS sale FROM pb WHERE week <= 9 GROUP BY ALL""")
def f02(t):
    return f.week_sale(base(t), "article_id", step=1, week_num=WEEKS)


@query("f02_week_sale_unique", with_(BASE) + """
SELECT product_code, week, count(*) AS sale FROM (
  SELECT customer_id, product_code, max(week) AS week FROM pb WHERE week <= 8 GROUP BY ALL) GROUP BY ALL""")
def f02_unique(t):
    return f.week_sale(product_base(t), "product_code", unique=True, week_num=WEEKS)


def period_cte(unit: str, days: int) -> str:
    return f"""ps AS (SELECT {unit}, w AS week, count(*) AS sale FROM pb, a, wk
  WHERE t_dat >= anchor - (7 * w - 1) - {days + 1} AND t_dat < anchor - (7 * w - 1) GROUP BY ALL),
pr AS (SELECT *, rank() OVER (PARTITION BY week ORDER BY sale DESC)
         + (count(*) OVER (PARTITION BY week, sale) - 1) / 2 AS sale_rank,
         sale / sum(sale) OVER (PARTITION BY week) AS sale_norm FROM ps)"""


@query("f03_period_sale", with_(BASE, period_cte("article_id", 14)) + """
SELECT article_id, week, sale, sale_rank, round(sale_norm, 9) AS sale_norm FROM pr""")
def f03(t):
    out = f.period_sale(base(t), "article_id", t.tx_anchor, 14, rank=True, norm=True, week_num=WEEKS)
    return rounded(out, "sale_norm", digits=9)


@query("f03_period_sale_unique", with_(BASE) + """
SELECT product_code, w AS week, count(*) AS sale FROM (
  SELECT customer_id, product_code, min(t_dat) AS t_dat FROM pb GROUP BY ALL), a, wk
WHERE t_dat >= anchor - (7 * w - 1) - 29 AND t_dat < anchor - (7 * w - 1) GROUP BY ALL""")
def f03_unique(t):
    return f.period_sale(product_base(t), "product_code", t.tx_anchor, 28, unique=True, week_num=WEEKS)


REPURCHASE = """rp AS (SELECT {unit}, w AS week, count(*) FILTER (n > 1) / (count(*) + 1e-6) AS ratio FROM (
  SELECT customer_id, {unit}, w, count(*) AS n FROM pb JOIN wk ON week >= w GROUP BY ALL) GROUP BY ALL)"""


@query("f04_repurchase_ratio", with_(BASE, REPURCHASE.format(unit="article_id")) + """
SELECT article_id, week, round(ratio, 6) AS ratio FROM rp""")
def f04(t):
    return rounded(f.repurchase_ratio(base(t), "article_id", WEEKS), "ratio")


@query("f04_repurchase_ratio_product", with_(BASE, REPURCHASE.format(unit="product_code")) + """
SELECT product_code, week, round(ratio, 6) AS ratio FROM rp""")
def f04_product(t):
    return rounded(f.repurchase_ratio(product_base(t), "product_code", WEEKS), "ratio")


@query("f05_popularity", with_(BASE) + """
SELECT article_id, w AS week, round(sum(1 / (date_diff('day', t_dat, last) + 1)), 6) AS popularity
FROM pb JOIN (SELECT w, max(t_dat) AS last FROM pb JOIN wk ON week >= w GROUP BY w) ON week >= w GROUP BY article_id, w""")
def f05(t):
    return rounded(f.popularity(base(t), "article_id", WEEKS), "popularity")


GRID = f"""wanted AS (SELECT DISTINCT article_id FROM pb),
cell AS (SELECT article_id, CAST(i AS INTEGER) AS week FROM wanted, range(1, {WEEKS + 2}) r(i)),
gr AS (
  SELECT customer_id, c.article_id, t_dat, price, sales_channel_id, c.week, coalesce(valid, 0) AS valid
  FROM cell c LEFT JOIN base b ON b.article_id = c.article_id AND b.week = c.week
  UNION ALL SELECT customer_id, article_id, t_dat, price, sales_channel_id, week, valid FROM base WHERE week > {WEEKS + 1}),
gd AS (SELECT gr.* REPLACE (CASE WHEN valid = 0 THEN anchor - (7 * week - 1) ELSE t_dat END AS t_dat) FROM gr, a)"""


def grid(t):
    rows = cal.with_week(t.tx, t.tx_anchor)
    items = rows.select("article_id")
    return f.feature_grid(rows, items, WEEKS)


@query("f06_feature_grid", with_(BASE, GRID) + "SELECT * FROM gr")
def f06(t):
    return grid(t)


@query("f07_days_since_first_sale", with_(BASE, GRID) + """
SELECT article_id, w AS week, date_diff('day', min(t_dat), any_value(anchor) - (7 * w - 1)) AS first_dat
FROM gd, a, wk GROUP BY article_id, w""")
def f07(t):
    first = f.first_sale(f.date_fillers(grid(t), t.tx_anchor))
    weeks = first.select("article_id", "first_date", F.explode(F.sequence(F.lit(1), F.lit(WEEKS))).alias("week"))
    return weeks.select("article_id", "week", f.days_since("first_date", "week", t.tx_anchor).alias("first_dat"))


EPS = "0.000001"


def _cnt(unit: str, name: str, lag: int, unique: bool, weeks: int) -> str:
    rows = (f"(SELECT customer_id, {unit}, max(week) AS week FROM gp WHERE valid = 1 AND week <= {weeks + lag + 2} GROUP BY ALL)"
            if unique else f"(SELECT * FROM gp WHERE valid = 1 AND week <= {weeks + lag + 2})")
    return f"{name} AS (SELECT {unit}, week - {lag} AS week, count(*) AS {name} FROM {rows} GROUP BY ALL)"


def _per(unit: str, pre: str, days: int) -> str:
    w = days // 7
    return f"""{pre}_{w}w AS (SELECT {unit}, w AS week, count(*) AS s FROM gp, a, wk
  WHERE valid = 1 AND t_dat >= anchor - (7 * w - 1) - {days + 1} AND t_dat < anchor - (7 * w - 1) GROUP BY ALL),
{pre}_{w}wr AS (SELECT {unit}, week, s AS {pre}_{w}w_sale, rank() OVER (PARTITION BY week ORDER BY s DESC)
  + (count(*) OVER (PARTITION BY week, s) - 1) / 2 AS {pre}_{w}w_sale_rank,
  s / sum(s) OVER (PARTITION BY week) AS {pre}_{w}w_sale_norm FROM {pre}_{w}w)"""


def item_week_sql(weeks: int = WEEKS) -> str:
    """The item-week table with one CTE and one join per feature."""
    kind = "product_type_no"
    units = {"i": "article_id", "p": "product_code"}
    ctes, joins, numbers = [], [], []
    for pre, unit in units.items():
        for days in (14, 21, 28):
            ctes.append(_per(unit, pre, days))
            joins.append((f"{pre}_{days // 7}wr", unit))
            numbers += [f"{pre}_{days // 7}w_sale{x}" for x in ("", "_rank", "_norm")]
        for lag, lw in ((0, ""), (1, "lw_")):
            for uni in (False, True):
                name = f"{lw}{pre}_sale{'_uni' if uni else ''}"
                ctes.append(_cnt(unit, name, lag, uni, weeks))
                joins.append((name, unit))
                numbers.append(name)
        ctes.append(f"""{pre}_rr AS (SELECT {unit}, w AS week, count(*) FILTER (n > 1) / (count(*) + 1e-6) AS {pre}_repurchase_ratio
  FROM (SELECT customer_id, {unit}, w, count(*) AS n FROM gp JOIN wk ON week >= w WHERE valid = 1 GROUP BY ALL) GROUP BY ALL)""")
        ctes.append(f"""{pre}_pp AS (SELECT {unit}, w AS week, sum(1 / (date_diff('day', t_dat, last) + 1)) AS {pre}_pop FROM gp
  JOIN (SELECT w, max(t_dat) AS last FROM gp JOIN wk ON week >= w WHERE valid = 1 GROUP BY w) ON week >= w WHERE valid = 1 GROUP BY {unit}, w)""")
        joins += [(f"{pre}_rr", unit), (f"{pre}_pp", unit)]
        numbers += [f"{pre}_repurchase_ratio", f"{pre}_pop"]
    for lag, lw in ((0, ""), (1, "lw_")):
        ctes.append(_cnt(kind, f"{lw}{kind}_sale", lag, True, weeks))
        joins.append((f"{lw}{kind}_sale", kind))
        numbers.append(f"{lw}{kind}_sale")
    for pre, unit in {**units, kind: kind}.items():
        ctes.append(f"{pre}_fs AS (SELECT {unit}, w AS week, count(*) AS {pre}_full_sale FROM gp JOIN wk ON week >= w WHERE valid = 1 GROUP BY ALL)")
        joins.append((f"{pre}_fs", unit))
        numbers.append(f"{pre}_full_sale")
    for pre, unit in (("i", "article_id"), (kind, kind)):
        name = "first_dat" if pre == "i" else f"{kind}_first_dat"
        ctes.append(f"""{pre}_fd AS (SELECT {unit}, w AS week, date_diff('day', min(t_dat), any_value(anchor) - (7 * w - 1)) AS {name}
  FROM gpd, a, wk GROUP BY {unit}, w)""")
        if pre != "i":
            joins.append((f"{pre}_fd", unit))
    body = "\n".join(f"LEFT JOIN {n} USING ({u}, week)" for n, u in joins)
    filled = ", ".join(f"coalesce({n}, 0) AS {n}" for n in numbers)
    return f"""gp AS (SELECT gr.*, product_code, product_type_no FROM gr LEFT JOIN item USING (article_id)),
gpd AS (SELECT gd.*, product_code, product_type_no FROM gd LEFT JOIN item USING (article_id)),
{", ".join(ctes)},
raw AS (SELECT article_id, product_code, {kind}, week, first_dat, {kind}_first_dat, {filled}
  FROM i_fd JOIN item USING (article_id)
{body}),
d AS (SELECT *, i_full_sale / nullif(first_dat, 0) AS i_daily_sale, p_full_sale / nullif(first_dat, 0) AS p_daily_sale,
  {kind}_full_sale / nullif({kind}_first_dat, 0) AS {kind}_daily_sale FROM raw),
iw AS (SELECT article_id, product_code, week, first_dat,
  {", ".join(n for n in numbers if not n.endswith("full_sale"))},
  i_daily_sale, p_daily_sale, {kind}_daily_sale,
  i_sale / (p_sale + {EPS}) AS i_sale_ratio, i_sale_uni / (p_sale_uni + {EPS}) AS i_sale_uni_ratio,
  lw_i_sale / (lw_p_sale + {EPS}) AS lw_i_sale_ratio, lw_i_sale_uni / (lw_p_sale_uni + {EPS}) AS lw_i_sale_uni_ratio,
  i_sale / (i_sale_uni + {EPS}) AS i_uni_ratio, p_sale / (p_sale_uni + {EPS}) AS p_uni_ratio,
  lw_i_sale / (lw_i_sale_uni + {EPS}) AS lw_i_uni_ratio, lw_p_sale / (lw_p_sale_uni + {EPS}) AS lw_p_uni_ratio,
  (i_sale - lw_i_sale) / (lw_i_sale + {EPS}) AS i_sale_trend, (p_sale - lw_p_sale) / (lw_p_sale + {EPS}) AS p_sale_trend,
  ({kind}_sale - lw_{kind}_sale) / (lw_{kind}_sale + {EPS}) AS {kind}_sale_trend,
  i_daily_sale / nullif(p_daily_sale, 0) AS i_daily_sale_ratio,
  i_sale / nullif(i_full_sale, 0) AS i_w_full_sale_ratio, i_2w_sale / nullif(i_full_sale, 0) AS i_2w_full_sale_ratio,
  p_sale / nullif(p_full_sale, 0) AS p_w_full_sale_ratio, p_2w_sale / nullif(p_full_sale, 0) AS p_2w_full_sale_ratio,
  i_sale / 7 - i_daily_sale AS i_week_above_daily_sale, p_sale / 7 - i_full_sale AS p_week_above_full_sale,
  i_2w_sale / 14 - i_daily_sale AS i_2w_week_above_daily_sale, p_2w_sale / 14 - p_daily_sale AS p_2w_week_above_daily_sale,
  i_daily_sale / nullif({kind}_daily_sale, 0) AS i_{kind}_daily_sale_ratio,
  p_daily_sale / nullif({kind}_daily_sale, 0) AS p_{kind}_daily_sale_ratio FROM d)"""


KEYS = ["article_id", "product_code", "week", "first_dat"]
SALE_RATIOS = [
    "i_sale_ratio", "i_sale_uni_ratio", "lw_i_sale_ratio", "lw_i_sale_uni_ratio", "i_uni_ratio", "p_uni_ratio",
    "lw_i_uni_ratio", "lw_p_uni_ratio", "i_daily_sale", "p_daily_sale", "i_daily_sale_ratio",
    "i_w_full_sale_ratio", "i_2w_full_sale_ratio", "p_w_full_sale_ratio", "p_2w_full_sale_ratio",
    "i_week_above_daily_sale", "p_week_above_full_sale", "i_2w_week_above_daily_sale", "p_2w_week_above_daily_sale",
    "i_4w_sale_norm", "p_3w_sale_rank", "i_pop", "p_repurchase_ratio"]
TRENDS = ["i_sale_trend", "p_sale_trend"]
TYPES = ["product_type_no_sale", "lw_product_type_no_sale", "product_type_no_daily_sale",
         "i_product_type_no_daily_sale_ratio", "p_product_type_no_daily_sale_ratio", "product_type_no_sale_trend"]


def _rounded_sql(columns: list[str], digits: int) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def item_week(t):
    return f.item_week_features(grid(t), t.item, t.tx_anchor, WEEKS)


@query("f08_item_week_ratios", with_(BASE, GRID, item_week_sql()) + f"""
SELECT {", ".join(KEYS)}, {_rounded_sql(SALE_RATIOS, 6)}, {_rounded_sql(TRENDS, 0)} FROM iw""")
def f08(t):
    out = rounded(item_week(t), *SALE_RATIOS)
    return rounded(out, *TRENDS, digits=0).select(*KEYS, *SALE_RATIOS, *TRENDS)


@query("f09_item_week_types", with_(BASE, GRID, item_week_sql()) + f"""
SELECT {", ".join(KEYS)}, {_rounded_sql(TYPES, 6)} FROM iw""")
def f09(t):
    return rounded(item_week(t), *TYPES).select(*KEYS, *TYPES)


# ---------------------------------------------------------------- history

PAST = "past AS (SELECT * FROM pb WHERE week > 5)"


def past(t):
    return base(t).filter(F.col("t_dat") < cal.week_start(5, t.tx_anchor))


@query("f10_item_mean_week", with_(BASE, PAST) + """
SELECT article_id, round(avg(week), 6) AS article_time_mean FROM past GROUP BY article_id""")
def f10(t):
    return rounded(f.item_mean_week(past(t)), "article_time_mean")


@query("f11_customer_weeks", with_(BASE, PAST) + """
SELECT customer_id, min(week) AS customer_id_last_time, max(week) AS customer_id_first_time,
       round(avg(week), 6) AS customer_id_time_mean, max(week) - min(week) AS customer_id_gap
FROM past GROUP BY customer_id""")
def f11(t):
    return rounded(f.customer_history(past(t)).drop("customer_daily_bought"), "customer_id_time_mean")


@query("f12_customer_rate", with_(BASE, PAST) + """
SELECT customer_id, round(count(*) / nullif(max(week) - min(week), 0), 6) AS customer_daily_bought
FROM past GROUP BY customer_id""")
def f12(t):
    return rounded(f.customer_history(past(t)).select("customer_id", "customer_daily_bought"), "customer_daily_bought")


@query("f13_customer_median_price", with_(BASE, PAST) + """
SELECT customer_id, round(median(price), 4) AS customer_id_price_median FROM past GROUP BY customer_id""")
def f13(t):
    return rounded(f.customer_median_price(past(t)), "customer_id_price_median", digits=4)


YEAR = """yr AS (SELECT article_id, i AS week, count(*) AS article_id_week_shift52 FROM past, range(1, 6) r(i)
  WHERE week >= i + 1 AND week < i + 54 GROUP BY ALL),
yp AS (SELECT product_code, i AS week, count(*) AS product_code_week_shift52 FROM past, range(1, 6) r(i)
  WHERE week >= i + 1 AND week < i + 54 GROUP BY ALL)"""


@query("f14_trailing_year_items", with_(BASE, PAST, YEAR) + "SELECT * REPLACE (CAST(week AS INTEGER) AS week) FROM yr")
def f14(t):
    return f.trailing_year(past(t), "article_id", "article_id_week_shift52")


@query("f14_trailing_year_products", with_(BASE, PAST, YEAR) + "SELECT * REPLACE (CAST(week AS INTEGER) AS week) FROM yp")
def f14_product(t):
    return f.trailing_year(with_product(past(t), t.item), "product_code", "product_code_week_shift52")


@query("f15_year_ratio", with_(BASE, PAST, YEAR) + """
SELECT article_id, CAST(week AS INTEGER) AS week, round(i_sale / article_id_week_shift52, 6) AS "article_id_week_1/52",
       round(i_sale / product_code_week_shift52, 6) AS "product_code_week_1/52"
FROM (SELECT article_id, product_code, week, count(*) AS i_sale FROM pb WHERE week BETWEEN 1 AND 5 GROUP BY ALL)
LEFT JOIN yr USING (article_id, week) LEFT JOIN yp USING (product_code, week)""")
def f15(t):
    before = with_product(past(t), t.item)
    rows = with_product(
        f.week_sale(base(t), "article_id", week_num=5).filter(F.col("week").between(1, 5)), t.item
    ).withColumnRenamed("sale", "i_sale")
    rows = rows.join(f.trailing_year(before, "article_id", "article_id_week_shift52"), ["article_id", "week"], "left")
    rows = rows.join(f.trailing_year(before, "product_code", "product_code_week_shift52"), ["product_code", "week"], "left")
    out = ["article_id_week_1/52", "product_code_week_1/52"]
    rows = f.year_ratios(rows)
    return rows.select("article_id", "week", *[F.round(F.col(f"`{c}`"), 6).alias(c) for c in out])


@query("f16_fill_missing", """
SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 4 = 0 THEN 0 WHEN c_custkey % 4 = 1 THEN 0 ELSE c_acctbal END AS x,
       CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_nationkey END AS k FROM customer""")
def f16(t):
    key = F.col("c_custkey")
    rows = t.table("customer").select(
        key.alias("customer_id"),
        F.when(key % 4 == 0, F.lit(float("nan"))).when(key % 4 == 1, F.lit(None)).otherwise(F.col("c_acctbal")).alias("x"),
        F.when(key % 5 != 0, F.col("c_nationkey")).alias("k"))
    return f.fill_missing(rows)


# ---------------------------------------------------------------- assembly

@query("j01_lagged_item_row", with_(BASE) + """
SELECT article_id, CAST(week - 1 AS INTEGER) AS week, max_by(price, k) AS price, max_by(sales_channel_id, c) AS sales_channel_id,
       max(t_dat) AS t_dat
FROM (SELECT *, (t_dat, customer_id, price) AS k, (t_dat, customer_id, sales_channel_id) AS c FROM pb)
GROUP BY article_id, week""")
def j01(t):
    return assemble.lag_week(assemble.last_item_row(base(t)))


CANDS = """cd AS (SELECT DISTINCT customer_id, article_id, w AS week FROM ev, a, (SELECT unnest([1, 2, 3]) AS w)
  WHERE t_dat < anchor - 7 * w - 6)"""


def event_candidates(t):
    """Items a customer bought before each of the weeks 1 to 3."""
    out = None
    for w in (1, 2, 3):
        rows = t.ev.filter(F.col("t_dat") < cal.week_start(w, t.anchor)).select("customer_id", "article_id").distinct()
        rows = rows.withColumn("week", F.lit(w))
        out = rows if out is None else out.unionByName(rows)
    return out


EV_LABELS = """el AS (SELECT DISTINCT customer_id, article_id, CAST(floor((anchor - t_dat) / 7) AS INTEGER) AS week FROM ev, a)"""


def event_labels(t):
    return cal.with_week(t.ev, t.anchor).select("customer_id", "article_id", "week").distinct()


@query("j02_attach_labels", with_(EV, EVA, CANDS, EV_LABELS) + """
SELECT cd.customer_id, cd.article_id, cd.week, CASE WHEN el.customer_id IS NULL THEN 0 ELSE 1 END AS label
FROM cd LEFT JOIN el USING (customer_id, article_id, week)
WHERE (cd.customer_id, cd.week) IN (SELECT (customer_id, week) FROM el)""")
def j02(t):
    return assemble.attach_labels(event_candidates(t), event_labels(t))


@query("j03_attach_features", with_(EV, EVA, CANDS, ITEM, """seg AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS segment FROM customer)""", """
iw AS (SELECT article_id, CAST(floor((anchor - t_dat) / 7) AS INTEGER) AS week, count(*) AS i_sale FROM ev, a GROUP BY ALL)""") + """
SELECT customer_id, article_id, cd.week, i_sale, segment, product_type_no, product_group_name
FROM cd LEFT JOIN (SELECT article_id, week - 1 AS week, i_sale FROM iw) USING (article_id, week)
LEFT JOIN seg USING (customer_id) LEFT JOIN item USING (article_id)""")
def j03(t):
    sales = cal.with_week(t.ev, t.anchor).groupBy("article_id", "week").agg(F.count("*").alias("i_sale"))
    return assemble.attach_features(
        event_candidates(t), sales, t.segments, t.item, ["segment"], ["product_type_no", "product_group_name"])


@query("j04_embedding_similarity", with_(EV) + """
SELECT customer_id, article_id, round(list_sum(list_transform(range(1, 65), lambda i: u.embedding[i]::DOUBLE * v.embedding[i]::DOUBLE)), 6) AS similarity
FROM (SELECT DISTINCT customer_id, article_id FROM ev) LEFT JOIN embeddings u ON u.vec_id = customer_id + 380
LEFT JOIN embeddings v ON v.vec_id = article_id""")
def j04(t):
    pairs = t.ev.select("customer_id", "article_id").distinct()
    users = t.vectors.select((F.col("id") - 380).alias("id"), "vec")
    return rounded(assemble.embedding_similarity(pairs, users, t.vectors, "similarity"), "similarity")


@query("j05_category_codes", with_(ITEM) + """
SELECT article_id, CAST(dense_rank() OVER (ORDER BY CAST(product_code AS VARCHAR)) - 1 AS INTEGER) AS product_code,
       CAST(dense_rank() OVER (ORDER BY product_group_name) - 1 AS INTEGER) AS product_group_name FROM item""")
def j05(t):
    columns = ["product_code", "product_group_name"]
    model = assemble.fit_category_codes(t.item, columns)
    return assemble.apply_category_codes(t.item.select("article_id", *columns), model)
