"""Candidate rules on the event log, and on order lines where months are needed."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.operators import rules as r
from basketry.operators.rules import base
from basketry.operators.rules.decay import sale_values
from basketry.operators.rules.pairs import frequent_pairs
from basketry.operators.rules.popular import item_pool

from .registry import query
from .tables import EV, SEG, TX, with_

CUSTOMERS = "c AS (SELECT c_custkey AS customer_id FROM customer)"
BUYERS = "b AS (SELECT DISTINCT customer_id FROM ev)"


def customers(t):
    return t.table("customer").select(F.col("c_custkey").alias("customer_id"))


def buyers(t):
    return t.ev.select("customer_id").distinct()


def rounded(df, digits=6):
    return df.withColumn("score", F.round("score", digits))


# ---------------------------------------------------------------- own history

HISTORY = """h AS (
  SELECT customer_id, article_id, min(date_diff('day', t_dat, last)) AS gap
  FROM (SELECT *, max(t_dat) OVER (PARTITION BY customer_id) AS last FROM ev)
  GROUP BY customer_id, article_id)"""


@query("r01_order_history", with_(EV, HISTORY) + """
SELECT customer_id, article_id, 'OrderHistory_1' AS method, CAST(-gap AS DOUBLE) AS score FROM h WHERE gap < 7""")
def r01(t):
    return r.OrderHistory(t.ev, days=7).retrieve()


@query("r01_order_history_top", with_(EV, HISTORY) + """
SELECT customer_id, article_id, 'OrderHistory_n' AS method, CAST(-gap AS DOUBLE) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY gap, article_id) AS k FROM h WHERE gap < 14)
WHERE k <= 5""")
def r01_top(t):
    return r.OrderHistory(t.ev, days=14, n=5, name="n").retrieve()


def decay_cte(source: str, days: int, prefix: str = "") -> str:
    return f"""{prefix}g AS (SELECT *, date_diff('day', t_dat, (SELECT max(t_dat) FROM {source})) AS gap FROM {source}),
{prefix}p AS (SELECT article_id, gap // {days} AS period, count(*) AS period_sale FROM {prefix}g GROUP BY ALL),
{prefix}v AS (
  SELECT g.customer_id, g.article_id, g.t_dat,
         greatest(0, 25000 / sqrt(greatest(gap, 1)) + 150000 * exp(-0.2 * greatest(gap, 1)) - 1000)
         * (coalesce(z.period_sale, 0) / p.period_sale) AS value
  FROM {prefix}g g JOIN {prefix}p p ON p.article_id = g.article_id AND p.period = gap // {days}
  LEFT JOIN {prefix}p z ON z.article_id = g.article_id AND z.period = 0)"""


@query("r02_order_history_decay", with_(EV, decay_cte("ev", 7)) + """
SELECT customer_id, article_id, 'OrderHistoryDecay_1' AS method, round(sum(value), 3) AS score
FROM v GROUP BY customer_id, article_id HAVING sum(value) > 150""")
def r02(t):
    return rounded(r.OrderHistoryDecay(t.ev, days=7).retrieve(), 3)


@query("r02_order_history_decay_top", with_(TX, decay_cte("tx", 30)) + """
SELECT customer_id, article_id, 'OrderHistoryDecay_n' AS method, round(value, 3) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY round(value, 6) DESC, article_id) AS k
  FROM (SELECT customer_id, article_id, sum(value) AS value FROM v GROUP BY ALL))
WHERE k <= 5 AND value > 150""")
def r02_top(t):
    return rounded(r.OrderHistoryDecay(t.tx, days=30, n=5, name="n").retrieve(), 3)


def pair_cte(source: str, prefix: str = "") -> str:
    return f"""{prefix}o AS (SELECT DISTINCT customer_id, article_id FROM {source}),
{prefix}pc AS (SELECT x.article_id, y.article_id AS pair, count(*) AS n FROM {prefix}o x JOIN {prefix}o y
       ON x.customer_id = y.customer_id AND x.article_id <> y.article_id GROUP BY ALL),
{prefix}fp AS (SELECT article_id, pair, n AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY n DESC, pair) AS k FROM {prefix}pc) WHERE k = 1)"""


RECENT_OWN = "rec AS (SELECT customer_id, article_id FROM h WHERE gap < 7)"
PAIR_RESULT = """SELECT customer_id, pair AS article_id, 'ItemPairRetrieve_{name}' AS method, CAST(max(score) AS DOUBLE) AS score
FROM o JOIN fp USING (article_id) GROUP BY customer_id, pair"""


@query("r03_item_pair", with_(EV, HISTORY, RECENT_OWN, pair_cte("rec")) + PAIR_RESULT.format(name="1"))
def r03(t):
    return r.ItemPair(r.OrderHistory(t.ev, days=7).retrieve()).retrieve()


@query("r03_item_pair_large_baskets", with_(TX, pair_cte("tx")) + PAIR_RESULT.format(name="2"))
def r03_large(t):
    return r.ItemPair(t.tx, name="2", large=45).retrieve()


@query("r19_frequent_pairs", with_(EV, pair_cte("ev")) + "SELECT article_id, pair, score FROM fp")
def r19(t):
    return frequent_pairs(t.ev)


# ---------------------------------------------------------------- item-to-item

def cf_cte(history: str, k: int, group: str = "", least: int = 5) -> str:
    g = f"{group}, " if group else ""
    same = f"AND x.{group} = y.{group}" if group else ""
    on = f"s.{group}, " if group else ""
    return f"""sq AS (SELECT {g}customer_id, article_id,
         row_number() OVER (PARTITION BY {g}customer_id ORDER BY t_dat, article_id) AS pos,
         count(*) OVER (PARTITION BY {g}customer_id) AS len FROM {history}),
sim AS (SELECT {"x." + g if g else ""}x.article_id AS src, y.article_id AS dst,
         sum((CASE WHEN y.pos > x.pos THEN 1.0 ELSE 0.9 END) * pow(0.7, abs(y.pos - x.pos) - 1) / ln(1 + x.len)) AS sim
       FROM sq x JOIN sq y ON x.customer_id = y.customer_id {same} AND x.pos <> y.pos AND x.pos < x.len GROUP BY ALL),
best AS (SELECT {g}src, dst, sim FROM (
  SELECT *, row_number() OVER (PARTITION BY {g}src ORDER BY round(sim, 9) DESC, dst) AS k,
         count(*) OVER (PARTITION BY {g}src) AS related FROM sim) WHERE related >= {least} AND k <= {k})"""


LAST14 = "tg AS (SELECT * FROM ev WHERE t_dat > (SELECT max(t_dat) FROM ev) - 14)"


@query("r08_item_similarity", with_(TX, cf_cte("tx", 20)) + "SELECT src, dst, round(sim, 6) AS sim FROM best")
def r08_sim(t):
    from basketry.operators.rules.itemcf import similar_items

    return similar_items(t.tx).withColumn("sim", F.round("sim", 6))


@query("r08_item_cf", with_(EV, LAST14, cf_cte("ev", 10)) + """
SELECT customer_id, dst AS article_id, 'ItemCF_1' AS method, round(sim, 6) AS score FROM tg JOIN best ON article_id = src""")
def r08(t):
    return rounded(r.ItemCF(t.ev, cal.recent(t.ev, 14), top_k=10).retrieve())


@query("r08_item_cf_merged", with_(EV, LAST14, cf_cte("ev", 10)) + """
SELECT customer_id, dst AS article_id, 'ItemCF_m' AS method, round(sum(sim), 6) AS score
FROM tg JOIN best ON article_id = src GROUP BY customer_id, dst""")
def r08_merged(t):
    return rounded(r.ItemCF(t.ev, cal.recent(t.ev, 14), top_k=10, name="m", merge=True).retrieve())


SEG_EV = "es AS (SELECT ev.*, segment FROM ev LEFT JOIN seg USING (customer_id))"
SEG_TG = "tg AS (SELECT * FROM es WHERE t_dat > (SELECT max(t_dat) FROM es) - 14)"


@query("r09_user_group_item_cf", with_(EV, SEG, SEG_EV, SEG_TG, cf_cte("es", 10, "segment")) + """
SELECT customer_id, dst AS article_id, 'UGItemCF_1' AS method, round(sim, 6) AS score
FROM tg JOIN best ON article_id = src AND tg.segment = best.segment""")
def r09(t):
    rows = t.ev.join(t.segments, "customer_id", "left")
    return rounded(r.UserGroupItemCF(rows, cal.recent(rows, 14), "segment", top_k=10).retrieve())


# ---------------------------------------------------------------- groups

GROUP_TOP = """u AS (SELECT DISTINCT customer_id, article_id, segment FROM es),
gt AS (SELECT segment, article_id, n FROM (
  SELECT *, row_number() OVER (PARTITION BY segment ORDER BY n DESC, article_id) AS k
  FROM (SELECT segment, article_id, count(*) AS n FROM u WHERE segment IS NOT NULL GROUP BY ALL)) WHERE k <= 12)"""


@query("r10_user_group_time_history", with_(EV, SEG, SEG_EV, GROUP_TOP, CUSTOMERS) + """
SELECT customer_id, article_id, 'UGTimeHistory_1' AS method, CAST(n AS DOUBLE) AS score
FROM c LEFT JOIN seg USING (customer_id) LEFT JOIN gt USING (segment)""")
def r10(t):
    return r.UserGroupTimeHistory(t.segments, customers(t), t.ev, ("segment",), n=12.5).retrieve()


@query("r10_user_group_scaled", with_(EV, SEG, SEG_EV, GROUP_TOP, CUSTOMERS) + """
SELECT customer_id, article_id, 'UGTimeHistory_s' AS method, round(n / (SELECT max(n) FROM gt), 6) AS score
FROM c LEFT JOIN seg USING (customer_id) LEFT JOIN gt USING (segment)""")
def r10_scaled(t):
    return rounded(r.UserGroupTimeHistory(
        t.segments, customers(t), t.ev, ("segment",), n=12, name="s", scale=True).retrieve())


@query("r11_user_group_sale_trend", with_(EV, SEG, SEG_EV, CUSTOMERS) + """,
g AS (SELECT *, date_diff('day', t_dat, (SELECT max(t_dat) FROM ev)) AS gap FROM es),
n AS (SELECT segment, article_id, count(*) FILTER (gap <= 6) AS x, count(*) FILTER (gap > 6 AND gap <= 13) AS y
      FROM g WHERE gap <= 13 GROUP BY ALL),
tr AS (SELECT *, (x - y) / (y + 1) AS trend FROM n WHERE x > 0 AND y > 0 AND segment IS NOT NULL),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY x DESC, trend DESC, article_id) AS k
        FROM tr WHERE trend > 0) WHERE k <= 12)
SELECT customer_id, article_id, 'UGSaleTrend_1' AS method, round(trend, 6) AS score
FROM c LEFT JOIN seg USING (customer_id) LEFT JOIN top USING (segment)""".replace("\n,", ",\n"))
def r11(t):
    return rounded(r.UserGroupSaleTrend(t.segments, customers(t), t.ev, ("segment",), days=7, n=12, t=0.0).retrieve())


@query("r16_group_broadcast", with_(SEG, CUSTOMERS) + """
SELECT customer_id, segment_rank AS article_id, CAST(segment_rank AS DOUBLE) AS score FROM c LEFT JOIN seg USING (customer_id)
LEFT JOIN (SELECT segment, s.i AS segment_rank FROM (SELECT DISTINCT segment FROM seg WHERE segment <> 'MACHINERY'),
           (SELECT unnest([1, 2, 3]) AS i) s) USING (segment)""")
def r16(t):
    ranked = t.segments.select("segment").distinct().filter(F.col("segment") != "MACHINERY").select(
        "segment", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("article_id"))
    ranked = ranked.withColumn("score", F.col("article_id").cast("double"))
    return base.serve_groups(customers(t), t.segments, ranked, ["segment"], "article_id")


# ---------------------------------------------------------------- global

TOP12 = """top AS (SELECT article_id, count(*) AS n FROM (SELECT DISTINCT customer_id, article_id FROM ev)
GROUP BY article_id ORDER BY n DESC, article_id LIMIT 12)"""


@query("r12_time_history", with_(EV, BUYERS, TOP12) + """
SELECT customer_id, article_id, 'TimeHistory_1' AS method, CAST(n AS DOUBLE) AS score FROM b, top""")
def r12(t):
    return r.TimeHistory(buyers(t), t.ev, n=12).retrieve()


@query("r12_time_history_repeats", with_(EV, BUYERS) + """
SELECT customer_id, article_id, 'TimeHistory_r' AS method, CAST(n AS DOUBLE) AS score FROM b,
(SELECT article_id, count(*) AS n FROM ev GROUP BY article_id ORDER BY n DESC, article_id LIMIT 20)""")
def r12_repeats(t):
    return r.TimeHistory(buyers(t), t.ev, n=20.5, name="r", unique=False).retrieve()


@query("r13_time_history_decay", with_(EV, BUYERS, decay_cte("ev", 7)) + """
SELECT customer_id, article_id, 'TimeHistoryDecay_1' AS method, round(s, 3) AS score FROM b,
(SELECT article_id, sum(value) AS s FROM v GROUP BY article_id ORDER BY round(s, 6) DESC, article_id LIMIT 12)""")
def r13(t):
    return rounded(r.TimeHistoryDecay(buyers(t), t.ev, days=7, n=12).retrieve(), 3)


@query("r14_sale_trend", with_(EV, BUYERS) + """,
n AS (SELECT article_id, count(*) FILTER (gap <= 6) AS x, count(*) FILTER (gap > 6) AS y FROM (
        SELECT article_id, date_diff('day', t_dat, (SELECT max(t_dat) FROM ev)) AS gap FROM ev) WHERE gap <= 13 GROUP BY ALL)
SELECT customer_id, article_id, 'SaleTrend_1' AS method, round(trend, 6) AS score FROM b,
(SELECT article_id, x, (x - y) / y AS trend FROM n WHERE x > 0 AND y > 0 AND (x - y) / y > 0
 ORDER BY x DESC, trend DESC, article_id LIMIT 12)""".replace("\n,", ",\n"))
def r14(t):
    return rounded(r.SaleTrend(buyers(t), t.ev, days=7, n=12, t=0.0).retrieve())


@query("r15_out_of_stock", with_(TX) + """
SELECT article_id FROM (
  SELECT article_id, count(*) FILTER (date_trunc('month', t_dat) = m.cur) AS s9,
         count(*) FILTER (date_trunc('month', t_dat) = m.prev) AS s8
  FROM tx, (SELECT date_trunc('month', max(t_dat)) - INTERVAL 1 MONTH AS cur,
                   date_trunc('month', max(t_dat)) - INTERVAL 2 MONTH AS prev FROM tx) m
  WHERE t_dat >= m.prev - INTERVAL 6 MONTH GROUP BY article_id)
WHERE s9 = 0 OR (s8 > 0 AND (s9 - s8) / s8 < -0.8)""")
def r15(t):
    month = F.trunc(cal.last_day(t.tx), "MM")
    return r.OutOfStock(t.tx, cur_month=F.add_months(month, -1), prev_month=F.add_months(month, -2),
                        from_date=F.add_months(month, -8)).retrieve()


@query("r17_global_broadcast", with_(CUSTOMERS) + """
SELECT customer_id, article_id, score FROM c,
(SELECT p_partkey AS article_id, p_retailprice AS score FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 5)""")
def r17(t):
    top = t.table("part").select(F.col("p_partkey").alias("article_id"), F.col("p_retailprice").alias("score"))
    return base.serve_all(customers(t), top.orderBy(F.desc("score"), "article_id").limit(5), "article_id")


@query("r18_item_pool", with_(TX) + """
SELECT article_id, sales, row_number() OVER (ORDER BY sales DESC, article_id) AS rank FROM (
  SELECT article_id, count(*) AS sales FROM tx WHERE t_dat > (SELECT max(t_dat) FROM tx) - 60 GROUP BY article_id
  ORDER BY sales DESC, article_id LIMIT 1000)""")
def r18(t):
    return item_pool(t.tx, 60)


@query("r18_group_pool", with_(EV, SEG, SEG_EV) + """,
f AS (SELECT segment, customer_id, article_id, min(t_dat) AS t_dat FROM es WHERE segment IS NOT NULL GROUP BY ALL),
l AS (SELECT *, max(t_dat) OVER (PARTITION BY segment) AS last FROM f)
SELECT segment, article_id, count(*) AS sales,
       row_number() OVER (PARTITION BY segment ORDER BY count(*) DESC, article_id) AS rank
FROM l WHERE t_dat > last - 14 GROUP BY segment, article_id""".replace("\n,", ",\n"))
def r18_group(t):
    from basketry.operators.rules.factor import group_pools

    rows = t.ev.join(t.segments, "customer_id", "left")
    return group_pools(rows, "segment", 14, "article_id")


@query("r20_decayed_value", with_(TX, decay_cte("tx", 7)) + """
SELECT article_id, t_dat, count(*) AS n, round(any_value(value), 3) AS value FROM v GROUP BY article_id, t_dat""")
def r20(t):
    return sale_values(t.tx, 7, cal.last_day(t.tx)).withColumn("value", F.round("value", 3))


# ---------------------------------------------------------------- factorisation (rows only)

@query("r04_als")
def r04(t):
    return rounded(r.ALS(customers(t), t.ev, days=14, n=12, factors=16, iter_num=5).retrieve())


@query("r05_user_group_als")
def r05(t):
    return rounded(r.UserGroupALS(
        t.segments, customers(t), t.ev, "segment", days=14, n=12, factors=64, iter_num=15).retrieve())


@query("r06_bpr")
def r06(t):
    return rounded(r.BPR(customers(t), t.ev, days=14, n=12, factors=64, iter_num=15, passes=5).retrieve())


@query("r07_user_group_bpr")
def r07(t):
    return rounded(r.UserGroupBPR(
        t.segments, customers(t), t.ev, "segment", days=14, n=12, factors=64, iter_num=15, passes=5).retrieve())
