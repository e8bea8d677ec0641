"""Collector, metrics, fusion and the flagship query, on the event log with week 1 held out."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.operators import blend, collector as c, metrics
from basketry.operators import rules as r
from basketry.operators.preprocess import label_counts, split
from basketry.operators.quantiles import QuantileNormal, min_max
from basketry.plans import weekly

from .registry import query
from .rules import decay_cte
from .tables import EV, EVA, with_


class Held:
    """Event log split at week 1, three rules on the training part."""

    def __init__(self, t):
        self.start, self.end = cal.week_start(1, t.anchor), cal.week_end(1, t.anchor)
        self.train, self.held_out = split(t.ev, self.start, self.end)
        self.customers = self.held_out.select("customer_id").distinct()

    def rules(self):
        return [
            r.OrderHistory(self.train, days=14),
            r.TimeHistory(self.customers, self.train, n=40),
            r.OrderHistoryDecay(self.train, days=7),
        ]

    def candidates(self):
        return c.union_rules([x.retrieve() for x in self.rules()])


METHODS = ["OrderHistory_1", "OrderHistoryDecay_1", "TimeHistory_1"]

HELD = f"""{EV},
{EVA},
train AS (SELECT ev.* FROM ev, a WHERE t_dat < anchor - 13),
held AS (SELECT ev.* FROM ev, a WHERE t_dat >= anchor - 13 AND t_dat < anchor - 6),
lab AS (SELECT DISTINCT customer_id, article_id FROM held),
{decay_cte("train", 7, "d")},
cand AS (
  SELECT customer_id, article_id, 'OrderHistory_1' AS method, CAST(-min(gap) AS DOUBLE) AS score FROM (
    SELECT *, date_diff('day', t_dat, max(t_dat) OVER (PARTITION BY customer_id)) AS gap FROM train)
  WHERE gap < 14 GROUP BY customer_id, article_id
  UNION ALL
  SELECT customer_id, article_id, 'TimeHistory_1', CAST(n AS DOUBLE) FROM (SELECT DISTINCT customer_id FROM held),
    (SELECT article_id, count(*) AS n FROM (SELECT DISTINCT customer_id, article_id FROM train)
     GROUP BY article_id ORDER BY n DESC, article_id LIMIT 40)
  UNION ALL
  SELECT customer_id, article_id, 'OrderHistoryDecay_1', sum(value) FROM dv GROUP BY customer_id, article_id
  HAVING sum(value) > 150)"""
MINMAX = """mm AS (SELECT customer_id, article_id, method,
  coalesce((score - min(score) OVER (PARTITION BY method))
    / nullif(max(score) OVER (PARTITION BY method) - min(score) OVER (PARTITION BY method), 0), 0) AS score FROM cand)"""


def rounded(df, digits=6):
    return df.withColumn("score", F.round("score", digits))


# ---------------------------------------------------------------- collector

def cut_cte(source: str, min_rate: float) -> str:
    """The depth search as a literal list of depths per rule."""
    return f"""mk AS (SELECT s.*, x.customer_id IS NOT NULL AS served, CASE WHEN l.customer_id IS NULL THEN 0 ELSE 1 END AS label
  FROM {source} s LEFT JOIN (SELECT DISTINCT customer_id FROM lab) x USING (customer_id)
  LEFT JOIN lab l ON l.customer_id = s.customer_id AND l.article_id = s.article_id),
rk AS (SELECT *, CASE WHEN score IS NOT NULL THEN rank() OVER (PARTITION BY method, customer_id ORDER BY score DESC NULLS LAST)
       + (count(*) OVER (PARTITION BY method, customer_id, score) - 1) / 2 END AS rank FROM mk),
ov AS (SELECT method, avg(label) AS rate, max(rank) AS top FROM rk WHERE served GROUP BY method),
dpt AS (SELECT method, top - i AS r, i, rate FROM ov, range(0, 1000) t(i) WHERE top - i > 0),
rt AS (SELECT dpt.method, i, r, sum(label) / count(*) AS rate FROM dpt JOIN rk ON rk.method = dpt.method AND served AND rank <= r
       GROUP BY ALL),
st AS (SELECT method, min(i) FILTER (rate > {min_rate}) AS stop FROM rt GROUP BY method),
bs AS (SELECT method, r AS best_rank, rate FROM (
  SELECT rt.*, row_number() OVER (PARTITION BY rt.method ORDER BY rate DESC, i) AS k
  FROM rt JOIN st USING (method) WHERE stop IS NULL OR i <= stop) WHERE k = 1),
cut AS (SELECT ov.method, ov.rate >= {min_rate} AS keep_all, best_rank FROM ov LEFT JOIN bs USING (method)
        WHERE ov.rate >= {min_rate} OR bs.rate >= {min_rate}),
kept AS (SELECT customer_id, article_id, method, score FROM rk JOIN cut USING (method)
         WHERE keep_all OR (served AND rank <= best_rank))"""


@query("c01_collect_minmax", with_(HELD, MINMAX, """gone AS (
  SELECT article_id FROM train GROUP BY article_id HAVING count(*) < 70),
ok AS (SELECT * FROM mm WHERE article_id NOT IN (SELECT article_id FROM gone))""", cut_cte("ok", 0.12)) + """
SELECT customer_id, article_id, method, round(score, 6) AS score FROM kept""")
def c01(t):
    h = Held(t)

    class Rare(r.FilterRule):
        def retrieve(self):
            return h.train.groupBy("article_id").count().filter("count < 70").select("article_id")

    return rounded(c.collect(
        h.rules(), h.held_out, filters=[Rare()], min_pos_rate=0.12, norm_type="minmax"))


@query("c02_week_labels", with_(EV, EVA) + """
SELECT DISTINCT customer_id, article_id FROM ev, a WHERE t_dat >= anchor - 20 AND t_dat < anchor - 13""")
def c02(t):
    return c.week_labels(t.ev, 2, t.anchor)


@query("c03_remove_items", with_(HELD) + """
SELECT customer_id, article_id, method, round(score, 3) AS score FROM cand
WHERE article_id NOT IN (SELECT article_id FROM held GROUP BY article_id HAVING count(*) > 20)""")
def c03(t):
    h = Held(t)
    often = h.held_out.groupBy("article_id").count().filter("count > 20")
    return rounded(c.remove_items(h.candidates(), often), 3)


def _normal_sql() -> str:
    """The normal quantile of ``p`` by the same published approximation."""
    from basketry.functions import stats as s

    def num(c):
        return [float(x) for x in c]

    parts = {n: num(getattr(s, f"AS241_{n}")) for n in (
        "CENTRE_NUM", "CENTRE_DEN", "MIDDLE_NUM", "MIDDLE_DEN", "TAIL_NUM", "TAIL_DEN")}
    ctr, mid, tail = "(0.180625 - (p - 0.5) * (p - 0.5))", "(r - 1.6)", "(r - 5.0)"

    def d(text: str) -> str:
        return f"CAST({text} AS DOUBLE)"

    def poly(name: str, x: str) -> str:
        out = d(repr(parts[name][-1]))
        for k in reversed(parts[name][:-1]):
            out = f"({out} * {x} + {d(repr(k))})"
        return out

    return f"""CASE WHEN abs(p - 0.5) <= 0.425 THEN (p - 0.5) * {poly('CENTRE_NUM', ctr)} / {poly('CENTRE_DEN', ctr)}
  ELSE sign(p - 0.5) * CASE WHEN r <= 5 THEN {poly('MIDDLE_NUM', mid)} / {poly('MIDDLE_DEN', mid)}
       ELSE {poly('TAIL_NUM', tail)} / {poly('TAIL_DEN', tail)} END END"""


def quantile_cte(source: str) -> str:
    """Place between 1000 evenly spaced quantiles (or one per row when there are fewer)."""
    return f"""nn AS (SELECT method, least(1000, count(*)) AS m FROM {source} GROUP BY method),
kn AS (SELECT method, i, i / (m - 1)::DOUBLE AS ref FROM nn, range(0, 1000) t(i) WHERE i < m),
sorted AS (SELECT method, score, row_number() OVER (PARTITION BY method ORDER BY score) - 1 AS pos,
                  count(*) OVER (PARTITION BY method) AS n FROM {source}),
tot AS (SELECT method, max(n) AS n FROM sorted GROUP BY method),
hh AS (SELECT kn.method, i, ref, i * (n - 1)::DOUBLE / (m - 1) AS h, n FROM kn JOIN tot USING (method) JOIN nn USING (method)),
qq AS (SELECT hh.method, i, ref, x.score + (y.score - x.score) * (h - floor(h)) AS q FROM hh
       JOIN sorted x ON x.method = hh.method AND x.pos = floor(h)
       JOIN sorted y ON y.method = hh.method AND y.pos = least(floor(h) + 1, hh.n - 1)),
kq AS (SELECT method, q, min(ref) AS r0, max(ref) AS r1 FROM qq GROUP BY method, q),
nx AS (SELECT method, q, r0, r1, lead(q) OVER w AS q2, lead(r0) OVER w AS r2,
              min(q) OVER (PARTITION BY method) AS lo, max(q) OVER (PARTITION BY method) AS hi
       FROM kq WINDOW w AS (PARTITION BY method ORDER BY q)),
ds AS (SELECT DISTINCT method, score FROM {source}),
pl AS (SELECT ds.method, ds.score,
         CASE WHEN ds.score - 1e-7 < lo THEN 0 WHEN ds.score + 1e-7 > hi THEN 1
              WHEN ds.score = q THEN (r0 + r1) / 2
              ELSE r1 + (r2 - r1) * (ds.score - q) / (q2 - q) END AS p0
       FROM ds ASOF JOIN nx ON ds.method = nx.method AND ds.score >= nx.q),
pc AS (SELECT method, score, greatest(1e-7::DOUBLE, least(1 - 1e-7::DOUBLE, p0)) AS p FROM pl),
pr AS (SELECT *, sqrt(-ln(least(p, 1 - p))) AS r FROM pc),
qn AS (SELECT s.customer_id, s.article_id, s.method, {_normal_sql()} AS score
       FROM {source} s JOIN pr ON pr.method = s.method AND pr.score = s.score)"""


# scores rounded first so that equal values are equal on both sides
CAND6 = "cand6 AS (SELECT customer_id, article_id, method, round(score, 6) AS score FROM cand)"


@query("c04_quantile_normal", with_(HELD, CAND6, quantile_cte("cand6")) + """
SELECT customer_id, article_id, method, round(score, 4) AS score FROM qn""")
def c04(t):
    rows = rounded(Held(t).candidates())
    return rounded(QuantileNormal.fit(rows).transform(rows), 4)


@query("c05_min_max", with_(HELD, MINMAX) + "SELECT customer_id, article_id, method, round(score, 6) AS score FROM mm")
def c05(t):
    return rounded(min_max(Held(t).candidates()))


@query("c06_positive_rate", with_(HELD) + """
SELECT method, count(*) AS rows, count(l.customer_id) AS positives, round(count(l.customer_id) / count(*), 6) AS rate
FROM cand LEFT JOIN lab l USING (customer_id, article_id) WHERE customer_id IN (SELECT customer_id FROM lab) GROUP BY method""")
def c06(t):
    h = Held(t)
    return c.positive_rates(h.candidates(), h.held_out).withColumn("rate", F.round("rate", 6))


CAND9 = "c9 AS (SELECT customer_id, article_id, method, round(score, 9) AS score FROM cand)"


@query("c07_cut_search", with_(HELD, CAND9, cut_cte("c9", 0.15)) + """
SELECT customer_id, article_id, method, round(score, 3) AS score FROM kept""")
def c07(t):
    h = Held(t)
    return rounded(c.cut_by_rate(rounded(h.candidates(), 9), h.held_out, 0.15), 3)


@query("c07_best_depths", with_(HELD, CAND9, cut_cte("c9", 0.15)) + """
SELECT method, keep_all, best_rank FROM cut""")
def c07_depths(t):
    from basketry.functions.stats import average_rank

    h = Held(t)
    marked = c.mark_labels(rounded(h.candidates(), 9), h.held_out)
    ranked = marked.withColumn("rank", average_rank(["method", "customer_id"], "score"))
    return c.best_cuts(ranked.filter("served"), 0.15)


@query("c08_union", with_(HELD) + "SELECT customer_id, article_id, method, round(score, 3) AS score FROM cand")
def c08(t):
    return rounded(Held(t).candidates(), 3)


@query("c09_compress", with_(HELD, CAND9) + """
SELECT c_custkey AS customer_id, coalesce(l, []) AS article_id FROM customer LEFT JOIN (
  SELECT customer_id, list(article_id ORDER BY method, score DESC, article_id) AS l FROM c9 GROUP BY customer_id)
ON customer_id = c_custkey""")
def c09(t):
    served = t.table("customer").select(F.col("c_custkey").alias("customer_id"))
    return c.compress(served, rounded(Held(t).candidates(), 9))


WIDE = """wide AS (SELECT customer_id, article_id,
  sum(score) FILTER (method = 'OrderHistory_1') AS OrderHistory_1,
  sum(score) FILTER (method = 'OrderHistoryDecay_1') AS OrderHistoryDecay_1,
  sum(score) FILTER (method = 'TimeHistory_1') AS TimeHistory_1 FROM cand GROUP BY ALL)"""


def _scaled(m: str) -> str:
    return f"coalesce(({m} - (SELECT min({m}) FROM wide)) / nullif((SELECT max({m}) - min({m}) FROM wide), 0), 0)"


COMBINED = f"comb AS (SELECT *, {' + '.join(_scaled(m) for m in METHODS)} AS score FROM wide)"


@query("c10_pivot", with_(HELD, WIDE) + """
SELECT * REPLACE (round(OrderHistoryDecay_1, 3) AS OrderHistoryDecay_1) FROM wide""")
def c10(t):
    wide = c.pivot_rules(Held(t).candidates(), METHODS)
    return wide.withColumn("OrderHistoryDecay_1", F.round("OrderHistoryDecay_1", 3))


@query("c11_combined_score", with_(HELD, WIDE, COMBINED) + "SELECT customer_id, article_id, round(score, 6) AS score FROM comb")
def c11(t):
    wide = c.combined_score(c.pivot_rules(Held(t).candidates(), METHODS), METHODS)
    return rounded(wide).select("customer_id", "article_id", "score")


@query("c12_rank_and_cut", with_(HELD, WIDE, COMBINED, "r9 AS (SELECT customer_id, article_id, round(score, 9) AS score FROM comb)") + """
SELECT customer_id, article_id, round(score, 6) AS score, rank FROM (
  SELECT *, rank() OVER (PARTITION BY customer_id ORDER BY score DESC)
         + (count(*) OVER (PARTITION BY customer_id, score) - 1) / 2 AS rank FROM r9) WHERE rank <= 20""")
def c12(t):
    wide = rounded(c.combined_score(c.pivot_rules(Held(t).candidates(), METHODS), METHODS), 9)
    return rounded(c.rank_and_cut(wide, 20)).select("customer_id", "article_id", "score", "rank")


# ---------------------------------------------------------------- fusion

def three_lists(t):
    h = Held(t)
    lists = [blend.ranked_lists(x.retrieve().withColumn("prob", F.round("score", 6))) for x in h.rules()]
    return h, lists


LISTS = """lst AS (SELECT *, row_number() OVER (PARTITION BY method, customer_id ORDER BY round(score, 6) DESC, article_id) AS rank
  FROM cand)"""


def fused_cte(n: int) -> str:
    return f"""fs AS (SELECT customer_id, article_id,
         sum(CASE method WHEN 'OrderHistory_1' THEN 1.0::DOUBLE WHEN 'TimeHistory_1' THEN 1.3 ELSE 0.7 END / rank) AS score
       FROM lst GROUP BY ALL),
fu AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY round(score, 9) DESC, article_id) AS rank
       FROM fs QUALIFY rank <= {n})"""


WEIGHTS = (1.0, 1.3, 0.7)


@query("b01_add_scores", with_(HELD) + """
SELECT customer_id, article_id, round(x.score + y.score, 3) AS prob
FROM (SELECT * FROM cand WHERE method = 'OrderHistory_1') x
LEFT JOIN (SELECT * FROM cand WHERE method = 'OrderHistoryDecay_1') y USING (customer_id, article_id)""")
def b01(t):
    first, _, second = [x.retrieve().withColumnRenamed("score", "prob").drop("method") for x in Held(t).rules()]
    return blend.add_scores(first, second).withColumn("prob", F.round("prob", 3))


@query("b02_align_lists", with_(HELD, LISTS) + """
SELECT customer_id, article_id, rank, method FROM lst WHERE customer_id IN (
  SELECT customer_id FROM lst GROUP BY customer_id HAVING count(DISTINCT method) = 3)""")
def b02(t):
    _, lists = three_lists(t)
    names = ["OrderHistory_1", "TimeHistory_1", "OrderHistoryDecay_1"]
    return c.union_rules([x.withColumn("method", F.lit(m)) for x, m in zip(blend.align_lists(lists), names)])


@query("b02_align_to_first", with_(HELD, LISTS) + """
SELECT customer_id, article_id, rank FROM lst WHERE method = 'TimeHistory_1'
  AND customer_id IN (SELECT customer_id FROM lst WHERE method = 'OrderHistory_1')""")
def b02_first(t):
    return blend.align_lists(three_lists(t)[1], 0)[1]


@query("b03_rank_fusion", with_(HELD, LISTS, fused_cte(12)) + """
SELECT customer_id, article_id, round(score, 6) AS score, rank FROM fu""")
def b03(t):
    return rounded(blend.fuse(three_lists(t)[1], WEIGHTS))


@query("b04_decode", with_(HELD, LISTS, fused_cte(12)) + """
SELECT customer_id, string_agg('0' || article_id, ' ' ORDER BY rank) AS prediction FROM fu GROUP BY customer_id""")
def b04(t):
    ids = t.ev.select(F.col("article_id").alias("id"), F.col("article_id").alias("index")).distinct()
    return blend.decode(blend.fuse(three_lists(t)[1], WEIGHTS), ids)


@query("b05_submission", with_(HELD, LISTS, fused_cte(12)) + """
SELECT c_name AS customer_id, prediction FROM customer LEFT JOIN (
  SELECT customer_id, string_agg('0' || article_id, ' ' ORDER BY rank) AS prediction FROM fu GROUP BY customer_id)
ON customer_id = c_custkey""")
def b05(t):
    people = t.table("customer")
    user_map = people.select(F.col("c_name").alias("id"), F.col("c_custkey").alias("index"))
    ids = t.ev.select(F.col("article_id").alias("id"), F.col("article_id").alias("index")).distinct()
    customers = people.select(F.col("c_custkey").alias("customer_id"))
    return weekly.submit(blend.fuse(three_lists(t)[1], WEIGHTS), customers, user_map, ids)


# ---------------------------------------------------------------- metrics

ACTUAL = "act AS (SELECT customer_id, article_id, count(*) AS n FROM held GROUP BY ALL)"


def metric_cte(k: int) -> str:
    return f"""hit AS (SELECT customer_id, article_id, rank, n,
         row_number() OVER (PARTITION BY customer_id ORDER BY rank) AS nth
       FROM act JOIN (SELECT * FROM fu WHERE rank <= {k}) USING (customer_id, article_id)),
sz AS (SELECT customer_id, sum(n) AS size FROM act GROUP BY customer_id),
per AS (SELECT customer_id, coalesce(sum(nth / rank), 0) / least(any_value(size), {k}) AS ap,
               coalesce(sum(n), 0) / any_value(size) AS recall, count(nth) > 0 AS hit
        FROM sz LEFT JOIN hit USING (customer_id) GROUP BY customer_id)"""


@query("q01_map_at_k", with_(HELD, LISTS, fused_cte(12), ACTUAL, metric_cte(12)) + "SELECT round(avg(ap), 6) AS map FROM per")
def q01(t):
    h, lists = three_lists(t)
    return metrics.map_at_k(label_counts(h.held_out), blend.fuse(lists, WEIGHTS), 12).withColumn("map", F.round("map", 6))


@query("q01_average_precision", with_(HELD, LISTS, fused_cte(12), ACTUAL, metric_cte(5)) + """
SELECT customer_id, round(ap, 6) AS ap FROM per""")
def q01_each(t):
    h, lists = three_lists(t)
    return metrics.average_precision(label_counts(h.held_out), blend.fuse(lists, WEIGHTS), 5).withColumn(
        "ap", F.round("ap", 6))


@query("q02_recall_at_k", with_(HELD, LISTS, fused_cte(12), ACTUAL, metric_cte(12)) + """
SELECT customer_id, round(recall, 6) AS recall FROM per""")
def q02(t):
    h, lists = three_lists(t)
    return metrics.customer_recall(label_counts(h.held_out), blend.fuse(lists, WEIGHTS)).withColumn(
        "recall", F.round("recall", 6))


@query("q03_hit_rate_at_k", with_(HELD, LISTS, fused_cte(12), ACTUAL, metric_cte(10)) + """
SELECT round(avg(CASE WHEN hit THEN 1 ELSE 0 END), 6) AS hit_rate FROM per""")
def q03(t):
    h, lists = three_lists(t)
    return metrics.hit_rate_at_k(label_counts(h.held_out), blend.fuse(lists, WEIGHTS)).withColumn(
        "hit_rate", F.round("hit_rate", 6))


@query("flagship", with_(HELD, LISTS, fused_cte(12), ACTUAL, metric_cte(12)) + """
SELECT round(avg(ap), 6) AS map, round(avg(recall), 6) AS recall, round(avg(CASE WHEN hit THEN 1 ELSE 0 END), 6) AS hit_rate
FROM per""")
def flagship(t):
    _, lists = three_lists(t)
    scores = weekly.evaluate(t.ev, blend.fuse(lists, WEIGHTS), t.anchor)
    return scores.select(*[F.round(m, 6).alias(m) for m in ("map", "recall", "hit_rate")])

