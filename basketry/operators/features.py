"""Weekly sales features as keyed tables.

Weeks count backwards: week ``w`` looks at rows of week ``w`` and older. Rows are totalled per
unit and day or week, and the weeks they count for are columns of one aggregation, so sales are
not copied per week. ``base`` tables carry ``week``, ``t_dat`` and ``valid`` (1 for a sale, 0 for
a filler row of the grid); a unit is one or more item columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import Day, day, week_end
from ..functions.skew import names, salted_lookup
from ..functions.stats import average_rank_by_value
from ..functions.tables import durable

EPSILON = 1e-6


def _sales(base: DataFrame, unit: Sequence[str]) -> DataFrame:
    rows = base.filter(F.col("valid") == 1)
    for c in unit:
        rows = rows.filter(F.col(c).isNotNull())
    return rows


def _count(rows: DataFrame) -> Column:
    """Number of sales; tables that are already totalled carry them in ``n``."""
    return F.sum("n") if "n" in rows.columns else F.count(F.lit(1))


def _by_week(sums: DataFrame, unit: Sequence[str], columns: Sequence[Column], out: str) -> DataFrame:
    """One column per week 1, 2, .. turned into rows (unit.., week, out); nulls are left out."""
    cells = F.array(*[F.struct(F.lit(w).alias("week"), c.alias(out)) for w, c in enumerate(columns, start=1)])
    return sums.select(*unit, F.inline(cells)).filter(F.col(out).isNotNull())


def _upto_week(w: int, value: Column) -> Column:
    """The value for rows of week ``w`` and older."""
    return F.when(F.col("week") >= w, value)


# ---------------------------------------------------------------- base table

def feature_grid(inter: DataFrame, items: DataFrame, week_num: int) -> DataFrame:
    """Transactions with ``valid``, on the grid of candidate items x weeks 1..week_num + 1.

    Recent rows of other items are dropped, older rows stay; a grid cell without sales becomes
    one row with ``valid`` 0. ``inter`` has ``week``.
    """
    wanted = items.select("article_id").filter(F.col("article_id").isNotNull()).distinct()
    salt = [c for c in ("customer_id", "t_dat") if c in inter.columns]
    rows = salted_lookup(inter, wanted.withColumn("_in", F.lit(True)), "article_id", salt)
    recent = F.col("week") <= week_num + 1
    kept = rows.filter(~recent | (F.col("_in") & (F.col("week") >= 1))).drop("_in").withColumn("valid", F.lit(1))
    sold = kept.filter(recent).select("article_id", "week").distinct()
    grid = wanted.select("article_id", F.explode(F.sequence(F.lit(1), F.lit(week_num + 1))).alias("week"))
    filler = grid.join(sold, ["article_id", "week"], "left_anti").withColumn("valid", F.lit(0))
    return kept.unionByName(filler, allowMissingColumns=True)


def date_fillers(base: DataFrame, anchor: Day) -> DataFrame:
    """Filler rows get the end of their week as date."""
    return base.withColumn(
        "t_dat", F.when(F.col("valid") == 0, week_end(F.col("week"), anchor)).otherwise(F.col("t_dat")))


# ---------------------------------------------------------------- single features

def full_sale(base: DataFrame, unit: str | Sequence[str], unique: bool = False, week_num: int = 6) -> DataFrame:
    """(unit.., week, sale): sales of the week and everything before it."""
    unit = names(unit)
    rows = _sales(base, unit)
    if unique:
        rows = rows.select("customer_id", "week", *unit).distinct()
    # the newest weeks one by one, all older ones together
    weekly = (rows.filter(F.col("week") >= 1)
              .groupBy(*unit, F.least(F.col("week"), F.lit(week_num)).alias("week")).agg(_count(rows).alias("_n")))
    weeks = range(1, week_num + 1)
    sums = weekly.groupBy(*unit).agg(*[F.sum(_upto_week(w, F.col("_n"))).alias(f"_s{w}") for w in weeks])
    return _by_week(sums, unit, [F.col(f"_s{w}") for w in weeks], "sale")


def week_sale(
    base: DataFrame, unit: str | Sequence[str], unique: bool = False, step: int | Sequence[int] = 0,
    week_num: int = 6,
) -> DataFrame:
    """(unit.., week, sale): sales of the week ``step`` weeks earlier.

    ``unique`` counts each customer once per unit, in the week of the earliest purchase. Several
    steps come from one pass, with a column ``step``.
    """
    unit, steps = names(unit), [step] if isinstance(step, int) else list(step)
    rows = _sales(base, unit).filter(F.col("week") <= week_num + max(steps) + 2)

    def at(s: int, week: Column, n: Column) -> Column:
        return F.struct(F.lit(s).alias("step"), (week - s).alias("week"), n.alias("_n"))

    def seen(s: int) -> Column:
        return F.when(F.col("week") <= week_num + s + 2, F.col("week"))

    if unique:
        rows = rows.groupBy("customer_id", *unit).agg(*[F.max(seen(s)).alias(f"_w{s}") for s in steps])
        spread = rows.groupBy(*unit, *[f"_w{s}" for s in steps]).agg(F.count(F.lit(1)).alias("_c"))
        cells = [at(s, F.col(f"_w{s}"), F.col("_c")) for s in steps]
    else:
        spread = rows.groupBy(*unit, "week").agg(_count(rows).alias("_c"))
        cells = [at(s, seen(s), F.col("_c")) for s in steps]
    spread = spread.select(*unit, F.inline(F.array(*cells))).filter(F.col("week").isNotNull())
    out = spread.groupBy(*unit, "week", "step").agg(F.sum("_n").alias("sale"))
    return out.drop("step") if isinstance(step, int) else out


def period_sale(
    base: DataFrame, unit: str | Sequence[str], anchor: Day, days: int | Sequence[int] = 14,
    unique: bool = False, rank: bool = False, norm: bool = False, week_num: int = 6,
) -> DataFrame:
    """(unit.., week, sale[, sale_rank][, sale_norm]): sales of the days + 1 days up to a week's end.

    Several periods come from one pass, with a column ``days``.
    """
    unit, periods = names(unit), [days] if isinstance(days, int) else list(days)
    rows = _sales(base, unit).filter(F.col("t_dat").isNotNull())
    if unique:
        rows = rows.groupBy("customer_id", *unit).agg(F.min("t_dat").alias("t_dat"))
    daily = rows.groupBy(*unit, "t_dat").agg(_count(rows).alias("_n"))
    gap = F.datediff(day(anchor), "t_dat")
    first = F.greatest(F.lit(1), F.ceil((gap - max(periods)) / 7)).cast("int")
    last = F.least(F.lit(week_num), F.floor(gap / 7)).cast("int")
    spread = daily.withColumns({"_a": first, "_b": last, "_gap": gap}).filter(F.col("_a") <= F.col("_b")).select(
        *unit, "_n", "_gap", F.explode(F.sequence("_a", "_b")).alias("week"))
    sums = spread.groupBy(*unit, "week").agg(*[
        F.sum(F.when(F.col("_gap") <= 7 * F.col("week") + d, F.col("_n"))).alias(f"_s{d}") for d in periods])
    cells = F.array(*[F.struct(F.lit(d).alias("days"), F.col(f"_s{d}").alias("sale")) for d in periods])
    out = sums.select(*unit, "week", F.inline(cells)).filter(F.col("sale").isNotNull())
    if norm:
        totals = out.groupBy("week", "days").agg(F.sum("sale").alias("_total"))
        out = out.join(F.broadcast(totals), ["week", "days"]).withColumn(  # weeks x periods rows
            "sale_norm", F.try_divide("sale", "_total")).drop("_total")
    if rank:
        out = average_rank_by_value(out, ["week", "days"], "sale", unit, "sale_rank")
    extra = [] if isinstance(days, int) else ["days"]
    return out.select(*unit, "week", *extra, "sale", *["sale_rank"] * rank, *["sale_norm"] * norm)


def repurchase_ratio(base: DataFrame, unit: str | Sequence[str], week_num: int = 6) -> DataFrame:
    """(unit.., week, ratio): share of buyers so far with more than one purchase."""
    unit, weeks = names(unit), range(1, week_num + 1)
    rows = _sales(base, unit).filter(F.col("week") >= 1)
    n = F.col("n") if "n" in rows.columns else F.lit(1)
    own = rows.groupBy("customer_id", *unit).agg(*[F.sum(_upto_week(w, n)).alias(f"_k{w}") for w in weeks])

    def ratio(w: int) -> Column:
        buyers = F.count_if(F.col(f"_k{w}") >= 1)
        return F.when(buyers > 0, F.count_if(F.col(f"_k{w}") >= 2) / (buyers + F.lit(EPSILON)))

    sums = own.groupBy(*unit).agg(*[ratio(w).alias(f"_r{w}") for w in weeks])
    return _by_week(sums, unit, [F.col(f"_r{w}") for w in weeks], "ratio")


def popularity(base: DataFrame, unit: str | Sequence[str] = "article_id", week_num: int = 6) -> DataFrame:
    """(unit.., week, popularity): sum over sales of 1 / (days before the last sale + 1)."""
    unit, weeks = names(unit), range(1, week_num + 1)
    rows = _sales(base, unit).filter((F.col("week") >= 1) & F.col("t_dat").isNotNull())
    last = rows.agg(F.array(*[F.max(_upto_week(w, F.col("t_dat"))) for w in weeks])).scalar()
    daily = rows.groupBy(*unit, "week", "t_dat").agg(_count(rows).alias("_n")).withColumn("_last", last)

    def share(w: int) -> Column:
        return F.sum(_upto_week(w, F.col("_n") / (F.datediff(F.col("_last")[w - 1], "t_dat") + 1)))

    sums = daily.groupBy(*unit).agg(*[share(w).alias(f"_p{w}") for w in weeks])
    return _by_week(sums, unit, [F.col(f"_p{w}") for w in weeks], "popularity")


def first_sale(base: DataFrame, unit: str | Sequence[str] = "article_id") -> DataFrame:
    """(unit.., first_date): earliest date of a unit in a base table with dated fillers."""
    unit = names(unit)
    for c in unit:
        base = base.filter(F.col(c).isNotNull())
    return base.groupBy(*unit).agg(F.min("t_dat").alias("first_date"))


def days_since(first: str | Column, week: str | Column, anchor: Day) -> Column:
    """Days from the first sale to the end of the week."""
    return F.datediff(week_end(F.col(week) if isinstance(week, str) else week, anchor), first)


# ---------------------------------------------------------------- history features

def item_mean_week(history: DataFrame) -> DataFrame:
    return history.filter(F.col("article_id").isNotNull()).groupBy("article_id").agg(
        F.avg("week").alias("article_time_mean"))


def customer_history(history: DataFrame) -> DataFrame:
    """Per customer: newest, oldest and mean week of purchase, their gap, and purchases per week of it."""
    weeks = history.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.min("week").alias("customer_id_last_time"), F.max("week").alias("customer_id_first_time"),
        F.avg("week").alias("customer_id_time_mean"), F.count(F.lit(1)).alias("_n"))
    gap = F.col("customer_id_first_time") - F.col("customer_id_last_time")
    return weeks.withColumn("customer_id_gap", gap).withColumn(
        "customer_daily_bought", F.try_divide("_n", "customer_id_gap")).drop("_n")


def customer_median_price(history: DataFrame) -> DataFrame:
    """(customer_id, customer_id_price_median), exact.

    Equal prices collapse before the shuffle. Running counts over coarse price steps find the one
    or two steps that hold the middle, and only these are sorted by price.
    """
    price = F.col("price").cast("double")
    counts = (history.filter(F.col("customer_id").isNotNull() & F.col("price").isNotNull())
              .groupBy("customer_id", price.alias("price")).agg(F.count(F.lit(1)).alias("_n")))
    # grows with the price, about 0.2 % per step
    step = F.floor(F.signum("price") * F.log(1 + F.abs("price") * 10000) * 500)
    counts = counts.withColumn("_step", step)
    steps = counts.groupBy("customer_id", "_step").agg(F.sum("_n").alias("_s"))
    own = Window.partitionBy("customer_id")
    upto = own.orderBy("_step").rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumns({"_below": F.sum("_s").over(upto) - F.col("_s"), "_total": F.sum("_s").over(own)})
    low, high = F.floor((F.col("_total") + 1) / 2), F.floor(F.col("_total") / 2) + 1
    middle = steps.filter((F.col("_below") < high) & (F.col("_below") + F.col("_s") >= low))
    near = counts.join(middle.drop("_s"), ["customer_id", "_step"])
    inside = (Window.partitionBy("customer_id", "_step").orderBy("price")
              .rowsBetween(Window.unboundedPreceding, 0))
    near = near.withColumn("_upto", F.col("_below") + F.sum("_n").over(inside))

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("_upto") >= place) & (F.col("_upto") - F.col("_n") < place), F.col("price")))

    return near.groupBy("customer_id").agg(((at(low) + at(high)) / 2).alias("customer_id_price_median"))


def trailing_year(history: DataFrame, unit: str, out: str, weeks: int = 5, span: int = 52) -> DataFrame:
    """(unit, week, out): sales of the weeks w + 1 .. w + span + 1, for weeks 1..``weeks``."""
    rows = history.filter(F.col(unit).isNotNull() & F.col("week").isNotNull())
    weekly = rows.groupBy(unit, "week").agg(F.count(F.lit(1)).alias("_n"))
    first = F.greatest(F.lit(1), F.col("week") - span - 1).cast("int")
    last = F.least(F.lit(weeks), F.col("week") - 1).cast("int")
    spread = weekly.withColumns({"_a": first, "_b": last}).filter(F.col("_a") <= F.col("_b")).select(
        unit, "_n", F.explode(F.sequence("_a", "_b")).alias("week"))
    return spread.groupBy(unit, "week").agg(F.sum("_n").alias(out))


def year_ratios(rows: DataFrame) -> DataFrame:
    """Item sales of the week over the trailing year of the item and of the product."""
    return rows.withColumns({
        "article_id_week_1/52": F.try_divide("i_sale", "article_id_week_shift52"),
        "product_code_week_1/52": F.try_divide("i_sale", "product_code_week_shift52"),
    })


def fill_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null, NaN and infinite numbers become finite: 0, 0 and the largest value of the type."""
    out = {}
    for f in df.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        kind = f.dataType.simpleString()
        if kind in ("float", "double"):
            big = 3.4028234663852886e38 if kind == "float" else 1.7976931348623157e308
            c = F.coalesce(F.nanvl(f.name, F.lit(0.0).cast(kind)), F.lit(0.0).cast(kind))
            out[f.name] = F.greatest(F.lit(-big).cast(kind), F.least(F.lit(big).cast(kind), c))
        elif kind in ("tinyint", "smallint", "int", "bigint"):
            out[f.name] = F.coalesce(f.name, F.lit(0).cast(kind))
    return df.withColumns(out)


# ---------------------------------------------------------------- the item-week table

def sale_columns(rows: DataFrame) -> DataFrame:
    """Ratios and trends of weekly sales (``i_``: item, ``p_``: product, ``lw_``: week before)."""
    eps = F.lit(EPSILON)
    out = {}
    for lw in ("", "lw_"):
        for uni in ("", "_uni"):
            out[f"{lw}i_sale{uni}_ratio"] = F.col(f"{lw}i_sale{uni}") / (F.col(f"{lw}p_sale{uni}") + eps)
        for u in ("i", "p"):
            out[f"{lw}{u}_uni_ratio"] = F.col(f"{lw}{u}_sale") / (F.col(f"{lw}{u}_sale_uni") + eps)
    for u in ("i", "p"):
        out[f"{u}_sale_trend"] = _trend(f"{u}_sale")
    return rows.withColumns(out)


def _trend(sale: str) -> Column:
    return (F.col(sale) - F.col(f"lw_{sale}")) / (F.col(f"lw_{sale}") + F.lit(EPSILON))


def daily_columns(rows: DataFrame) -> DataFrame:
    """Daily rates since the first sale and how the last weeks compare. Division by zero gives null."""
    def part(a: str, b: str) -> Column:
        return F.try_divide(F.col(a), F.col(b))

    rows = rows.withColumns({
        "i_daily_sale": part("i_full_sale", "first_dat"),
        "p_daily_sale": part("p_full_sale", "first_dat"),
    })
    return rows.withColumns({
        "i_daily_sale_ratio": part("i_daily_sale", "p_daily_sale"),
        "i_w_full_sale_ratio": part("i_sale", "i_full_sale"),
        "i_2w_full_sale_ratio": part("i_2w_sale", "i_full_sale"),
        "p_w_full_sale_ratio": part("p_sale", "p_full_sale"),
        "p_2w_full_sale_ratio": part("p_2w_sale", "p_full_sale"),
        "i_week_above_daily_sale": F.col("i_sale") / 7 - F.col("i_daily_sale"),
        # the item's, not the product's, cumulative sales
        "p_week_above_full_sale": F.col("p_sale") / 7 - F.col("i_full_sale"),
        "i_2w_week_above_daily_sale": F.col("i_2w_sale") / 14 - F.col("i_daily_sale"),
        "p_2w_week_above_daily_sale": F.col("p_2w_sale") / 14 - F.col("p_daily_sale"),
    })


def type_columns(rows: DataFrame, kind: str) -> DataFrame:
    """Trend and daily rates of an item attribute."""
    rows = rows.withColumns({
        f"{kind}_sale_trend": _trend(f"{kind}_sale"),
        f"{kind}_daily_sale": F.try_divide(F.col(f"{kind}_full_sale"), F.col(f"{kind}_first_dat")),
    })
    return rows.withColumns({
        f"{u}_{kind}_daily_sale_ratio": F.try_divide(F.col(f"{u}_daily_sale"), F.col(f"{kind}_daily_sale"))
        for u in ("i", "p")})


def _unit_weeks(
    days: DataFrame, customers: DataFrame, unit: str, prefix: str, anchor: Day, week_num: int, whole: bool
) -> DataFrame:
    """All features of one unit in one (unit, week) table; ``whole`` adds periods and popularity."""
    parts: list[DataFrame] = []
    wanted: list[str] = []

    def add(table: DataFrame, columns: dict[str, Column]) -> None:
        wanted.extend(columns)
        parts.append(table.select(unit, "week", *[c.cast("double").alias(n) for n, c in columns.items()]))

    def sales(table: DataFrame, suffix: str) -> None:
        add(table, {f"{lw}{prefix}_sale{suffix}": F.when(F.col("step") == s, F.col("sale"))
                    for s, lw in ((0, ""), (1, "lw_"))})

    if whole:
        periods = period_sale(days, unit, anchor, (14, 21, 28), rank=True, norm=True, week_num=week_num)
        add(periods, {f"{prefix}_{d // 7}w_{c}": F.when(F.col("days") == d, F.col(c))
                      for d in (14, 21, 28) for c in ("sale", "sale_rank", "sale_norm")})
        add(repurchase_ratio(customers, unit, week_num), {f"{prefix}_repurchase_ratio": F.col("ratio")})
        add(popularity(days, unit, week_num), {f"{prefix}_pop": F.col("popularity")})
        sales(week_sale(days, unit, False, (0, 1), week_num), "")
    # types count customers, as the unique columns do
    sales(week_sale(customers, unit, True, (0, 1), week_num), "_uni" if whole else "")
    add(full_sale(days, unit, False, week_num), {f"{prefix}_full_sale": F.col("sale")})

    # one aggregation instead of a join per feature
    stacked = [p.filter(F.col("week").between(1, week_num)) for p in parts]
    rows = stacked[0]
    for p in stacked[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    return rows.groupBy(unit, "week").agg(*[F.max(c).alias(c) for c in wanted])


def _first_days(days: DataFrame, unit: str, out: str, anchor: Day, week_num: int) -> DataFrame:
    """(unit, week, out): every unit of the base, with the days since its first sale."""
    first = first_sale(date_fillers(days, anchor), unit)
    weeks = first.select(unit, "first_date", F.explode(F.sequence(F.lit(1), F.lit(week_num))).alias("week"))
    return weeks.select(unit, "week", days_since("first_date", "week", anchor).alias(out))


def item_week_features(
    base: DataFrame, item: DataFrame, anchor: Day, week_num: int, kind: str = "product_type_no"
) -> DataFrame:
    """(article_id, week 1..week_num, product_code, features): what a candidate of the week before sees.

    Missing sales are 0. Every feature depends on week and item, product or type only, so three
    small tables are joined instead of decorating transactions.
    """
    attributes = item.select("article_id", "product_code", kind)
    units = ["article_id", "product_code", kind]
    # two totals serve all features: per item and day, and per customer, item and week
    days = base.groupBy("article_id", "week", "t_dat", "valid").agg(F.count(F.lit(1)).alias("n"))
    days = durable(days.join(attributes, "article_id", "left"))
    customers = base.filter(F.col("valid") == 1).groupBy("customer_id", "article_id", "week", "valid").agg(
        F.count(F.lit(1)).alias("n"))
    customers = durable(salted_lookup(customers, attributes, "article_id", "customer_id"))

    own, product, types = (
        _unit_weeks(days, customers, u, prefix, anchor, week_num, whole)
        for u, prefix, whole in zip(units, ("i", "p", kind), (True, True, False)))
    rows = _first_days(days, "article_id", "first_dat", anchor, week_num).join(own, ["article_id", "week"], "left")
    rows = rows.join(attributes, "article_id", "left")
    types = _first_days(days, kind, f"{kind}_first_dat", anchor, week_num).join(types, [kind, "week"], "left")
    rows = salted_lookup(rows, product, ["product_code", "week"], "article_id")
    rows = salted_lookup(rows, types, [kind, "week"], "article_id")
    dates = {"first_dat", f"{kind}_first_dat"}
    numbers = [c for c in rows.columns if c not in {*units, "week"} | dates]
    rows = rows.fillna(0, numbers)
    rows = type_columns(daily_columns(sale_columns(rows)), kind)
    return rows.drop(kind, f"{kind}_full_sale", f"{kind}_first_dat", "i_full_sale", "p_full_sale")
