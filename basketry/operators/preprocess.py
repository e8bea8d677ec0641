"""Id encoding, derived attributes, imputation, label codes, type narrowing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import Day, day
from ..functions.skew import dense_index, names, salted_lookup
from ..functions.tables import durable
from ..schema import ITEM_CODE_COLUMNS, ITEM_FLAG_COLUMNS, Dataset

# Product types that mark an article of the mixed departments as female.
FEMALE_PRODUCT_TYPES = [
    "Bra", "Underwear Tights", "Leggings/Tights", "Hair clip", "Hair string", "Hair/alice band",
    "Bikini top", "Skirt", "Dress", "Earring", "Alice band", "Straw hat", "Necklace",
    "Ballerinas", "Blouse", "Beanie", "Giftbox", "Pumps", "Bootie", "Heeled sandals",
    "Nipple covers", "Hair ties", "Underwear corset", "Bra extender", "Underdress",
    "Underwear set", "Sarong", "Leg warmers", "Hairband", "Tote bag", "Earrings", "Flat shoes",
    "Heels", "Cap", "Shoulder bag", "Headband", "Baby Bib", "Cross-body bag", "Bumbag",
]
# Product types of the two seasons.
SUMMER_PRODUCT_TYPES = [
    "Sunglasses", "Hat/brim", "Sandals", "Flat shoe", "Heeled sandals", "Polo shirt", "Dress",
    "T-shirt", "Skirt", "Vest top", "Swimwear top", "Swimsuit", "Swimwear bottom", "Bikini top",
    "Shorts",
]
WINTER_PRODUCT_TYPES = [
    "Beanie", "Felt hat", "Outdoor overall", "Long John", "Pyjama bottom", "Hat/beanie",
    "Leggings/Tights", "Hoodie", "Underwear Tights", "Pyjama set", "Boots", "Cardigan", "Sweater",
    "Jacket", "Scarf", "Coat", "Gloves", "Outdoor Waistcoat",
]
# Right-closed age bins.
AGE_EDGES = [-1, 19, 29, 39, 49, 59, 69, 119]
GENDER_SHARE = 0.8


# ---------------------------------------------------------------- ids

def id_map(rows: DataFrame, id_col: str) -> DataFrame:
    """(id, index): every distinct id with a dense 1-based integer, in id order."""
    ids = rows.select(F.col(id_col).alias("id")).filter(F.col("id").isNotNull()).distinct()
    return dense_index(ids, "id").select("id", F.col("index").cast("int").alias("index"))


def encode_ids(
    df: DataFrame, mapping: DataFrame, id_col: str, salt_on: str | Sequence[str] | None = None
) -> DataFrame:
    """Replace ids by their index; unknown ids become null.

    ``salt_on`` names the columns that spread a frequent id over several tasks.
    """
    lookup = mapping.select(F.col("id").alias(id_col), F.col("index").alias("_index"))
    if salt_on is None:
        joined = df.join(lookup, id_col, "left")
    else:
        joined = salted_lookup(df, lookup, id_col, salt_on)
    return joined.withColumn(id_col, F.col("_index")).select(*df.columns)


def encode_dataset(data: Dataset, user_map: DataFrame, item_map: DataFrame) -> Dataset:
    inter = encode_ids(data.inter, user_map, "customer_id", ["article_id", "t_dat"])
    inter = encode_ids(inter, item_map, "article_id", ["customer_id", "t_dat"])
    return Dataset(
        user=encode_ids(data.user, user_map, "customer_id"),
        item=encode_ids(data.item, item_map, "article_id"),
        inter=inter,
    )


# ---------------------------------------------------------------- derived attributes

def article_gender() -> Column:
    """0 undivided, 1 male, 2 female; a female clue overrides a male one in mixed groups."""
    department = F.lower("department_name")
    male = department.contains("boy") | department.contains("men")
    female = (department.contains("girl") | department.contains("ladies")
              | F.col("product_type_name").isin(FEMALE_PRODUCT_TYPES))
    return (
        F.when(F.col("index_group_name") == "Ladieswear", 2)
        .when(F.col("index_group_name") == "Menswear", 1)
        .when(female, 2).when(male, 1).otherwise(0)
    )


def season_type() -> Column:
    """0 none, 1 summer, 2 winter."""
    return (F.when(F.col("product_type_name").isin(WINTER_PRODUCT_TYPES), 2)
            .when(F.col("product_type_name").isin(SUMMER_PRODUCT_TYPES), 1).otherwise(0))


def with_item_flags(item: DataFrame) -> DataFrame:
    return item.withColumn("article_gender", article_gender()).withColumn("season_type", season_type())


def user_gender(inter: DataFrame, item: DataFrame) -> DataFrame:
    """(customer_id, user_gender): the gender behind at least 80 % of a customer's purchases."""
    bought = (inter.filter(F.col("customer_id").isNotNull())
              .groupBy("customer_id", "article_id").agg(F.count(F.lit(1)).alias("_n")))
    bought = salted_lookup(bought, item.select("article_id", "article_gender"), "article_id", "customer_id")

    def share(gender: int) -> Column:
        return F.sum(F.when(F.col("article_gender") == gender, F.col("_n")).otherwise(0)) / F.sum("_n")

    return bought.groupBy("customer_id").agg(share(1).alias("_m"), share(2).alias("_f")).select(
        "customer_id",
        F.when(F.col("_f") >= GENDER_SHARE, 2).when(F.col("_m") >= GENDER_SHARE, 1)
        .otherwise(0).alias("user_gender"))


def with_user_gender(user: DataFrame, inter: DataFrame, item: DataFrame) -> DataFrame:
    return user.join(user_gender(inter, item), "customer_id", "left").fillna({"user_gender": 0})


# ---------------------------------------------------------------- imputation and codes

def _minus_one(dtype: T.DataType) -> Column:
    return F.lit("-1") if isinstance(dtype, T.StringType) else F.lit(-1).cast(dtype)


def impute_users(user: DataFrame) -> DataFrame:
    """Missing age becomes 0, every other missing value -1."""
    return user.select(*[
        F.coalesce(f.name, F.lit(0).cast(f.dataType) if f.name == "age" else _minus_one(f.dataType))
        .alias(f.name)
        for f in user.schema.fields
    ])


def label_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, code): values as strings, coded from 1 in string order per feature.

    All features are numbered in one sort of their distinct values; a feature's first number is
    its offset.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(pairs)).distinct()
    numbered = dense_index(values, ["feature", "value"], "_k")
    first = numbered.groupBy("feature").agg(F.min("_k").alias("_first"))
    return numbered.join(F.broadcast(first), "feature").select(  # one row per column
        "feature", "value", (F.col("_k") - F.col("_first") + 1).cast("int").alias("code"))


def label_encode(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Replace every listed column by its label code."""
    codes = durable(label_codes(df, columns))
    out = df
    for c in columns:
        lookup = codes.filter(F.col("feature") == c).select(
            F.col("value").alias("_value"), F.col("code").alias("_code"))
        out = out.withColumn("_value", F.col(c).cast("string"))
        out = salted_lookup(out, lookup, "_value", key)
        out = out.withColumn(c, F.col("_code")).drop("_value", "_code")
    return out.select(*df.columns)


def narrow_transactions(inter: DataFrame) -> DataFrame:
    return inter.withColumns({
        "price": F.col("price").cast("float"),
        "sales_channel_id": F.col("sales_channel_id").cast("byte"),
    })


def encode_users(user: DataFrame) -> DataFrame:
    coded = [c for c in user.columns if c not in ("customer_id", "age", "user_gender")]
    return (label_encode(impute_users(user), coded, "customer_id")
            .withColumn("age", F.col("age").cast("int"))
            .withColumn("user_gender", F.col("user_gender").cast("int")))


def encode_items(item: DataFrame) -> DataFrame:
    return label_encode(item, ITEM_CODE_COLUMNS, "article_id").select(
        "article_id", *ITEM_CODE_COLUMNS, *ITEM_FLAG_COLUMNS)


def preprocess(data: Dataset, user_map: DataFrame | None = None, item_map: DataFrame | None = None) -> Dataset:
    """Raw tables to encoded ones. Pass stored id maps to reuse them."""
    user_map = id_map(data.user, "customer_id") if user_map is None else user_map
    item_map = id_map(data.item, "article_id") if item_map is None else item_map
    data = encode_dataset(data, user_map, item_map)
    item = with_item_flags(data.item)
    user = with_user_gender(data.user, data.inter, item)
    return Dataset(user=encode_users(user), item=encode_items(item), inter=narrow_transactions(data.inter))


# ---------------------------------------------------------------- splits and groups

def split(
    trans: DataFrame, train_end: Day, valid_end: Day, item_id: str = "article_id"
) -> tuple[DataFrame, DataFrame]:
    """(rows before ``train_end``, held-out rows before ``valid_end``)."""
    if item_id not in trans.columns:
        raise KeyError(f"{item_id} is not one of the columns")
    held_out = trans.filter((F.col("t_dat") >= day(train_end)) & (F.col("t_dat") < day(valid_end)))
    return trans.filter(F.col("t_dat") < day(train_end)), held_out


def label_counts(held_out: DataFrame, item_id: str = "article_id") -> DataFrame:
    """(customer_id, item, n): held-out purchases with their repetitions."""
    return (held_out.filter(F.col("customer_id").isNotNull() & F.col(item_id).isNotNull())
            .groupBy("customer_id", item_id).agg(F.count(F.lit(1)).alias("n")))


def label_lists(held_out: DataFrame, item_id: str = "article_id") -> DataFrame:
    """(customer_id, items): one row per customer, held-out purchases in date and then item order, repeats kept."""
    from .sequences import item_lists

    return item_lists(held_out, item_id)


def age_bin(age: str | Column = "age") -> Column:
    """1..7 for the right-closed age bins; null outside them."""
    age = F.col(age) if isinstance(age, str) else age
    code = F
    for i, (low, high) in enumerate(zip(AGE_EDGES, AGE_EDGES[1:]), start=1):
        code = code.when((age > low) & (age <= high), i)
    return code


def purchase_ability(inter: DataFrame) -> DataFrame:
    """(customer_id, purchase_ability): quintile 0..4 of a customer's mean price.

    The four inner edges are order statistics with linear interpolation. They come from the
    counts of the distinct means, so no task holds them all; equal edges merge.
    """
    from .quantiles import exact_quantiles

    means = inter.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.avg(F.col("price").cast("double")).alias("_mean"))
    edges = exact_quantiles(means.withColumn("_g", F.lit("all")), "_g", "_mean", [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])
    inner = sorted(set(edges.get("all", [])))[1:-1]
    code = sum([F.when(F.col("_mean") > e, 1).otherwise(0) for e in inner], F.lit(0))
    return means.select(
        "customer_id", F.when(F.col("_mean").isNotNull(), code).alias("purchase_ability"))


def with_product(trans: DataFrame, item: DataFrame, columns: str | Sequence[str] = "product_code") -> DataFrame:
    """Item attributes on every transaction; frequent items are spread over tasks."""
    salt = [c for c in ("customer_id", "t_dat") if c in trans.columns]
    lookup = item.select("article_id", *names(columns))
    return salted_lookup(trans, lookup, "article_id", salt) if salt else trans.join(lookup, "article_id", "left")


# ---------------------------------------------------------------- type narrowing

def _narrow_type(low: float, high: float, integral: bool) -> str:
    if not integral:
        return "float"
    for name, bits in (("tinyint", 8), ("smallint", 16), ("int", 32)):
        if -(2 ** (bits - 1)) <= low and high < 2 ** (bits - 1):
            return name
    return "bigint"


def narrow_types(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Smallest type per numeric column; missing values become the minimum - 1.

    One aggregation reads every column's range. Returns the table and the filled columns.
    """
    numeric = [f for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if not numeric:
        return df, []
    aggs = []
    for f in numeric:
        c = F.col(f.name)
        aggs += [F.min(c).alias(f"{f.name}_lo"), F.max(c).alias(f"{f.name}_hi"),
                 F.max(c.isNull()).alias(f"{f.name}_null")]
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            aggs.append(F.min(c == F.floor(c)).alias(f"{f.name}_int"))
    stats = df.agg(*aggs).first().asDict()
    out, filled = {}, []
    for f in numeric:
        low, high = stats[f"{f.name}_lo"], stats[f"{f.name}_hi"]
        if low is None:
            continue
        c = F.col(f.name)
        if stats[f"{f.name}_null"]:
            low = low - 1
            c = F.coalesce(c, F.lit(low))
            filled.append(f.name)
        out[f.name] = c.cast(_narrow_type(float(low), float(high), stats.get(f"{f.name}_int", True)))
    return df.withColumns(out), filled
