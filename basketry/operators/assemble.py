"""Training and scoring rows: candidates with labels, lagged item weeks, users, items, vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.skew import salted_lookup
from ..functions.stats import dot
from ..schema import ITEM_FEATURES, USER_FEATURES


def last_item_row(trans: DataFrame, columns: Sequence[str] = ("price", "sales_channel_id", "t_dat")) -> DataFrame:
    """(article_id, week, columns): last non-null value by date and customer."""
    def last(c: str):
        order = F.when(F.col(c).isNotNull(), F.struct("t_dat", "customer_id", c))
        return F.max_by(c, order).alias(c)

    known = trans.filter(F.col("article_id").isNotNull())
    return known.groupBy("article_id", "week").agg(*[last(c) for c in columns])


def lag_week(item_week: DataFrame) -> DataFrame:
    """Week ``w + 1`` of an item serves the candidates of week ``w``."""
    return item_week.withColumn("week", F.col("week") - 1)


def attach_labels(candidates: DataFrame, labels: DataFrame) -> DataFrame:
    """Candidates of customers that bought in the week, with ``label``."""
    buyers = labels.select("customer_id", "week").distinct()
    hits = labels.select("customer_id", "article_id", "week").distinct().withColumn("label", F.lit(1))
    return (candidates.join(buyers, ["customer_id", "week"], "left_semi")
            .join(hits, ["customer_id", "article_id", "week"], "left").fillna({"label": 0}))


def attach_features(
    candidates: DataFrame, item_week: DataFrame, user: DataFrame, item: DataFrame,
    user_features: Sequence[str] = tuple(USER_FEATURES), item_features: Sequence[str] = tuple(ITEM_FEATURES),
) -> DataFrame:
    """Lagged item-week features, then user and item attributes.

    Candidates crowd on a few items, so item lookups are spread by customer. A customer has few
    candidates, so the large user table is joined without copies.
    """
    rows = salted_lookup(candidates, lag_week(item_week), ["article_id", "week"], "customer_id")
    rows = rows.join(user.select("customer_id", *user_features), "customer_id", "left")
    return salted_lookup(rows, item.select("article_id", *item_features), "article_id", "customer_id")


def embedding_similarity(
    candidates: DataFrame, user_vectors: DataFrame, item_vectors: DataFrame, out: str,
    user_id: str = "customer_id", item_id: str = "article_id",
) -> DataFrame:
    """Dot product of the user and the item vector; null where either is missing."""
    rows = candidates.join(
        user_vectors.select(F.col("id").alias(user_id), F.col("vec").alias("_u")), user_id, "left")
    rows = salted_lookup(rows, item_vectors.select(F.col("id").alias(item_id), F.col("vec").alias("_v")),
                         item_id, user_id)
    return rows.withColumn(out, dot("_u", "_v")).drop("_u", "_v")


def attach_vectors(rows: DataFrame, vectors: DataFrame, width: int, out: str, key: str = "article_id", spread: str = "customer_id") -> DataFrame:
    """Adds the vector of ``key`` (id, vec); a key without one gets the unit vector of equal parts."""
    uniform = F.array_repeat(F.lit(width ** -0.5), width)
    rows = salted_lookup(rows, vectors.select(F.col("id").alias(key), F.col("vec").alias(out)), key, spread)
    return rows.withColumn(out, F.coalesce(out, uniform))


def fit_category_codes(domain: DataFrame, columns: Sequence[str]) -> StringIndexerModel:
    """Codes over the full domain of a dimension; unseen values get a code of their own."""
    text = domain.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_code" for c in columns],
        stringOrderType="alphabetAsc", handleInvalid="keep").fit(text)


def apply_category_codes(df: DataFrame, model: StringIndexerModel) -> DataFrame:
    columns = model.getInputCols()
    text = df.withColumns({c: F.col(c).cast("string") for c in columns})
    coded = model.transform(text)
    return coded.withColumns({c: F.col(f"{c}_code").cast("int") for c in columns}).drop(
        *[f"{c}_code" for c in columns])
