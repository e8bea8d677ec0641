"""Raw CSV files, the list of customers to serve, and vectors trained elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW_CUSTOMERS, RAW_ITEMS, RAW_TRANSACTIONS, Dataset


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header and a declared schema; values may hold quotes, and line ends with ``multi_line``.

    The header has to name the columns of the schema in their order; another header, or a row that does not fit, is an error.
    """
    return (spark.read.schema(schema).option("header", True).option("escape", '"').option("enforceSchema", False)
            .option("mode", "FAILFAST").option("multiLine", multi_line).csv(path))


def read_raw(
    spark: SparkSession,
    folder: str,
    user_schema: T.StructType = RAW_CUSTOMERS,
    item_schema: T.StructType = RAW_ITEMS,
    inter_schema: T.StructType = RAW_TRANSACTIONS,
) -> Dataset:
    return Dataset(
        user=read_csv(spark, f"{folder}/customers.csv", user_schema),
        item=read_csv(spark, f"{folder}/articles.csv", item_schema, multi_line=True),
        inter=read_csv(spark, f"{folder}/transactions_train.csv", inter_schema),
    )


def read_submission_customers(
    spark: SparkSession, path: str, user_map: DataFrame, id_type: T.DataType | None = None
) -> DataFrame:
    """Customers to serve, as dense ids; unknown ones keep a null id."""
    schema = T.StructType([
        T.StructField("customer_id", id_type or T.StringType()),
        T.StructField("prediction", T.StringType()),
    ])
    rows = read_csv(spark, path, schema).select(F.col("customer_id").alias("id"))
    return rows.join(user_map, "id", "left").select("id", F.col("index").alias("customer_id"))


def read_vectors(spark: SparkSession, path: str, id_col: str = "id", vec_col: str = "vec") -> DataFrame:
    """(id, vec ARRAY<FLOAT>) table of vectors trained elsewhere."""
    return spark.read.parquet(path).select(
        F.col(id_col).alias("id"), F.col(vec_col).cast("array<float>").alias("vec"))
