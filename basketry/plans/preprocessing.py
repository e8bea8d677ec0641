"""Raw files to an encoded, saved dataset."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.preprocess import id_map, preprocess
from ..schema import RAW_CUSTOMERS, RAW_ITEMS, RAW_TRANSACTIONS, Dataset
from ..sources.raw import read_raw
from ..sources.stages import load_dataset, save_dataset


def stored_map(rows: DataFrame, id_col: str, path: str) -> DataFrame:
    """The id map at ``path``; made from ``rows`` where there is none yet."""
    spark = rows.sparkSession
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        id_map(rows, id_col).write.parquet(path)
        return spark.read.parquet(path)


def run(
    spark: SparkSession, raw_folder: str, folder: str, user_schema: T.StructType = RAW_CUSTOMERS,
    item_schema: T.StructType = RAW_ITEMS, inter_schema: T.StructType = RAW_TRANSACTIONS,
    name: str = "encoded_full",
) -> Dataset:
    """Read, encode, derive, impute, code and save; id maps are kept under ``folder``."""
    data = read_raw(spark, raw_folder, user_schema, item_schema, inter_schema)
    user_map = stored_map(data.user, "customer_id", f"{folder}/index_id_map/user.parquet")
    item_map = stored_map(data.item, "article_id", f"{folder}/index_id_map/item.parquet")
    save_dataset(preprocess(data, user_map, item_map), f"{folder}/processed/{name}")
    return load_dataset(spark, f"{folder}/processed/{name}")
