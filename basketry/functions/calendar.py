"""Week numbers, counted backwards from an anchor day (last data day + 7 by default)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Day = str | dt.date | Column


def day(value: Day) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def last_day(trans: DataFrame, date_col: str = "t_dat") -> Column:
    """Latest date of a table, as a scalar subquery."""
    return trans.agg(F.max(date_col)).scalar()


def last_or(trans: DataFrame, last_date: Day | None, date_col: str = "t_dat") -> Column:
    """``last_date`` where the caller knows it, which saves a scan; else the table's maximum."""
    return last_day(trans, date_col) if last_date is None else day(last_date)


def default_anchor(trans: DataFrame, date_col: str = "t_dat") -> Column:
    return F.date_add(last_day(trans, date_col), 7)


def week_end(week: Column | int, anchor: Day) -> Column:
    """First day after the week."""
    week = F.lit(week) if isinstance(week, int) else week
    return F.date_add(day(anchor), (1 - 7 * week).cast("int"))


def week_start(week: Column | int, anchor: Day) -> Column:
    return F.date_add(week_end(week, anchor), -7)


def week_table(spark: SparkSession, anchor: Day, weeks: range) -> DataFrame:
    """(week, start_date, end_date) with ``end_date`` exclusive."""
    rows = spark.range(weeks.start, weeks.stop).select(F.col("id").cast("int").alias("week"))
    return rows.select(
        "week",
        week_start(F.col("week"), anchor).alias("start_date"),
        week_end(F.col("week"), anchor).alias("end_date"),
    )


def week_number(date_col: str | Column, anchor: Day) -> Column:
    return F.floor(F.datediff(day(anchor), date_col) / 7).cast("int")


def with_week(trans: DataFrame, anchor: Day, date_col: str = "t_dat") -> DataFrame:
    return trans.withColumn("week", week_number(F.col(date_col), anchor))


def recent(trans: DataFrame, days: int, start: Day | None = None, date_col: str = "t_dat") -> DataFrame:
    """The last ``days`` days of a slice.

    With ``start`` (first day after the slice) rows from ``start - days`` on are kept. Without it
    the slice ends on the last day that has data.
    """
    if start is not None:
        return trans.filter(F.col(date_col) >= F.date_sub(day(start), days))
    return trans.filter(F.col(date_col) > F.date_sub(last_day(trans, date_col), days))
