"""Name -> query and name -> SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``fn(tables) -> DataFrame`` under ``name``."""
    def wrap(fn: Callable) -> Callable:
        from .tables import Tables

        def run(spark, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap
