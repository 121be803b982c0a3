"""The registered queries: name, Spark function, and the SQL it is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFunction = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFunction] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register a function under its own name; ``sql`` gives the same rows on the same tables."""

    def add(fn: QueryFunction) -> QueryFunction:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table. Its times carry no zone, so the session reads them as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
