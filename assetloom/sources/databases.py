"""Database reads and writes through JDBC, table to table transfer, incremental extracts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetloom.functions.literals import literal


def jdbc_options(url: str, *, table: str | None = None, query: str | None = None, column: str | None = None,
                 lower=None, upper=None, partitions: int | None = None,
                 options: Mapping[str, str] | None = None) -> dict[str, str]:
    """Reader options: a table or a query, read in parallel ranges of ``column``."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    out = {"url": url, **(options or {})}
    if column is None:
        out["dbtable" if table else "query"] = table or query
        return out
    if lower is None or upper is None or not partitions:
        raise ValueError("a partitioned read needs lower, upper and partitions")
    # Spark takes no partition column together with "query", so a query becomes a derived table.
    out["dbtable"] = table or f"({query}) q"
    out.update(partitionColumn=column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions))
    return out


def read_jdbc(spark: SparkSession, url: str, **source) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, **source)).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", truncate: bool = False,
               options: Mapping[str, str] | None = None) -> None:
    """Parallel write; ``truncate`` with mode overwrite keeps the target's definition."""
    settings = {"url": url, "dbtable": table, "truncate": str(truncate).lower(), **(options or {})}
    df.write.format("jdbc").mode(mode).options(**settings).save()


def transfer(spark: SparkSession, write, *, source_table: str | None = None, select: str | None = None,
             views: Mapping[str, DataFrame] | None = None, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Move a table, or the result of a query (not both), to ``write(df)``; ``mapping`` renames."""
    if (source_table is None) == (select is None):
        raise ValueError("give either a source table or a select statement")
    sources = dict(views or {})
    df = spark.sql(select, **sources) if select else sources.get(source_table) or spark.table(source_table)
    if mapping:
        df = df.select(*[F.col(old).alias(new) for old, new in mapping.items()])
    write(df)
    return df


def simple_fields(schema: T.StructType, keep: Sequence[str] = ("Name",)) -> list[str]:
    """All fields but compound ones (structs); a compound ``Name`` still counts as a field."""
    return [f.name for f in schema if not isinstance(f.dataType, T.StructType) or f.name in keep]


def incremental(df: DataFrame, key: str | None = None, since: dt.datetime | None = None,
                exclude: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """Rows at or after the watermark. The bound is inclusive: dedupe or upsert what comes out."""
    out = df.select(*[c for c in simple_fields(df.schema) if c not in exclude])
    if key and since is not None:
        if isinstance(since, dt.datetime):
            since = since.replace(microsecond=0)
        out = out.where(F.col(key) >= literal(since, df.schema[key].dataType))
    return out if limit is None else out.limit(limit)
