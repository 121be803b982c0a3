"""Contracts, threshold checks, SQL assertions and freshness: results are small check tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetloom.functions.literals import time_literal
from assetloom.functions.text import content_key

CHECKS = "check_name string, column_name string, severity string, n_failed bigint, passed boolean"


@dataclass(frozen=True)
class Rule:
    """A row condition that must hold; null counts as failed."""

    name: str
    condition: Column
    severity: str = "ERROR"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    dtype: str
    nullable: bool = True
    unique: bool = False
    description: str | None = None


@dataclass(frozen=True)
class Contract:
    columns: tuple[ColumnSpec, ...]
    rules: tuple[Rule, ...] = field(default=())
    allow_extra: bool = False

    def schema(self) -> T.StructType:
        """The contract as a Spark schema with column comments."""
        out = T.StructType()
        for c in self.columns:
            meta = {"comment": c.description} if c.description else {}
            out.add(T.StructField(c.name, T.DataType.fromDDL(c.dtype), c.nullable, meta))
        return out

    def row_rules(self, names: Sequence[str]) -> list[tuple[str, str, str, Column]]:
        """(check, column, severity, violated) of everything one row can show."""
        out = [("not_null", c.name, "ERROR", F.col(c.name).isNull())
               for c in self.columns if not c.nullable and c.name in names]
        out += [(r.name, "", r.severity, ~F.coalesce(r.condition, F.lit(False))) for r in self.rules]
        return out


def schema_problems(df: DataFrame, contract: Contract) -> list[tuple[str, str]]:
    """(problem, column) pairs found in the schemas alone; no job runs."""
    have = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in contract.schema()}
    out = [("missing_column", n) for n in want if n not in have]
    if not contract.allow_extra:
        out += [("extra_column", n) for n in have if n not in want]
    out += [("wrong_type", n) for n in want if n in have and have[n] != want[n]]
    return out


def _unpack(counts: DataFrame, specs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row of counts ``c0, c1, ...`` as one check row per count."""
    rows = F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.lit(column).alias("column_name"),
                 F.lit(severity).alias("severity"),
                 F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("bigint").alias("n_failed"))
        for i, (name, column, severity) in enumerate(specs)
    ])
    return counts.select(F.inline(rows)).withColumn("passed", F.col("n_failed") == 0)


def check(df: DataFrame, contract: Contract) -> DataFrame:
    """The check table: schema problems, one pass over the rows for null and rule counts, and one
    grouped count per unique column (null values are not compared)."""
    spark = df.sparkSession
    problems = [(p, c, "ERROR", 1, False) for p, c in schema_problems(df, contract)]
    out = spark.createDataFrame(problems, CHECKS) if problems else None
    rules = contract.row_rules(df.columns)
    if rules:
        counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, _, bad) in enumerate(rules)])
        rows = _unpack(counts, [r[:3] for r in rules])
        out = rows if out is None else out.unionByName(rows)
    for c in contract.columns:
        if c.unique and c.name in df.columns:
            groups = df.where(F.col(c.name).isNotNull()).groupBy(_unique_key(df, c.name)).agg(
                F.count(F.lit(1)).alias("n"))
            counts = groups.where("n > 1").agg(F.sum("n").alias("c0"))
            rows = _unpack(counts, [("unique", c.name, "ERROR")])
            out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], CHECKS)


def _unique_key(df: DataFrame, name: str) -> Column:
    """The column itself, or the digest of a text."""
    return content_key(F.col(name)) if isinstance(df.schema[name].dataType, T.StringType) else F.col(name)


def violating_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows that break a rule, with the names of the broken rules in ``violations``."""
    rules = contract.row_rules(df.columns)
    names = F.filter(
        F.array(*[F.when(bad, F.lit(f"{name}:{column}" if column else name)) for name, column, _, bad in rules])
        if rules else F.array().cast("array<string>"),
        lambda x: x.isNotNull(),
    )
    out = df.withColumn("violations", names)
    for c in contract.columns:
        if c.unique and c.name in df.columns:
            repeated = (
                df.where(F.col(c.name).isNotNull()).groupBy(_unique_key(df, c.name).alias("_key")).agg(
                    F.count(F.lit(1)).alias("_n")).where("_n > 1").withColumn("_n", F.lit(True))
            )
            label = F.array(F.lit(f"unique:{c.name}"))
            out = out.withColumn("_key", _unique_key(df, c.name)).join(repeated, "_key", "left").withColumn(
                "violations", F.when(F.col("_n"), F.concat("violations", label)).otherwise(F.col("violations"))
            ).drop("_n", "_key")
    return out.select(*df.columns, "violations").where(F.size("violations") > 0)


def require(df: DataFrame, contract: Contract, validated: bool = False) -> DataFrame:
    """The frame itself, or an error naming the failed checks; ``validated`` skips the work."""
    if validated:
        return df
    failed = check(df, contract).where("NOT passed AND severity = 'ERROR'").collect()
    if failed:
        listing = ", ".join(f"{r.check_name}({r.column_name}): {r.n_failed}" for r in failed)
        raise ValueError(f"contract broken: {listing}")
    return df


def threshold_checks(facts: DataFrame, count: str, failures: str, min_count: int = 1, max_failures: int = 0,
                     severity: str = "ERROR") -> DataFrame:
    """Per row of ``facts``: passed when there are enough rows and few enough failures; missing is 0."""
    n = F.coalesce(F.col(count), F.lit(0)).cast("bigint")
    bad = F.coalesce(F.col(failures), F.lit(0)).cast("bigint")
    kept = [c for c in facts.columns if c not in (count, failures)]
    return facts.select(
        *kept, n.alias("n_documents"), bad.alias("n_failures"), F.lit(severity).alias("severity"),
        ((n >= min_count) & (bad <= max_failures)).alias("passed"),
    )


def sql_assertion(spark: SparkSession, name: str, asset: str, query: str,
                  views: dict[str, DataFrame] | None = None) -> DataFrame:
    """A named query that selects violating rows of its parent asset: passes when it finds none."""
    found = spark.sql(query, **(views or {})).agg(F.count(F.lit(1)).alias("n_failed"))
    return found.select(
        F.lit(name).alias("check_name"), F.lit(asset).alias("asset"), "n_failed",
        F.when(F.col("n_failed") == 0, "SUCCEEDED").otherwise("FAILED").alias("state"),
        (F.col("n_failed") == 0).alias("passed"),
    )


def last_updated(history: DataFrame, names: DataFrame, key: str, ts: str, strict: bool = True) -> DataFrame:
    """Latest time per wanted name; a name without any is an error, or null if not ``strict``."""
    latest = history.groupBy(key).agg(F.max(ts).alias("last_updated"))
    out = names.select(key).distinct().join(latest, key, "left")
    if strict:
        unknown = F.raise_error(F.concat(F.lit("no update known for "), F.col(key).cast("string")))
        dtype = latest.schema["last_updated"].dataType
        out = out.withColumn(
            "last_updated", F.when(F.col("last_updated").isNull(), unknown.cast(dtype)).otherwise(F.col("last_updated"))
        )
    return out


def freshness(updates: DataFrame, now: dt.datetime, max_lag_minutes: int = 1440) -> DataFrame:
    """Late when the last update is older than the allowed lag (or there is none)."""
    dtype = updates.schema["last_updated"].dataType
    age = time_literal(now, dtype) - F.col("last_updated")
    return updates.withColumn("lag_minutes", F.floor(_seconds(age) / 60).cast("bigint")).withColumn(
        "is_late", F.coalesce(_seconds(age) > F.lit(max_lag_minutes * 60), F.lit(True))
    )


def _seconds(interval: Column) -> Column:
    return (
        F.extract(F.lit("DAY"), interval) * 86400 + F.extract(F.lit("HOUR"), interval) * 3600
        + F.extract(F.lit("MINUTE"), interval) * 60 + F.extract(F.lit("SECOND"), interval).cast("double")
    )
