"""Upsert as a pure function, and the outcome of every record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from urllib.parse import quote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from functools import reduce


@dataclass(frozen=True)
class UpsertOptions:
    join_cols: tuple[str, ...] = ()
    when_matched_update_all: bool = True
    when_not_matched_insert_all: bool = True

    def overridden(self, **options) -> "UpsertOptions":
        """Per-write options win over declared ones, key by key."""
        return replace(self, **{k: v for k, v in options.items() if v is not None})

    def checked(self) -> "UpsertOptions":
        if not self.join_cols:
            raise ValueError("upsert needs join columns")
        return self


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (partial aggregation first, so a hot key is cheap)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def require_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    if not duplicate_keys(df.where(present), keys).isEmpty():
        raise ValueError(f"source holds several rows for one key of {list(keys)}")


def _on(keys: Sequence[str], left: str, right: str, null_safe: bool) -> Column:
    pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def like_target(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source columns by name, in the target's order and types."""
    missing = set(target.columns) ^ set(source.columns)
    if missing:
        raise ValueError(f"source and target differ in columns {sorted(missing)}")
    return source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: bool = True,
    insert: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """Target rows, replaced where the source has their key, plus the source rows without a match.

    The source is unique in the keys (see ``require_unique_keys``). A null key matches nothing
    unless ``null_safe``. Built from a left join and a left anti join instead of one full outer
    join: a small source is then broadcast and the target is not shuffled, and a hot target key
    (or a mass of null keys) is split by the adaptive skew join.
    """
    source = like_target(source, target)
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    on = _on(keys, "t", "s", null_safe)
    out = target
    if update:
        matchable = source if null_safe else source.where(present)
        joined = target.alias("t").join(matchable.withColumn("_hit", F.lit(True)).alias("s"), on, "left")
        out = joined.select(
            *[F.when(F.col("_hit"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns]
        )
    if insert:
        matched = _matched(target, source, keys, null_safe)
        out = out.unionByName(source.alias("s").join(matched.alias("t"), on, "left_anti"))
    return out


def _matched(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Keys found on both sides: at most as many as the source has."""
    return (
        target.alias("t")
        .join(source.select(*keys).alias("s"), _on(keys, "t", "s", null_safe), "left_semi")
        .select(*keys)
        .distinct()
    )


def outcomes(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: bool = True,
    insert: bool = True,
    reject: Column | None = None,
) -> DataFrame:
    """Every source row with its ``outcome``: rejected, inserted, updated, unchanged or unprocessed.

    The target must be unique in the keys; all columns are compared null-safe.
    """
    source = like_target(source, target)
    others = [c for c in target.columns if c not in keys]
    same = reduce(lambda a, b: a & b, [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in others], F.lit(True))
    rejected = F.coalesce(reject, F.lit(False)) if reject is not None else F.lit(False)
    marked = source.withColumn("_rejected", rejected).alias("s").join(
        target.withColumn("_hit", F.lit(True)).alias("t"), _on(keys, "s", "t", False), "left"
    )
    outcome = (
        F.when(F.col("_rejected"), "rejected")
        .when(F.col("_hit").isNull(), "inserted" if insert else "unprocessed")
        .when(same, "unchanged")
        .otherwise("updated" if update else "unprocessed")
    )
    return marked.select(*[F.col(f"s.{c}").alias(c) for c in target.columns], outcome.alias("outcome"))


def result_type() -> Column:
    """The class of an ``outcome``: successful, failed or unprocessed."""
    return (
        F.when(F.col("outcome") == "rejected", "failed")
        .when(F.col("outcome") == "unprocessed", "unprocessed")
        .otherwise("successful")
    )


def outcome_counts(rows: DataFrame, *extra: str) -> DataFrame:
    """Rows per outcome class: successful, failed, unprocessed."""
    return rows.groupBy(*extra, result_type().alias("result_type"), "outcome").agg(F.count(F.lit(1)).alias("n_rows"))


def store_outcomes(rows: DataFrame, root: str, job_id: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Write the rows of ``outcomes`` as JSON lines, one folder per class, and return what was stored.

    The rows are evaluated once; ``extra`` columns of the caller come first. The folder of the job is
    replaced, so a job that runs again leaves no second copy; other jobs below ``root`` stay. Columns
    that clash with ``job_id``, ``result_type`` or an extra name are refused.
    """
    added = {"job_id": F.lit(job_id), **(extra or {})}
    clash = sorted({"result_type", *added} & set(rows.columns))
    if clash or "result_type" in added:
        raise ValueError(f"columns clash with those of the outcome log: {clash or ['result_type']}")
    stored = rows.select(*[c.alias(n) for n, c in added.items()], "*", result_type().alias("result_type"))
    path = f"{root}/job={quote(job_id, safe="")}"
    stored.write.mode("overwrite").partitionBy("result_type").json(path)
    return rows.sparkSession.read.schema(stored.schema).json(path)


def outcome_counters(stored: DataFrame) -> DataFrame:
    """One row per stored job with its number of records of each class, zero where there are none."""
    return stored.groupBy("job_id").agg(*[
        F.count_if(F.col("result_type") == klass).alias(f"{klass}_records")
        for klass in ("successful", "failed", "unprocessed")])
