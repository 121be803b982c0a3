"""Curation steps: exact dedupe, length filter, normalisation, step counts and splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetloom.functions.text import content_key, has_words, one_line
from assetloom.operators.profiles import sample_hash
from assetloom.session import spread_for_write


def first_per_key(df: DataFrame, keys: Sequence[str], order: str, count: str | None = None) -> DataFrame:
    """The first row, by ``order``, of every distinct key; null is a key value like any other.

    A grouped minimum instead of a window: copies collapse before the shuffle, so a key that holds
    most of the rows costs one row per task. ``count`` names a column for the number of copies.
    """
    counted = [F.count(F.lit(1)).alias(count)] if count else []
    if any(isinstance(df.schema[k].dataType, T.StringType) for k in keys):  # texts travel as digests, not as keys
        first = F.min(F.struct(order, *[c for c in df.columns if c != order])).alias("_first")
        rows = df.groupBy(content_key(*[F.col(k) for k in keys]).alias("_key")).agg(first, *counted)
        return rows.select(*[F.col(f"_first.{c}").alias(c) for c in df.columns], *([count] if count else []))
    rest = [c for c in df.columns if c not in keys and c != order]
    if not rest:  # a plain number as buffer lets Spark aggregate by hash instead of by sort
        return df.groupBy(*keys).agg(F.min(order).alias(order), *counted).select(
            *df.columns, *([count] if count else []))
    rows = df.groupBy(*keys).agg(F.min(F.struct(order, *rest)).alias("_first"), *counted)
    return rows.select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns], *([count] if count else [])
    )


def long_enough(df: DataFrame, columns: Sequence[str], min_words: int) -> DataFrame:
    return df.where(has_words(min_words, *[F.col(c) for c in columns]))


def normalise_text(df: DataFrame, text: str, url: str, default_url: str = "unknown") -> DataFrame:
    """Text on one line, its length, and the url or a default (also where the column is missing)."""
    source = F.coalesce(F.col(url), F.lit(default_url)) if url in df.columns else F.lit(default_url)
    return df.withColumns({text: one_line(F.col(text)), url: source}).withColumn("text_length", F.length(text))


def curate(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    min_words: int,
    normalise: Mapping[str, Column],
    sample: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Sample, dedupe, filter and normalise; returns the rows and the row count after each step.

    The counts come from the same grouped result as the rows, so they stay exact when tasks are
    retried (an accumulator could count a lost task twice).
    """
    if sample is not None:
        df = df.where(F.substring(sample_hash(F.col(order)), 1, 8) < format(int(sample * 16**8), "08x"))
    unique = first_per_key(df, keys, order, count="_copies")
    valid = unique.withColumn("_valid", has_words(min_words, *[F.col(k) for k in keys]))
    counts = valid.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("sampled"), F.count(F.lit(1)).alias("deduplicated"),
        F.count_if("_valid").alias("filtered"), F.count_if("_valid").alias("normalised"),
    )
    steps = counts.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"), F.col(n).cast("bigint").alias("n_rows"))
        for i, n in enumerate(("sampled", "deduplicated", "filtered", "normalised"))
    ])))
    rows = valid.where("_valid").drop("_valid", "_copies").withColumns(dict(normalise))
    return rows, steps


def assign_split(df: DataFrame, key: str, shares: Mapping[str, float], seed: int = 0) -> DataFrame:
    """A ``split`` column by hash of the key: the same row always falls into the same split."""
    bucket = F.conv(F.substring(sample_hash(F.col(key), seed), 1, 8), 16, 10).cast("double") / float(16**8)
    names = list(shares)
    upto, split = 0.0, F.lit(names[-1])
    bounds = []
    for name in names[:-1]:
        upto += shares[name]
        bounds.append((upto, name))
    for bound, name in reversed(bounds):
        split = F.when(bucket < bound, F.lit(name)).otherwise(split)
    return df.withColumn("split", split)


def write_splits(df: DataFrame, path: str, declared: Sequence[str], wanted: Sequence[str] | None = None) -> None:
    """Store the declared (and wanted) splits side by side; undeclared splits are skipped."""
    names = [s for s in declared if wanted is None or s in wanted]
    rows = spread_for_write(df.where(F.col("split").isin(*names)), "split")
    rows.write.mode("overwrite").partitionBy("split").parquet(path)
