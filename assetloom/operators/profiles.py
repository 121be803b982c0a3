"""Row counts, column profiles, previews, dataset metadata, fingerprints and table differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetloom.functions.display import display_value
from assetloom.operators.positions import running_totals
from assetloom.session import checkpointed

QUARTILES = (0.25, 0.5, 0.75)


def row_counts(df: DataFrame, *partition: str) -> DataFrame:
    return df.groupBy(*partition).agg(F.count(F.lit(1)).alias("n_rows"))


def profile(df: DataFrame, accuracy: int = 1000) -> DataFrame:
    """One row per column from a single pass: count, nulls, mean, std, min, quartiles, max.

    Quartiles are sketches, off by at most one ``accuracy``-th of the rows; ``exact_quantiles`` gives
    exact ones. Text and times show min and max as
    text, nested columns only the counts.
    """
    aggs, rows = [], []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        numeric = isinstance(f.dataType, T.NumericType)
        ordered = numeric or isinstance(f.dataType, (T.StringType, T.DateType, T.TimestampType,
                                                     T.TimestampNTZType, T.BooleanType))
        parts = {"n": F.count(c), "nulls": F.count_if(c.isNull())}
        if numeric:
            parts |= {"mean": F.avg(c), "std": F.stddev_samp(c),
                      "q": F.approx_percentile(c.cast("double"), list(QUARTILES), accuracy)}
        if ordered:
            parts |= {"min": F.min(c), "max": F.max(c)}
        i = len(rows)
        aggs += [a.alias(f"{k}_{i}") for k, a in parts.items()]

        def got(key: str, dtype: str, i=i, parts=parts) -> Column:
            return F.col(f"{key}_{i}").cast(dtype) if key in parts else F.lit(None).cast(dtype)

        q = F.col(f"q_{i}") if numeric else None
        rows.append(F.struct(
            F.lit(f.name).alias("column_name"), got("n", "bigint").alias("n_values"),
            got("nulls", "bigint").alias("n_nulls"), got("mean", "double").alias("mean"),
            got("std", "double").alias("std"), got("min", "string").alias("min"),
            *[(q[j].cast("double") if numeric else F.lit(None).cast("double")).alias(n)
              for j, n in enumerate(("p25", "p50", "p75"))],
            got("max", "string").alias("max"),
        ))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float] = QUARTILES) -> DataFrame:
    """Smallest value with at least the given share of rows at or below it.

    Counts per value are running-summed over balanced value ranges, so no task holds all values. The
    counts are read several times and therefore checkpointed.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    counts = checkpointed(counts)
    cumulated = running_totals(counts, [], column, {"_upto": F.col("_n")})
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first().n
    picks = [
        F.min(F.when(F.col("_upto") >= s * total, F.col(column))).alias(f"p{round(s * 100)}") for s in shares
    ]
    return cumulated.agg(*picks).select(F.lit(column).alias("column_name"), "*")


def sample_hash(key: Column, seed: int = 0) -> Column:
    """A portable pseudo-random text per key: the order rows are sampled in."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def first_by_hash(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows, the same on every run whatever the file order (a distributed top-n, no full sort)."""
    return df.orderBy(sample_hash(F.col(key), seed), key).limit(n)


def first_by_key(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first n rows of a stream in key order."""
    return df.orderBy(key).limit(n)


def fraction_by_hash(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    cut = format(min(int(fraction * 16**8), 16**8), "08x") if fraction < 1 else "g"
    return df.where(F.substring(sample_hash(F.col(key), seed), 1, 8) < cut)


def preview(df: DataFrame, key: str, n_rows: int | None = 5, fraction: float | None = None,
            seed: int = 0) -> DataFrame:
    """A sample with display-safe values: n rows, or a fraction (then ``n_rows`` must be None)."""
    if fraction is not None and n_rows is not None:
        raise ValueError("give n_rows or fraction, not both")
    if fraction is not None:
        rows = fraction_by_hash(df, key, fraction, seed)
    else:
        rows = df if n_rows is None else first_by_hash(df, key, n_rows, seed)
    return rows.select(*[display_value(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])


def column_schema(spark: SparkSession, schema: T.StructType,
                  descriptions: dict[str, str] | None = None) -> DataFrame:
    """The schema as a table: position, name, type, description."""
    notes = descriptions or {}
    rows = [(i, f.name, f.dataType.simpleString(), notes.get(f.name, f.metadata.get("comment")))
            for i, f in enumerate(schema)]
    return spark.createDataFrame(rows, "position int, name string, type string, description string")


def row_hash(*columns: str) -> tuple[Column, Column]:
    """Both halves of the MD5 of the row text; null and empty text differ."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    digest = F.md5(F.concat_ws("\x1f", *cells))
    high, low = (F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint") for at in (1, 17))
    return high, low


def fingerprint(df: DataFrame, *by: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Order-free content hash: row count, sums and xors of both halves of the row hashes, per group of ``by``."""
    halves = row_hash(*(columns or df.columns))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.concat_ws(":", *[F.sum(h.cast("decimal(38,0)")).cast("string") for h in halves]).alias("hash_sum"),
        F.concat_ws(":", *[F.bit_xor(h).cast("string") for h in halves]).alias("hash_xor"),
    )


def dataset_metadata(df: DataFrame, split: str | None = None, columns: Sequence[str] | None = None,
                     revision: str | None = None) -> DataFrame:
    """Facts per split: rows, shards (files read), approximate MB, feature names, fingerprint, mode.

    The size is that of the row texts, measured in the same pass as the hash.
    """
    names = list(columns or df.columns)
    cells = F.concat_ws("", *[F.col(c).cast("string") for c in names])
    high, low = row_hash(*names)
    keyed = df.select(
        (F.col(split) if split else F.lit("all")).cast("string").alias("split"),
        high.alias("_h"), low.alias("_l"), F.octet_length(cells).alias("_bytes"), F.col("_metadata.file_path").alias("_file"),
    )
    # Pre-aggregate per file first: the distinct file count then sees one row per file.
    per_file = keyed.groupBy("split", "_file").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_bytes").alias("_bytes"),
        *[F.sum(F.col(x).cast("decimal(38,0)")).alias(f"_sum{x}") for x in ("_h", "_l")],
        *[F.bit_xor(x).alias(f"_xor{x}") for x in ("_h", "_l")],
    )
    return per_file.groupBy("split").agg(
        F.sum("_n").alias("num_rows"), F.count(F.lit(1)).alias("num_shards"),
        F.round(F.sum("_bytes") / (1024 * 1024), 4).alias("estimated_mb"),
        F.concat_ws(":", *[F.sum(f"_sum{x}").cast("string") for x in ("_h", "_l")]).alias("hash_sum"),
        F.concat_ws(":", *[F.bit_xor(f"_xor{x}").cast("string") for x in ("_h", "_l")]).alias("hash_xor"),
    ).select(
        "*", F.lit(",".join(names)).alias("features"), F.lit("batch" if not df.isStreaming else "stream").alias(
            "dataset_type"), F.lit(df.isStreaming).alias("streaming"),
        F.lit("streaming" if df.isStreaming else "materialized").alias("execution_mode"),
        F.lit(revision).cast("string").alias("revision"),
    )


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with both numbers; empty when the tables are equal.

    One grouped count over the tagged union: copies are summed before the shuffle and never expanded.
    """
    columns = left.columns
    tagged = left.withColumns({"_l": F.lit(1), "_r": F.lit(0)}).unionByName(
        right.select(*columns).withColumns({"_l": F.lit(0), "_r": F.lit(1)})
    )
    return (
        tagged.groupBy(*columns)
        .agg(F.sum("_l").alias("n_left"), F.sum("_r").alias("n_right"))
        .where("n_left <> n_right")
    )
