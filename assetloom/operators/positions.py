"""Running totals and row numbers that stay balanced when one key holds most of the rows.

A plain window over a hot key sorts the whole key in one task. Here the order column is cut into
ranges at approximate quantiles; the window runs per (key, range) and starts from the total of the
earlier ranges, which enters as one extra row. The bounds are stored once, so the range is a pure
function of the order value and a recomputed partition yields the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from assetloom.session import checkpointed, shuffle_partitions

ROWS_PER_RANGE = 1_000_000


def _ranges_for(df: DataFrame) -> int:
    """As many ranges as the rows need, and no fewer than the tasks."""
    return max(2, shuffle_partitions(df.sparkSession), -(-df.count() // ROWS_PER_RANGE))


def _bounds(df: DataFrame, order: str, ranges: int) -> DataFrame:
    """One stored row: the distinct approximate quantiles of the order column, ascending."""
    dtype = df.schema[order].dataType
    if not isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"rows are ordered by a number, date or time, not by {order!r} of type {dtype.simpleString()}")
    shares = F.split(F.lit(",".join(str(i / ranges) for i in range(1, ranges))), ",").cast("array<double>")
    found = F.approx_percentile(order, shares, ranges * 8)
    return checkpointed(df.agg(F.array_sort(F.array_distinct(found)).alias("bounds")))


def _with_range(df: DataFrame, order: str, ranges: int) -> DataFrame:
    """Add the number of bounds at or below the order value, 0 for null, as ``_range``.

    The bounds are one value that the running query fetches, so the plan does not grow with them; a
    row finds its range by binary search.
    """
    if ranges < 2:
        return df.withColumn("_range", F.lit(0))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(ranges.bit_length()))])
    held = df.withColumn("_bounds", _bounds(df, order, ranges).scalar())

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get("_bounds", at + step - 1) <= F.col(order), at + step).otherwise(at)

    return held.withColumn("_range", F.aggregate(steps, F.lit(0), further)).drop("_bounds")


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    totals: Mapping[str, Column],
    before: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add a running sum per key for every entry of ``totals``, in ``order`` (unique within a key).

    ``before=True`` leaves the row itself out. ``order`` is numeric, a date or a timestamp.
    """
    ranges = ranges or _ranges_for(df)
    work = _with_range(df, order, ranges).withColumns({
        "_first": F.lit(1),
        **{f"_x_{n}": c for n, c in totals.items()},
    })
    sums = work.groupBy(*keys, "_range").agg(*[F.sum(f"_x_{n}").alias(f"_x_{n}") for n in totals])
    earlier = W.partitionBy(*keys or [F.lit(0)]).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carry = sums.select(
        *keys, "_range", F.lit(0).alias("_first"),
        *[F.coalesce(F.sum(f"_x_{n}").over(earlier), F.lit(0)).alias(f"_x_{n}") for n in totals],
    )
    rows = work.unionByName(carry, allowMissingColumns=True)
    upto = W.partitionBy(*keys, "_range").orderBy("_first", order).rowsBetween(
        W.unboundedPreceding, -1 if before else W.currentRow
    )
    out = rows.withColumns({n: F.sum(f"_x_{n}").over(upto) for n in totals})
    return out.where("_first = 1").drop("_range", "_first", *[f"_x_{n}" for n in totals])


def row_index(df: DataFrame, order: str, name: str = "row_index", offset: int = 0,
              ranges: int | None = None) -> DataFrame:
    """A consecutive index from ``offset`` in the order of a unique column, without a global sort."""
    out = running_totals(df, [], order, {name: F.lit(1).cast("bigint")}, before=True, ranges=ranges)
    return out.withColumn(name, F.col(name) + F.lit(offset))


def position_in_group(df: DataFrame, keys: Sequence[str], order: str, name: str = "position",
                      ranges: int | None = None) -> DataFrame:
    """Zero-based position within each key."""
    return running_totals(df, keys, order, {name: F.lit(1).cast("bigint")}, before=True, ranges=ranges)
