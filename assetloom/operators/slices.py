"""Table slices: partition dimensions, predicates, layout fields and key mappings."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from assetloom.functions.literals import strip_zone, time_literal
from assetloom.operators.positions import row_index


@dataclass(frozen=True)
class StaticDim:
    """A string column and the keys wanted of it."""

    column: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class TimeDim:
    """A date or timestamp column and one half-open window ``[start, end)``."""

    column: str
    start: dt.datetime
    end: dt.datetime


Dim = StaticDim | TimeDim


@dataclass(frozen=True)
class Slice:
    table: str
    columns: tuple[str, ...] | None = None
    dims: tuple[Dim, ...] = field(default=())


def dim_predicate(dim: Dim, schema: T.StructType) -> Column:
    """One dimension as a Column; a dimension without keys selects nothing."""
    if dim.column not in schema.fieldNames():
        raise ValueError(f"partition column {dim.column!r} is not in the table")
    c = F.col(dim.column)
    if isinstance(dim, TimeDim):
        dtype = schema[dim.column].dataType
        start, end = strip_zone(dim.start), strip_zone(dim.end)
        return (c >= time_literal(start, dtype)) & (c < time_literal(end, dtype))
    if not isinstance(schema[dim.column].dataType, T.StringType):
        raise TypeError(f"static keys need a string column, {dim.column!r} is not")
    return c.isin(*dim.keys) if dim.keys else F.lit(False)


def slice_predicate(dims: Iterable[Dim], schema: T.StructType) -> Column:
    """All dimensions together: a box in key space."""
    return reduce(lambda a, b: a & b, [dim_predicate(d, schema) for d in dims], F.lit(True))


def read_slice(df: DataFrame, part: Slice) -> DataFrame:
    """Rows of the slice, only the wanted columns; both reach the scan."""
    out = df.where(slice_predicate(part.dims, df.schema))
    return out.select(*part.columns) if part.columns else out


def split_multi_keys(keys: Sequence[Mapping[str, str]]) -> dict[str, list[str]]:
    """Multi-dimension keys split by dimension; ANDing them selects the box around the keys."""
    out: dict[str, list[str]] = {}
    for key in keys:
        for dim, value in key.items():
            values = out.setdefault(dim, [])
            if value not in values:
                values.append(value)
    return out


def select_exact_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Only the listed key tuples, not the box around them. ``keys`` is a frame of key columns;
    Catalyst broadcasts it when it is small, else the semi join shuffles."""
    return df.join(keys.distinct(), on=keys.columns, how="left_semi")


# --- windows -------------------------------------------------------------------------------------


def merge_windows(windows: Sequence[tuple[dt.datetime, dt.datetime]]) -> tuple[dt.datetime, dt.datetime]:
    """One window from several of equal length that follow one another without a gap."""
    ordered = sorted(windows)
    length = ordered[0][1] - ordered[0][0]
    for before, after in zip(ordered, ordered[1:]):
        if after[1] - after[0] != length:
            raise ValueError("windows differ in length")
        if after[0] != before[1]:
            raise ValueError("windows are not consecutive")
    return ordered[0][0], ordered[-1][1]


def coalesce_windows(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Partition history as runs of consecutive windows: one row per key and run.

    Windows are distinct partition windows, so a group is as long as the partition history of one
    asset, not as the data.
    """
    order = W.partitionBy(*keys).orderBy(start)
    windows = df.select(*keys, start, end).distinct()
    marked = windows.withColumn(
        "_gap", F.when(F.lag(end).over(order) >= F.col(start), F.lit(0)).otherwise(F.lit(1))
    )
    runs = marked.withColumn("_run", F.sum("_gap").over(order))
    return (
        runs.groupBy(*keys, "_run")
        .agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("n_windows"))
        .drop("_run")
    )


# --- layout --------------------------------------------------------------------------------------

# The text form of a partition value per time transform.
TIME_FORMATS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd", "month": "yyyy-MM"}
PYTHON_FORMATS = {"hour": "%Y-%m-%d-%H", "day": "%Y-%m-%d", "month": "%Y-%m"}


def window_transform(start: dt.datetime, end: dt.datetime) -> str:
    """Transform for a partition window: 1 h is hour, 1 or 7 days day, one calendar month month."""
    length = end - start
    if length == dt.timedelta(hours=1):
        return "hour"
    if length in (dt.timedelta(days=1), dt.timedelta(days=7)):
        return "day"
    months = (end.year - start.year) * 12 + end.month - start.month
    last = calendar.monthrange(end.year, end.month)[1]
    if months == 1 and end.day == min(start.day, last) and end.time() == start.time():
        return "month"
    raise ValueError(f"no partition transform for a window of {length}")


@dataclass(frozen=True)
class LayoutField:
    column: str
    transform: str = "identity"
    prefix: str = "part"

    @property
    def name(self) -> str:
        return f"{self.prefix}_{self.column}"


def layout_of(dims: Iterable[Dim], prefix: str = "part") -> tuple[LayoutField, ...]:
    return tuple(
        LayoutField(d.column, window_transform(d.start, d.end) if isinstance(d, TimeDim) else "identity", prefix)
        for d in dims
    )


def partition_by(spec) -> list[str]:
    """Partition columns from metadata: one name, or a map from dimension to column."""
    if isinstance(spec, str):
        return [spec]
    if isinstance(spec, Mapping):
        return list(spec.values())
    raise TypeError("partition_by must be a column name or a map from dimension to column")


def check_layout(layout: Iterable[LayoutField], schema: T.StructType) -> None:
    for f in layout:
        if f.column not in schema.fieldNames():
            raise ValueError(f"partition column {f.column!r} is not in the data")
        dtype = schema[f.column].dataType
        if f.transform in TIME_FORMATS:
            if not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                raise TypeError(f"time partitions need a date or timestamp column, {f.column!r} is not")
        elif not isinstance(dtype, T.StringType):
            raise TypeError(f"key partitions need a string column, {f.column!r} is not")
        if f.name in schema.fieldNames():
            raise ValueError(f"layout field {f.name!r} clashes with a data column")


#: Stands before the empty text, which Spark would store like null, and before texts that begin with it.
_MARK = "\x02"


def encoded_key(key: str | None) -> str | None:
    """The partition value of a text key; null, empty and other texts stay apart."""
    return _MARK + key if key is not None and (not key or key.startswith(_MARK)) else key


def layout_value(f: LayoutField) -> Column:
    if f.transform == "identity":
        c = F.col(f.column)
        return F.when((c == "") | c.startswith(_MARK), F.concat(F.lit(_MARK), c)).otherwise(c)
    return F.date_format(F.col(f.column), TIME_FORMATS[f.transform])


def with_layout(df: DataFrame, layout: Iterable[LayoutField]) -> DataFrame:
    return df.withColumns({f.name: layout_value(f) for f in layout})


def layout_diff(stored: Iterable[LayoutField], wanted: Iterable[LayoutField]) -> dict[str, list[str]]:
    """New, updated (other transform) and deleted fields, by column."""
    old = {f.column: f for f in stored}
    new = {f.column: f for f in wanted}
    return {
        "new": [c for c in new if c not in old],
        "updated": [c for c in new if c in old and new[c] != old[c]],
        "deleted": [c for c in old if c not in new],
    }


def layout_range(dim: TimeDim, transform: str) -> tuple[str, str]:
    """First and last partition value a window touches."""
    fmt = PYTHON_FORMATS[transform]
    return (
        strip_zone(dim.start).strftime(fmt),
        (strip_zone(dim.end) - dt.timedelta(microseconds=1)).strftime(fmt),
    )


def is_aligned(dim: Dim, f: LayoutField) -> bool:
    """Whether the dimension covers whole partitions of the field."""
    if isinstance(dim, StaticDim):
        return f.transform == "identity"
    if f.transform not in PYTHON_FORMATS:
        return False

    def whole(t: dt.datetime) -> bool:
        t = strip_zone(t)
        if t.minute or t.second or t.microsecond:
            return False
        return f.transform == "hour" or (t.hour == 0 and (f.transform == "day" or t.day == 1))

    return whole(dim.start) and whole(dim.end)


# --- key mappings --------------------------------------------------------------------------------


def map_time_offset(keys: DataFrame, key: str, fmt: str, start_offset: int = 0, end_offset: int = 0,
                    unit: str = "day") -> DataFrame:
    """Each downstream date key with the upstream keys its offset window covers."""
    day = F.to_timestamp_ntz(F.col(key), F.lit(fmt))
    steps = F.sequence(
        day + F.expr(f"INTERVAL {start_offset} {unit}"),
        day + F.expr(f"INTERVAL {end_offset} {unit}"),
        F.expr(f"INTERVAL 1 {unit}"),
    )
    return keys.select(
        F.col(key).alias("down_key"), F.explode(F.transform(steps, lambda t: F.date_format(t, fmt))).alias("up_key")
    )


def map_identity(keys: DataFrame, key: str) -> DataFrame:
    return keys.select(F.col(key).alias("down_key"), F.col(key).alias("up_key"))


def map_static(keys: DataFrame, key: str, mapping: Mapping[str, Sequence[str]]) -> DataFrame:
    """A fixed downstream to upstream key map; unmapped keys have no upstream."""
    pairs = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return keys.select(F.col(key).alias("down_key"), F.explode(F.element_at(pairs, F.col(key))).alias("up_key"))


def map_multi_to_single(keys: DataFrame, key: str, position: int) -> DataFrame:
    """The part of a composite ``a|b`` key that belongs to one dimension."""
    return keys.select(
        F.col(key).alias("down_key"), F.split(F.col(key), r"\|").getItem(position).alias("up_key")
    )


#: Number of the schedule's step a time lies in, by unit.
STEP_NUMBERS = {
    "hour": lambda t: F.unix_date(t.cast("date")).cast("bigint") * 24 + F.hour(t),
    "day": lambda t: F.unix_date(t.cast("date")).cast("bigint"),
    "month": lambda t: F.year(t).cast("bigint") * 12 + F.month(t) - 1,
}


def key_runs(keys: DataFrame, key: str, fmt: str, unit: str = "day") -> DataFrame:
    """The stretches of consecutive steps that date keys form: ``first_key``, ``last_key``, ``n_keys``.

    Gaps and islands: within a stretch, step number less position stays the same. The position comes
    from balanced ranges, not from one window over all keys. Repeated keys count once; null keys and
    texts that are no key of the format belong to no stretch.
    """
    if unit not in STEP_NUMBERS:
        raise ValueError(f"a schedule steps by {', '.join(STEP_NUMBERS)}, not by {unit!r}")
    time = F.try_to_timestamp(F.col(key), F.lit(fmt)).cast("timestamp_ntz")
    steps = keys.select(STEP_NUMBERS[unit](time).alias("_step"), F.col(key).alias("_key")).where("_step IS NOT NULL")
    placed = row_index(steps.groupBy("_step").agg(F.min("_key").alias("_key")), "_step", "_at")
    return placed.groupBy((F.col("_step") - F.col("_at")).alias("_run")).agg(
        F.min_by("_key", "_step").alias("first_key"), F.max_by("_key", "_step").alias("last_key"),
        F.count(F.lit(1)).alias("n_keys")).drop("_run")


def _to_window(keys: DataFrame, key: str, window: DataFrame) -> DataFrame:
    fields = {n: window.select(n).scalar() for n in ("first_key", "last_key", "n_keys")}
    return keys.select(F.col(key).alias("down_key")).withColumns(fields)


def map_all(keys: DataFrame, key: str, upstream: DataFrame, up_key: str) -> DataFrame:
    """Each downstream key with the window of all upstream keys (first, last and number of keys).

    The upstream side stays a window, as listing it for each key would multiply the two sides. Without
    upstream keys the window is null and holds 0 keys.
    """
    return _to_window(keys, key, upstream.agg(
        F.min(up_key).alias("first_key"), F.max(up_key).alias("last_key"), F.count_distinct(up_key).alias("n_keys")))


def map_specific(keys: DataFrame, key: str, wanted: DataFrame, wanted_key: str, fmt: str,
                 unit: str = "day") -> DataFrame:
    """Each downstream key with the window of the wanted upstream keys; refused unless those are
    consecutive steps of the schedule, because one read covers one window."""
    runs = key_runs(wanted, wanted_key, fmt, unit)
    found = runs.orderBy("first_key").limit(2).collect()
    if len(found) != 1:
        gap = f"nothing between {found[0].last_key} and {found[1].first_key}" if found else "there are none"
        raise ValueError(f"specific keys must be consecutive: {gap}")
    return _to_window(keys, key, keys.sparkSession.createDataFrame(found, runs.schema))


def stored_for(mapping: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Mapped upstream keys, each marked with whether it is stored."""
    have = stored.select(F.col(key).alias("up_key")).distinct().withColumn("stored", F.lit(True))
    return mapping.join(have, "up_key", "left").select(
        "down_key", "up_key", F.coalesce("stored", F.lit(False)).alias("stored")
    )
