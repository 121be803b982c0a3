"""Typed literals that do not depend on the session or driver time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip_zone(value: dt.datetime) -> dt.datetime:
    """The UTC wall clock of a zoned value; a plain value is taken as UTC already."""
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def time_literal(value: dt.datetime | dt.date, dtype: T.DataType) -> Column:
    """A date, TIMESTAMP or TIMESTAMP_NTZ literal; folded by Catalyst, so filters are pushed down."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    text = strip_zone(value).isoformat(sep=" ")
    if isinstance(dtype, T.DateType):
        return F.lit(text[:10]).cast("date")
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(dtype, T.TimestampType):
        return F.lit(text + "+00:00").cast("timestamp")
    raise TypeError(f"a time window needs a date or timestamp column, not {dtype.simpleString()}")


def literal(value, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return time_literal(value, dtype)
    return F.lit(value).cast(dtype)
