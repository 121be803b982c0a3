"""Display-safe values for previews."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def display_value(c: Column, dtype: T.DataType) -> Column:
    """Null becomes '', times and bytes text, nested values JSON, decimals doubles."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(c)
    elif isinstance(dtype, T.BinaryType):
        text = F.hex(c)
    elif isinstance(dtype, T.DecimalType):
        text = c.cast("double").cast("string")
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(""))
