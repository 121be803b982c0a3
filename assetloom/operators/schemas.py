"""Schema differences and how a stored schema follows the data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class SchemaDiff:
    added: tuple[str, ...]
    removed: tuple[str, ...]
    retyped: tuple[str, ...]

    def __bool__(self) -> bool:
        return bool(self.added or self.removed or self.retyped)


def schema_diff(stored: T.StructType, new: T.StructType) -> SchemaDiff:
    old = {f.name: f.dataType for f in stored}
    names = {f.name: f.dataType for f in new}
    return SchemaDiff(
        added=tuple(n for n in names if n not in old),
        removed=tuple(n for n in old if n not in names),
        retyped=tuple(n for n in names if n in old and names[n] != old[n]),
    )


def evolve(stored: T.StructType, new: T.StructType, mode: str) -> T.StructType:
    """The stored schema after a write.

    ``error`` refuses any difference, ``update`` drops missing and adds new columns, ``merge`` only
    adds, ``overwrite`` takes the new schema. A changed type is refused by all but ``overwrite``.
    """
    diff = schema_diff(stored, new)
    if mode == "overwrite":
        return new
    if diff.retyped:
        raise ValueError(f"column type changed: {list(diff.retyped)}")
    if mode == "error":
        if diff:
            raise ValueError(f"schema changed: added {list(diff.added)}, removed {list(diff.removed)}")
        return stored
    kept = [f for f in stored if mode == "merge" or f.name not in diff.removed]
    if mode not in ("update", "merge"):
        raise ValueError(f"unknown schema mode {mode!r}")
    return T.StructType(kept + [f for f in new if f.name in diff.added])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name in the schema's order; columns the frame lacks are null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])
