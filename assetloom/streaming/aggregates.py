"""Windowed and running aggregates over streams, and the per-asset high-water mark."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetloom.operators.events import advance_cursors, reduce_actions
from assetloom.operators.tables import AssetTable
from assetloom.operators.upsert import UpsertOptions


def windowed(df: DataFrame, ts: str, every: str, keys: Sequence[str], aggs: dict[str, Column],
             late: str) -> DataFrame:
    """Aggregates per tumbling event-time window and key; in a stream, rows later than ``late`` are
    left out and a window comes out once it is complete."""
    rows = df.withWatermark(ts, late) if df.isStreaming else df
    out = rows.groupBy(F.window(ts, every), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, *aggs
    )


def high_water_sink(cursors: AssetTable, events: AssetTable, specs: DataFrame, query_id: str,
                    patterns: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that emits actions newer than their asset's cursor and moves the
    cursors. Emitted rows carry the batch in their commit tags; a replayed batch is skipped, and the
    cursors move by maximum, so doing that step again changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        tags = {"query_id": query_id, "batch_id": str(batch_id)}
        spark = batch.sparkSession
        known = cursors.read(allow_missing=True, schema=_cursor_schema(batch))
        if not events.has_tag(**tags):
            events.append(reduce_actions(batch, known, specs, patterns), properties=tags)
        if not cursors.has_tag(**tags):
            emitted = batch_rows(events, tags)
            if emitted is not None:
                moved = advance_cursors(spark.createDataFrame([], known.schema), emitted)
                if cursors.last_version() is None or cursors.last_version().schema_json == "":
                    cursors.overwrite(moved, properties=tags)
                else:
                    cursors.upsert(moved, UpsertOptions(("asset",)), properties=tags)

    return write


def _cursor_schema(batch: DataFrame) -> T.StructType:
    return T.StructType([T.StructField("asset", T.StringType()),
                         T.StructField("last_secs", batch.schema["start_secs"].dataType)])


def batch_rows(table: AssetTable, tags: dict[str, str]) -> DataFrame | None:
    """Rows a tagged append wrote, or None when it wrote none."""
    found = table.history().where("NOT missing")
    for k, v in tags.items():
        found = found.where(F.element_at("properties", k) == v)
    row = found.orderBy(F.desc("version")).first()
    return None if row is None else table.read_commit(row.version)
