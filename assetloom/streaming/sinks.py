"""Idempotent batch sinks: append, slice overwrite, partition overwrite and upsert."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetloom.operators.tables import AssetTable
from assetloom.operators.upsert import UpsertOptions
from assetloom.session import checkpointed


def table_sink(table: AssetTable, query_id: str, mode: str = "append", keys: Sequence[str] = (),
               order: str | None = None, dims=(), layout=None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function. The batch id goes into the commit's tags, so a batch Spark plays
    again is skipped. An upsert with ``order`` keeps the latest row per key over all batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        tags = {"query_id": query_id, "batch_id": str(batch_id)}
        if table.has_tag(**tags):
            return
        batch = checkpointed(batch)  # one evaluation, however often the write reads it
        options = {"properties": tags}
        head = table.last_version()
        if head is None and layout is not None:
            options["layout"] = layout
        if mode == "append":
            table.append(batch, **options)
        elif mode == "overwrite_slice":
            table.overwrite_slice(batch, dims, **options)
        elif mode == "overwrite_partitions":
            table.overwrite_partitions(batch, **options)
        elif mode == "upsert":
            latest = batch
            if order:
                if head is not None:  # a late batch must not replace newer rows
                    stored = table.read(allow_missing=True, schema=batch.schema)
                    batch = batch.unionByName(stored.join(batch.select(*keys), list(keys), "left_semi"))
                latest = latest_per_key(batch, keys, order)
            if head is None:
                table.overwrite(latest, **options)
            else:
                table.upsert(latest, UpsertOptions(tuple(keys)), **options)
        else:
            raise ValueError(f"unknown sink mode {mode!r}")

    return write


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row per key, as a grouped maximum (copies collapse before the shuffle)."""
    rest = [c for c in df.columns if c not in keys and c != order]
    rows = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("_last"))
    return rows.select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns])


def dedupe_in_stream(df: DataFrame, keys: Sequence[str], ts: str, within: str) -> DataFrame:
    """One row per key among rows that lie ``within`` of each other in event time; state is bounded
    by the watermark."""
    return df.withWatermark(ts, within).dropDuplicatesWithinWatermark(list(keys))


