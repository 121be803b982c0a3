"""Late rows of a stream as a side output: every row says whether it came behind the watermark."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from assetloom.operators.tables import AssetTable
from assetloom.session import shuffle_partitions


class _Mark(StatefulProcessor):
    """Marks rows by the watermark that holds for the batch; no state is kept. Columns go by place, as names that
    begin with an underscore reach the operator changed."""

    def __init__(self, names: Sequence[str]):
        self.names = list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        for frame in rows:
            frame.columns = [*self.names, "late", "shard"][: frame.shape[1]]
            yield frame[self.names].assign(late=frame["late"] < watermark)

    def close(self) -> None:
        pass


def split_late(df: DataFrame, ts: str, late: str, keys: Sequence[str] = ()) -> DataFrame:
    """The rows of a stream with ``late``: whether their time lies before the watermark, which Spark keeps ``late``
    behind the latest time of the batches before. Nothing is dropped: the operator meets the time as a number, which
    carries no watermark. Rows are spread by ``keys``, or by all their columns; a null time is never late.
    """
    marked = df.withWatermark(ts, late)
    ms = F.coalesce(F.unix_millis(ts), F.lit(2**62))
    plain = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    zoned = [F.timestamp_micros(F.unix_micros(c)).alias(c) if c == ts else F.col(c) for c in df.columns]
    shard = F.pmod(F.xxhash64(*(keys or df.columns)), F.lit(shuffle_partitions(df.sparkSession)))
    rows = marked.select(*zoned, ms.alias("_ms"), shard.alias("_shard"))
    return rows.groupBy("_shard").transformWithStateInPandas(
        statefulProcessor=_Mark(df.columns), outputStructType=T.StructType([*plain, T.StructField("late", T.BooleanType())]),
        outputMode="append", timeMode="EventTime")


def late_sink(kept: Callable[[DataFrame, int], None], late: AssetTable, query_id: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: rows in time go on to ``kept``, late ones are appended to ``late`` with the batch
    in their commit tags, so a batch played again adds nothing; the history then counts them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            tags = {"query_id": query_id, "batch_id": str(batch_id)}
            if not late.has_tag(**tags):
                late.append(batch.where("late").drop("late"), properties=tags)
            kept(batch.where("NOT late").drop("late"), batch_id)
        finally:
            batch.unpersist()

    return write
