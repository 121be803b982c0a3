"""Bulk document export: index actions, bounded batches, NDJSON files."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_bulk(df: DataFrame, index: str, id_field: str | None = None) -> DataFrame:
    """``_index``, ``_id`` and the remaining fields as JSON ``_source``. Without the id field the
    id is null and left to the store."""
    has_id = id_field is not None and id_field in df.columns
    fields = [c for c in df.columns if not (has_id and c == id_field)]
    return df.select(
        F.lit(index).alias("_index"),
        (F.col(id_field).cast("string") if has_id else F.lit(None).cast("string")).alias("_id"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("_source"),
    )


def batched(actions: DataFrame, max_docs: int = 500, max_bytes: int = 100 * 1024 * 1024) -> DataFrame:
    """A ``batch_id`` per action: no batch exceeds the number of documents or, unless one document
    alone does, the bytes. Batches are cut along each task's stream of rows; nothing is shuffled."""
    schema = T.StructType(actions.schema.fields + [T.StructField("batch_id", T.StringType())])
    names, out_names = actions.columns, schema.fieldNames()
    tagged = actions.withColumn("_part", F.spark_partition_id()).withColumn("_size", F.octet_length("_source"))

    def run(batches):
        number, docs, size = 0, 0, 0
        for batch in batches:
            sizes = np.asarray(batch.column("_size").fill_null(0), dtype=np.int64)
            upto = np.concatenate([[0], np.cumsum(sizes)])
            numbers, at = np.empty(len(sizes), np.int64), 0
            while at < len(sizes):  # once for each batch cut, not for each row
                fits = int(np.searchsorted(upto, upto[at] + max_bytes - size, "right")) - 1
                end = min(max(fits, at + (docs == 0)), at + max_docs - docs, len(sizes))
                numbers[at:end] = number
                docs, size = docs + end - at, size + int(upto[end] - upto[at])
                if end < len(sizes):
                    number, docs, size = number + 1, 0, 0
                at = end
            part = batch.column("_part")
            ids = pc.binary_join_element_wise(part.cast(pa.string()), pa.array(numbers).cast(pa.string()), "-")
            yield pa.RecordBatch.from_arrays([batch.column(name) for name in names] + [ids], names=out_names)

    return tagged.mapInArrow(run, schema)


def write_ndjson(actions: DataFrame, path: str, max_docs: int = 500) -> None:
    """Action and source lines, as a bulk request wants them, at most ``max_docs`` documents a file."""
    head = F.to_json(F.struct(F.struct("_index", "_id").alias("index")))
    lines = actions.select(F.concat(head, F.lit("\n"), F.col("_source")).alias("value"))
    lines.write.mode("overwrite").option("maxRecordsPerFile", max_docs).text(path)
