"""New-file pick-up and event tails; the position lives in the stream checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from assetloom.sources.files import file_facts

# Fixed value: the schema of Spark's binary file source.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType,
                   max_files: int | None = None) -> DataFrame:
    """Files as they arrive, at most ``max_files`` per batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_manifest(spark: SparkSession, path: str, pattern: str | None = None,
                    max_files: int | None = None) -> DataFrame:
    """New files as manifest rows, without reading them."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE).option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.load(path).select("path", "length", "modificationTime")
    return df.withColumns(file_facts(F.col("path"), F.col("length")))


def drain(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None],
          mode: str = "append") -> StreamingQuery:
    """Process everything available now in batches, then stop; failures are raised."""
    query = (
        df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(each).start()
    )
    query.awaitTermination()
    return query
