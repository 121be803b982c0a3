"""File sources: Parquet scans, manifests, folder roll-ups, bulk load and export."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetloom.functions.literals import time_literal
from assetloom.functions.names import glob_regex, path_glob_regex
from assetloom.functions.text import path_parts
from assetloom.operators.positions import row_index
from assetloom.session import spread_for_write


def scan_parquet(spark: SparkSession, path: str, *, hive: bool = True, n_rows: int | None = None,
                 index_by: str | None = None, index_name: str = "row_index", index_offset: int = 0,
                 base_path: str | None = None, tolerant: bool = False,
                 schema: T.StructType | None = None) -> DataFrame:
    """Parquet files or folders, with hive partitions, an optional row cap and row index.

    ``tolerant`` skips files that are not Parquet; hidden files (``.`` and ``_``) never count.
    """
    reader = spark.read.option("recursiveFileLookup", str(not hive).lower())
    if base_path:
        reader = reader.option("basePath", base_path)
    if tolerant:
        reader = reader.option("ignoreCorruptFiles", "true")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    if index_by is not None:
        df = row_index(df, index_by, index_name, index_offset)
        return df if n_rows is None else df.where(F.col(index_name) < index_offset + n_rows)
    return df if n_rows is None else df.limit(n_rows)


def scan_or_empty(spark: SparkSession, path: str, schema: T.StructType, allow_missing: bool = True) -> DataFrame:
    """An optional input: absent files load as an empty frame, or raise without ``allow_missing``."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" or not allow_missing:
            raise
        return spark.createDataFrame([], schema)


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Partitions loaded apart as one frame; columns a part lacks are null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def with_partition_key(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumn("_partition_key", F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))


# --- manifests -----------------------------------------------------------------------------------


def file_facts(path: Column, size: Column) -> dict[str, Column]:
    """Name, stem, extension, parent folder and MB of a file, from its path and size."""
    name = F.element_at(F.split(path, "/"), -1)
    has_suffix = name.rlike(r"^.+\.[^.]+$")
    return {
        "name": name,
        "extension": F.when(has_suffix, F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))).otherwise(""),
        "stem": F.when(has_suffix, F.regexp_extract(name, r"^(.+)\.[^.]+$", 1)).otherwise(name),
        "parent": F.regexp_replace(path, r"/?[^/]*$", ""),
        "size_mb": size / F.lit(1024.0 * 1024.0),
    }


def manifest(spark: SparkSession, path: str, *, pattern: str | None = None, recursive: bool = True,
             extension: str | None = None, contains: str | None = None, modified_after: dt.datetime | None = None,
             modified_before: dt.datetime | None = None, limit: int | None = None) -> DataFrame:
    """One row per file without reading it: path, size, time and facts. Time bounds are inclusive,
    extension and name search ignore case. A ``pattern`` without a slash is matched with the names;
    one with slashes with the path below ``path``, ``**`` spanning folders."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        last = pattern.rsplit("/", 1)[-1]
        reader = reader.option("pathGlobFilter", "*" if "**" in last else last)
    df = reader.load(path).select("path", "length", "modificationTime")
    if pattern and "/" in pattern:
        base = path.split(":", 1)[-1].rstrip("/").replace("//", "/")
        df = df.where(F.col("path").rlike(f"\\Q{base}\\E/{path_glob_regex(pattern)}$"))
    df = df.withColumns(file_facts(F.col("path"), F.col("length")))
    return filter_files(df, extension=extension, contains=contains, modified_after=modified_after,
                        modified_before=modified_before, limit=limit)


def filter_files(files: DataFrame, *, extension: str | None = None, contains: str | None = None,
                 name_glob: str | None = None, modified_after: dt.datetime | None = None,
                 modified_before: dt.datetime | None = None, limit: int | None = None) -> DataFrame:
    out, time = files, F.col("modificationTime")
    dtype = files.schema["modificationTime"].dataType
    if extension:
        out = out.where(F.lower("name").endswith(extension.lower()))
    if contains:
        out = out.where(F.contains(F.lower("name"), F.lit(contains.lower())))
    if name_glob:
        out = out.where(F.lower("name").rlike(glob_regex(name_glob.lower())))
    if modified_after:
        out = out.where(time >= time_literal(modified_after, dtype))
    if modified_before:
        out = out.where(time <= time_literal(modified_before, dtype))
    return out if limit is None else out.orderBy("path").limit(limit)


def new_files(files: DataFrame, since: dt.datetime, name_glob: str | None = None) -> DataFrame:
    """Files at or after ``since``, newest first."""
    return filter_files(files, name_glob=name_glob, modified_after=since).orderBy(
        F.desc("modificationTime"), "path"
    )


def read_contents(spark: SparkSession, path: str, files: DataFrame, pattern: str | None = None,
                  recursive: bool = True) -> DataFrame:
    """Contents of the manifest's files. ``pattern`` keeps other files from being opened at all."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).join(files.select("path"), "path", "left_semi").select("path", "length", "content")


def folder_rollup(files: DataFrame, path: str = "path", size: str = "length", time: str = "modificationTime",
                  under: str = "", recursive: bool = True) -> DataFrame:
    """Folders below ``under`` with direct children, all files, bytes and last change.

    A file counts for each of its ancestor folders; counts are combined before the shuffle, so the
    root is no hot spot. Direct children are files in the folder plus its sub-folders.
    """
    parts = path_parts(F.col(path))
    depth = F.size(parts)
    rows = files.select(
        parts.alias("_parts"), depth.alias("_depth"), F.col(size).alias("_size"), F.col(time).alias("_time"),
        F.explode(F.sequence(F.lit(0), depth - 1)).alias("_level"),
    )
    folder = F.array_join(F.slice("_parts", 1, F.col("_level")), "/")
    facts = rows.groupBy(folder.alias("folder"), F.col("_level").alias("level")).agg(
        F.count_if(F.col("_depth") == F.col("_level") + 1).alias("_files"),
        F.count(F.lit(1)).alias("n_files"), F.sum("_size").alias("n_bytes"), F.max("_time").alias("last_change"),
    )
    parent = F.regexp_replace("folder", "/?[^/]*$", "")
    inner = facts.where("level > 0").groupBy(parent.alias("folder")).agg(F.count(F.lit(1)).alias("_folders"))
    out = facts.join(inner, "folder", "left").select(
        "folder", F.when(F.col("level") > 0, parent).alias("parent"), "level",
        (F.col("_files") + F.coalesce("_folders", F.lit(0))).alias("n_children"), "n_files", "n_bytes", "last_change",
    )
    base = "/".join(p for p in under.split("/") if p)
    if base:
        out = out.where((F.col("folder") == base) | F.col("folder").startswith(base + "/"))
    if not recursive:
        out = out.where(F.col("level") == (len(base.split("/")) if base else 0) + 1)
    return out


# --- bulk load and export ------------------------------------------------------------------------


def load_files(spark: SparkSession, path: str, fmt: str, schema: T.StructType,
               options: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of CSV, JSON or Parquet files under an explicit schema, and the lines that do not fit it
    (to be stored as they are: Spark reads them only together with the parsed columns)."""
    reader = spark.read.options(**dict(options or {}))
    if fmt == "parquet":
        good = reader.schema(schema).parquet(path)
        return good, spark.createDataFrame([], "_corrupt_record string")
    wide = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    rows = reader.schema(wide).option("columnNameOfCorruptRecord", "_corrupt_record").format(fmt).load(path)
    bad = F.col("_corrupt_record").isNotNull()
    return rows.where(~bad).drop("_corrupt_record"), rows.where(bad).select("_corrupt_record", *schema.fieldNames())


def export_files(df: DataFrame, path: str, fmt: str, options: Mapping[str, str] | None = None,
                 max_records: int | None = None, mode: str = "error") -> None:
    """A table or query result as files."""
    writer = df.write.mode(mode).options(**dict(options or {}))
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.format(fmt).save(path)


def write_parquet(df: DataFrame, path: str, mode: str = "error", *, compression: str = "zstd",
                  level: int | None = None, row_group_bytes: int | None = None, statistics: bool = True,
                  partition_by: Sequence[str] = (), replace_partitions: bool = False) -> None:
    """Plain Parquet output. ``replace_partitions`` replaces, in place, only partitions in the data."""
    options = {"compression": compression}
    if level is not None:
        options[f"parquet.compression.codec.{compression}.level"] = str(level)
    if row_group_bytes:
        options["parquet.block.size"] = str(row_group_bytes)
    if not statistics:
        options["parquet.column.statistics.enabled"] = "false"
    if replace_partitions:
        mode, options["partitionOverwriteMode"] = "overwrite", "dynamic"
    out = spread_for_write(df, *partition_by) if partition_by else df
    out.write.mode(mode).options(**options).partitionBy(*partition_by).parquet(path)
