"""Query packs, keyed datasets and the registry of custom sources."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetloom.operators.tables import AssetTable
from assetloom.session import spread_for_write


def read_pack(spark: SparkSession, folder: str) -> dict[str, str]:
    """``<group>.<name>`` to SQL text for every ``<folder>/<group>/<name>.sql``."""
    files = spark.read.option("wholetext", "true").option("pathGlobFilter", "*.sql").option(
        "recursiveFileLookup", "true").text(folder)
    parts = F.split("_metadata.file_path", "/")
    rows = files.select(F.element_at(parts, -2).alias("grp"), F.element_at(parts, -1).alias("name"), "value")
    # One row per query file: configuration, not data.
    return {f"{r.grp}.{r.name.removesuffix('.sql')}": r.value for r in rows.orderBy("grp", "name").collect()}


def run_pack(spark: SparkSession, queries: Mapping[str, str], views: Mapping[str, DataFrame],
             root: str | None = None) -> dict[str, DataFrame]:
    """Each query of a pack as a frame; with ``root`` each result is also stored as a table."""
    out = {}
    for name, text in queries.items():
        for view, df in views.items():
            df.createOrReplaceTempView(view)
        out[name] = spark.sql(text)
        if root is not None:
            stored = AssetTable(spark, root, name)
            stored.overwrite(out[name], properties={"query": text})
            out[name] = stored.read(allow_missing=True, schema=out[name].schema)
    return out


# --- datasets by config, revision and split ------------------------------------------------------

# What a key may narrow a dataset by.
KEY_KINDS = ("revision", "config", "date")


def parse_dataset_key(key: str) -> tuple[str, str]:
    """``type:value``; the value may hold further colons."""
    kind, colon, value = key.partition(":")
    if not colon:
        raise ValueError(f"partition key {key!r} is not <type>:<value>")
    if kind not in KEY_KINDS:
        raise ValueError(f"partition key {key!r} names none of {', '.join(KEY_KINDS)}")
    return kind, value


def write_dataset(df: DataFrame, path: str, by: tuple[str, ...] = ("config", "revision", "split")) -> None:
    spread_for_write(df, *by).write.mode("overwrite").partitionBy(*by).parquet(path)


def read_dataset(spark: SparkSession, path: str, key: str | None = None, split: str | None = None,
                 config: str | None = None, revision: str | None = None) -> DataFrame:
    """A stored dataset narrowed to a key and a split; the key overrides config and revision."""
    wanted = {"config": config, "revision": revision, "split": split}
    if key is not None:
        kind, value = parse_dataset_key(key)
        wanted[kind] = value
    df = spark.read.option("basePath", path).parquet(path)
    if "date" in wanted and "date" not in df.columns:
        raise ValueError(f"the dataset has no dates to narrow by {key!r}")
    for column, value in wanted.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    return df


# --- custom sources ------------------------------------------------------------------------------

SourceFunction = Callable[..., DataFrame]


class SourceRegistry:
    """Names for functions ``(spark, **options) -> DataFrame``; later entries may replace earlier."""

    def __init__(self) -> None:
        self._sources: dict[str, SourceFunction] = {}

    def register(self, name: str, source: SourceFunction) -> None:
        self._sources[name] = source

    def load(self, spark: SparkSession, name: str, **options) -> DataFrame:
        if name not in self._sources:
            raise KeyError(f"unknown source {name!r}; known: {sorted(self._sources)}")
        return self._sources[name](spark, **options)
