"""Stored run logs and run messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Message methods, the type given to bare metadata values, log file extensions.
METHODS = ("opened", "log", "report_asset_materialization", "report_asset_check", "report_custom_message", "closed")
INFER = "__infer__"
STREAMS = {"stdout": "out", "stderr": "err"}


def read_logs(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Lines of logs stored as ``<root>/<prefix>/storage/<key...>/<file>.<out|err>``."""
    lines = spark.read.option("recursiveFileLookup", "true").text(root).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")
    )
    return log_lines(lines, prefix)


def log_lines(lines: DataFrame, prefix: str = "") -> DataFrame:
    """Split ``path`` into the log key, the stream and whether the file is a partial upload."""
    inner = "/".join([*(p for p in prefix.split("/") if p), "storage"])
    below = F.regexp_extract("path", rf"(?:^|/){inner}/(.+)$", 1)
    name = F.regexp_extract(below, r"([^/]+)$", 1)
    return lines.where(below != "").select(
        F.concat(
            F.filter(F.split(F.regexp_replace(below, r"/?[^/]+$", ""), "/"), lambda p: p != ""),
            F.array(F.regexp_replace(name, r"\.(out|err)(\.partial)?$", "")),
        ).alias("log_key"),
        F.regexp_extract(name, r"\.(out|err)(?:\.partial)?$", 1).alias("io_type"),
        name.endswith(".partial").alias("is_partial"), "line",
    ).where("io_type <> ''")


def under_key(key: Column, prefix: Sequence[str]) -> Column:
    """Whole key parts match: ``['a']`` does not match ``apple``."""
    if not prefix:
        return F.lit(True)
    return (F.size(key) > len(prefix)) & (F.slice(key, 1, len(prefix)) == F.array(*map(F.lit, prefix)))


def parse_messages(lines: DataFrame, column: str = "value", version_field: str = "version") -> DataFrame:
    """JSON lines as (version, method, params JSON); lines of no known method come out with a null
    method, so nothing is dropped unseen."""
    c = F.col(column)
    method = F.get_json_object(c, "$.method")
    return lines.select(
        *[x for x in lines.columns if x != column],
        F.get_json_object(c, f"$.{version_field}").alias("version"),
        F.when(method.isin(*METHODS), method).alias("method"),
        F.get_json_object(c, "$.params").alias("params"),
    )


def metadata_values(messages: DataFrame, metadata: str) -> DataFrame:
    """One row per metadata entry of a JSON object: (key, raw_value, type). A value that is no
    ``{raw_value, type}`` object keeps itself and gets the inferred type."""
    entry = F.explode(F.from_json(F.col(metadata), "map<string,string>"))
    rows = messages.select(*[c for c in messages.columns if c != metadata], entry.alias("key", "_value"))
    kind, raw = F.get_json_object("_value", "$.type"), F.get_json_object("_value", "$.raw_value")
    typed = F.coalesce(
        F.startswith(F.col("_value"), F.lit("{"))
        & F.array_contains(F.json_object_keys("_value"), "type")
        & F.array_contains(F.json_object_keys("_value"), "raw_value"),
        F.lit(False),
    )
    return rows.select(
        *[c for c in rows.columns if c != "_value"],
        F.when(typed, raw).otherwise(F.col("_value")).alias("raw_value"),
        F.when(typed, kind).otherwise(F.lit(INFER)).alias("type"),
    )


