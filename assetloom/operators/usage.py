"""Model usage totals and grouped text assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetloom.operators.positions import position_in_group

# Counters a usage log may carry.
COUNTERS = (
    "input_tokens", "output_tokens", "cache_creation_input_tokens", "cache_read_input_tokens",
    "prompt_token_count", "candidates_token_count", "cached_content_token_count", "total_token_count",
)


def usage_totals(log: DataFrame, by: Sequence[str], final: str | None = None) -> DataFrame:
    """Calls and summed counters per group; null counts as 0.

    ``final`` names a flag that is true on the last row of a response: a streamed response then
    counts once, with its closing numbers.
    """
    rows = log if final is None else log.where(F.col(final))
    found = [c for c in COUNTERS if c in log.columns]
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("calls"), *[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in found]
    )


def assemble_text(df: DataFrame, keys: Sequence[str], order: str, text: str, separator: str = "|",
                  max_items: int | None = None, head: str = "", tail: str = "") -> DataFrame:
    """The texts of each group joined in order inside a prompt, with their number.

    With ``max_items`` a longer group comes out as several numbered parts, which bounds the text of a task.
    """
    placed = position_in_group(df, keys, order, "_pos").withColumn("_text", F.col(text))
    part = F.floor(F.col("_pos") / max_items) if max_items else F.lit(0)
    joined = placed.withColumn("part", part.cast("int")).groupBy(*keys, "part").agg(
        F.count("_text").alias("n_items"), F.sort_array(F.collect_list(F.struct("_pos", "_text"))).alias("_texts"))
    whole = F.array_join(F.transform("_texts", lambda x: x["_text"]), separator)
    return joined.select(*keys, "part", "n_items", F.concat(F.lit(head), whole, F.lit(tail)).alias("prompt"))
