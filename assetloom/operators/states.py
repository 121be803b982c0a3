"""Comparison of states and matching of check results with their specifications."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compare_state(current: DataFrame, last: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys added, removed or changed since the last state (both unique in the keys).

    The two states are tagged, unioned and grouped, so values are compared null-safe without a join.
    """
    values = [c for c in current.columns if c not in keys]
    both = current.select(*keys, F.struct(*values).alias("_now"), F.lit(None).alias("_was")).unionByName(
        last.select(*keys, F.lit(None).alias("_now"), F.struct(*values).alias("_was"))
    )
    seen = both.groupBy(*keys).agg(
        F.first("_now", ignorenulls=True).alias("_now"), F.first("_was", ignorenulls=True).alias("_was")
    )
    same = reduce(lambda a, b: a & b, [F.col(f"_now.{c}").eqNullSafe(F.col(f"_was.{c}")) for c in values])
    change = (
        F.when(F.col("_was").isNull(), "added").when(F.col("_now").isNull(), "removed").when(~same, "changed")
    )
    return seen.withColumn("change", change).where("change IS NOT NULL").select(
        *keys, "change",
        *[F.col(f"_was.{c}").alias(f"old_{c}") for c in values],
        *[F.col(f"_now.{c}").alias(f"new_{c}") for c in values],
    )


def match_checks(results: DataFrame, specs: DataFrame) -> DataFrame:
    """Check results with the asset their spec names; results without a spec stay, marked unmatched."""
    return results.join(specs, "check_name", "left").withColumn("matched", F.col("asset").isNotNull())
