"""A run and asset log, workflow actions and a usage log derived from the given tables.

Each has a Spark form and the same thing as SQL text, for queries and for the SQL they are compared
with. A user is a run, the number in ``props`` picks step and asset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetloom.plans.registry import table

LOG_SQL = """log AS (
  SELECT event_id, ts, 'run-' || user_id AS run_id, 'job' || (user_id % 7) AS job_name,
         'step' || (k % 5) AS step_key, 'asset' || (k % 11) AS asset, user_id, value, k,
         CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d') ELSE 'eu' END AS partition_key,
         CASE event_type
           WHEN 'signup' THEN 'STEP_START'
           WHEN 'view' THEN 'ASSET_MATERIALIZATION_PLANNED'
           WHEN 'purchase' THEN 'ASSET_MATERIALIZATION'
           WHEN 'error' THEN CASE k % 5 WHEN 0 THEN 'RUN_FAILURE' WHEN 1 THEN 'STEP_FAILURE'
             WHEN 2 THEN 'ASSET_FAILED_TO_MATERIALIZE' WHEN 3 THEN 'RUN_CANCELED'
             ELSE 'ASSET_CHECK_EVALUATION' END
           ELSE CASE k % 5 WHEN 0 THEN 'RUN_START' WHEN 1 THEN 'RUN_SUCCESS' WHEN 2 THEN 'STEP_SUCCESS'
             WHEN 3 THEN 'ASSET_OBSERVATION' ELSE 'ASSET_CHECK_EVALUATION_PLANNED' END
         END AS event_type
  FROM (SELECT *, json_extract_string(props, '$.k')::BIGINT AS k FROM events))"""


_ONE_KIND = {"signup": "STEP_START", "view": "ASSET_MATERIALIZATION_PLANNED", "purchase": "ASSET_MATERIALIZATION"}
_BY_NUMBER = {
    "error": ("RUN_FAILURE", "STEP_FAILURE", "ASSET_FAILED_TO_MATERIALIZE", "RUN_CANCELED", "ASSET_CHECK_EVALUATION"),
    "click": ("RUN_START", "RUN_SUCCESS", "STEP_SUCCESS", "ASSET_OBSERVATION", "ASSET_CHECK_EVALUATION_PLANNED"),
}


def run_log(events: DataFrame) -> DataFrame:
    """The log; also works on a stream of events."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind = F.when(F.col("event_type").isin(*_ONE_KIND, "error"), F.col("event_type")).otherwise("click")
    named = {**_ONE_KIND, **{f"{name}{i}": x for name, row in _BY_NUMBER.items() for i, x in enumerate(row)}}
    lookup = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    number = F.when(kind.isin(*_BY_NUMBER), F.concat(kind, F.least(F.coalesce(k % 5, F.lit(4)), F.lit(4)))).otherwise(kind)
    return events.select(
        "event_id", "ts", F.concat(F.lit("run-"), "user_id").alias("run_id"),
        F.concat(F.lit("job"), F.col("user_id") % 7).alias("job_name"),
        F.concat(F.lit("step"), k % 5).alias("step_key"), F.concat(F.lit("asset"), k % 11).alias("asset"),
        "user_id", "value", k.alias("k"),
        F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise("eu").alias("partition_key"),
        F.element_at(lookup, number).alias("event_type"))


ACTIONS_SQL = """actions AS (
  SELECT event_id, CASE WHEN user_id % 4 = 0 THEN 'check_' ELSE 'table_' END || user_id AS asset,
         CASE WHEN user_id % 4 = 0 THEN 'assertion' ELSE 'table' END AS kind,
         CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'RUNNING' WHEN 'view' THEN 'CANCELLED'
              ELSE 'SUCCEEDED' END AS state,
         epoch(date_trunc('second', ts))::BIGINT AS start_secs
  FROM events),
 cursors AS (SELECT asset, min(start_secs) + 86400 * 10 AS last_secs FROM actions
             WHERE kind = 'assertion' GROUP BY asset),
 specs AS (SELECT DISTINCT asset AS check_name, 'parent_' || asset AS parent_asset FROM actions
           WHERE kind = 'assertion' AND asset NOT LIKE '%8')"""


def actions(events: DataFrame) -> DataFrame:
    check = F.col("user_id") % 4 == 0
    kind = F.col("event_type")
    return events.select(
        "event_id", F.concat(F.when(check, "check_").otherwise("table_"), "user_id").alias("asset"),
        F.when(check, "assertion").otherwise("table").alias("kind"),
        F.when(kind == "error", "FAILED").when(kind == "signup", "RUNNING").when(kind == "view", "CANCELLED")
        .otherwise("SUCCEEDED").alias("state"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("start_secs"))


def action_cursors(rows: DataFrame) -> DataFrame:
    """Checks were last seen ten days after their first action; tables never."""
    return rows.where("kind = 'assertion'").groupBy("asset").agg(
        (F.min("start_secs") + 86400 * 10).alias("last_secs"))


def check_specs(rows: DataFrame) -> DataFrame:
    checks = rows.where("kind = 'assertion' AND asset NOT LIKE '%8'")
    return checks.select(
        F.col("asset").alias("check_name"), F.concat(F.lit("parent_"), "asset").alias("parent_asset")).distinct()


USAGE_SQL = """usage_log AS (
  SELECT conv_id, turn, 'asset' || (conv_id % 9) AS asset, CASE WHEN turn % 3 = 0 THEN 'summary' END AS output_name,
         CASE WHEN conv_id % 2 = 0 THEN 'messages' ELSE 'generate' END AS provider,
         length(text) AS input_tokens, CASE WHEN role = 'assistant' THEN length(text) // 4 END AS output_tokens,
         role <> 'system' AS is_last FROM conversations)"""


def usage_log(conversations: DataFrame) -> DataFrame:
    """Text lengths stand for token counts; a system turn stands for an unfinished streamed piece."""
    size = F.length("text").cast("bigint")
    return conversations.select(
        "conv_id", "turn", F.concat(F.lit("asset"), F.col("conv_id") % 9).alias("asset"),
        F.when(F.col("turn") % 3 == 0, "summary").alias("output_name"),
        F.when(F.col("conv_id") % 2 == 0, "messages").otherwise("generate").alias("provider"),
        size.alias("input_tokens"),
        F.when(F.col("role") == "assistant", F.floor(size / 4)).alias("output_tokens"),
        (F.col("role") != "system").alias("is_last"))


def log(spark, sf: str) -> DataFrame:
    return run_log(table(spark, sf, "events"))
