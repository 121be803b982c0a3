"""Run and asset event logs reduced to lineage, spans, states, failures, checks and alerts.

A log has ``event_id`` (unique, growing), ``ts``, ``run_id``, ``job_name``, ``event_type``,
``step_key``, ``asset`` and ``partition_key``; operators read only the columns they need.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetloom.functions.literals import time_literal
from assetloom.functions.names import name_filter, nominal_window, starts_with_regex
from assetloom.operators.positions import running_totals
from assetloom.session import checkpointed

# Event types of a run log.
RUN_START, RUN_SUCCESS, RUN_FAILURE, RUN_CANCELED = "RUN_START", "RUN_SUCCESS", "RUN_FAILURE", "RUN_CANCELED"
STEP_START, STEP_SUCCESS, STEP_FAILURE = "STEP_START", "STEP_SUCCESS", "STEP_FAILURE"
PLANNED = "ASSET_MATERIALIZATION_PLANNED"
MATERIALIZED = "ASSET_MATERIALIZATION"
ASSET_FAILED = "ASSET_FAILED_TO_MATERIALIZE"
OBSERVED = "ASSET_OBSERVATION"
CHECK_PLANNED = "ASSET_CHECK_EVALUATION_PLANNED"
CHECKED = "ASSET_CHECK_EVALUATION"
RUN_ENDS = (RUN_SUCCESS, RUN_FAILURE, RUN_CANCELED)
# Lineage event type per log event type.
LINEAGE_TYPES = {
    RUN_START: "START", RUN_SUCCESS: "COMPLETE", RUN_FAILURE: "FAIL", RUN_CANCELED: "ABORT",
    STEP_START: "START", STEP_SUCCESS: "COMPLETE", STEP_FAILURE: "FAIL",
    PLANNED: "START", MATERIALIZED: "COMPLETE", ASSET_FAILED: "FAIL",
}


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), key)


def lineage_events(log: DataFrame, namespace: Column | str) -> DataFrame:
    """One lineage event per log row of a known type: a projection, no shuffle.

    Steps are named ``<job>.<step>`` and point to their run; assets are jobs of their own name with
    the asset as output; observations become dataset events without run and partition.
    """
    kind = F.col("event_type")
    is_step, is_asset = kind.startswith("STEP_"), kind.startswith("ASSET_")
    observed = kind == OBSERVED
    where = F.lit(namespace) if isinstance(namespace, str) else namespace
    window = nominal_window(F.when(~observed, F.col("partition_key")))
    return log.where(kind.isin(*LINEAGE_TYPES, OBSERVED)).select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.when(observed, "DatasetEvent").otherwise("RunEvent").alias("event_class"),
        _lookup(LINEAGE_TYPES, kind).alias("event_type"),
        where.alias("namespace"),
        F.when(observed, F.lit(None)).when(is_step, F.concat_ws(".", "run_id", "step_key"))
        .otherwise(F.col("run_id")).alias("run_id"),
        F.when(is_step, F.col("run_id")).alias("parent_run_id"),
        F.when(observed, F.lit(None)).when(is_asset, F.col("asset"))
        .when(is_step, F.concat_ws(".", "job_name", "step_key")).otherwise(F.col("job_name")).alias("job_name"),
        F.when(is_asset, F.col("asset")).alias("dataset_name"),
        window["start"].alias("nominal_start"),
        window["end"].alias("nominal_end"),
    )


def lineage_json(events: DataFrame) -> DataFrame:
    """The events as JSON documents, ready for a lineage back end."""
    run = F.when(F.col("run_id").isNotNull(), F.struct(
        F.col("run_id").alias("runId"),
        F.when(F.col("parent_run_id").isNotNull(), F.col("parent_run_id")).alias("parentRunId"),
        F.col("nominal_start").alias("nominalStartTime"), F.col("nominal_end").alias("nominalEndTime"),
    ))
    job = F.when(F.col("job_name").isNotNull(), F.struct("namespace", F.col("job_name").alias("name")))
    dataset = F.when(F.col("dataset_name").isNotNull(), F.struct("namespace", F.col("dataset_name").alias("name")))
    return events.select("event_id", F.to_json(F.struct(
        F.col("event_type").alias("eventType"), F.col("event_time").alias("eventTime"),
        run.alias("run"), job.alias("job"), dataset.alias("dataset"),
    )).alias("event"))


def column_lineage(df: DataFrame, asset: str, deps: str, namespace: str) -> DataFrame:
    """Edges output column <- (namespace, asset, column) from a map of dependency lists; a dependency
    without a column is dropped."""
    fields = df.select(F.col(asset).alias("output_asset"), F.explode(deps).alias("output_column", "_deps"))
    edges = fields.select("output_asset", "output_column", F.explode("_deps").alias("d"))
    return edges.where("d.column IS NOT NULL").select(
        "output_asset", "output_column", F.lit(namespace).alias("namespace"),
        F.col("d.asset").alias("input_asset"), F.col("d.column").alias("input_column"),
    )


def step_spans(log: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per step span: from a start (if any) to the finish that follows it (if any).

    A repeated start before the finish belongs to the same span; a finish closes it, and the end of
    the run closes all its steps. Spans are numbered by the closings before the event, so a run with
    most of the events is counted in balanced pieces.
    """
    kind = F.col("event_type")
    rows = log.select("event_id", "ts", "run_id", "step_key", "event_type")
    rows = rows.where(kind.isin(STEP_START, STEP_SUCCESS, STEP_FAILURE, *RUN_ENDS))
    ends = running_totals(rows, ["run_id"], "event_id", {"run_no": kind.isin(*RUN_ENDS).cast("int")}, True, ranges)
    steps = checkpointed(ends.where(kind.startswith("STEP_")))  # numbered once, read three times
    done = kind.isin(STEP_SUCCESS, STEP_FAILURE)
    spans = running_totals(steps, ["run_id", "run_no", "step_key"], "event_id", {"span_no": done.cast("int")},
                           True, ranges)
    started, finished = kind == STEP_START, kind.isin(STEP_SUCCESS, STEP_FAILURE)
    return spans.groupBy("run_id", "run_no", "step_key", "span_no").agg(
        F.min(F.when(started, F.col("ts"))).alias("started"),
        F.max(F.when(finished, F.col("ts"))).alias("finished"),
        F.max(F.when(finished, kind)).alias("outcome"),
        F.count_if(started).alias("n_starts"),
    )


def run_spans(log: DataFrame, ranges: int | None = None) -> DataFrame:
    """One row per run from its first event after the last end to its next end."""
    kind = F.col("event_type")
    rows = log.select("event_id", "ts", "run_id", "event_type").where(kind.isin(RUN_START, *RUN_ENDS))
    ended = kind.isin(*RUN_ENDS)
    numbered = running_totals(rows, ["run_id"], "event_id", {"run_no": ended.cast("int")}, True, ranges)
    return numbered.groupBy("run_id", "run_no").agg(
        F.min(F.when(kind == RUN_START, F.col("ts"))).alias("started"),
        F.max(F.when(ended, F.col("ts"))).alias("finished"),
        F.max(F.when(ended, kind)).alias("outcome"),
    )


def latest_state(log: DataFrame, key: str = "run_id") -> DataFrame:
    """Last event per key."""
    return log.groupBy(key).agg(
        F.max("event_id").alias("last_event_id"),
        F.max_by("event_type", "event_id").alias("state"),
        F.max_by("ts", "event_id").alias("last_ts"),
    )


def open_runs(log: DataFrame, keep: int | None = None) -> DataFrame:
    """Runs whose last event does not end them; ``keep`` most recently touched ones if given."""
    out = latest_state(log).where(~F.col("state").isin(*RUN_ENDS))
    return out if keep is None else out.orderBy(F.desc("last_event_id")).limit(keep)


def missing_as_failed(
    log: DataFrame,
    closing: Sequence[str] = RUN_ENDS,
    failing: Sequence[str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """A failure for every asset planned but not materialized or failed when its run closes.

    The poller's form closes a run on success, failure and cancel and reports on each. The log
    writer's form is ``closing=(RUN_FAILURE, STEP_FAILURE, RUN_SUCCESS, RUN_CANCELED)`` with
    ``failing=(RUN_FAILURE, STEP_FAILURE)``: the other endings drop the plans silently.
    """
    failing = tuple(closing if failing is None else failing)
    kind = F.col("event_type")
    rows = log.select("event_id", "ts", "run_id", "asset", "event_type")
    rows = rows.where(kind.isin(PLANNED, MATERIALIZED, ASSET_FAILED, *closing))
    numbered = running_totals(rows, ["run_id"], "event_id", {"run_no": kind.isin(*closing).cast("int")}, True, ranges)
    numbered = checkpointed(numbered)  # read for the closings and for the plans
    closings = numbered.where(kind.isin(*failing)).select(
        "run_id", "run_no", F.col("event_id").alias("end_id"), F.col("ts").alias("end_ts"),
        F.col("event_type").alias("end_type"),
    )
    pending = (
        numbered.where(kind.isin(PLANNED, MATERIALIZED, ASSET_FAILED))
        .groupBy("run_id", "run_no", "asset")
        .agg(F.max_by("event_type", "event_id").alias("state"))
        .where(F.col("state") == PLANNED)
    )
    return pending.join(closings, ["run_id", "run_no"]).select(
        "run_id", "asset", "end_id", "end_ts", "end_type",
        F.lit("planned for the run, which ended before it was materialized").alias("message"),
    )


def assertions(checks: DataFrame, strict: bool = False, column_keys: Sequence[str] = ("column",)) -> DataFrame:
    """Check results as quality assertions: a warning fails in strict mode even when it passed."""
    warned = F.lit(strict) & (F.col("severity") == "WARN")
    column = F.coalesce(*[F.element_at("metadata", k) for k in column_keys], F.lit(None))
    return checks.withColumns({"success": F.col("passed") & ~warned, "checked_column": column})


def check_runs(log: DataFrame) -> DataFrame:
    """Check rows as runs named ``<asset>__checks``; a check start is reported only when its run
    planned no materialization before it."""
    planned = log.where(F.col("event_type") == PLANNED).groupBy("run_id").agg(F.min("event_id").alias("first_plan"))
    checks = log.where(F.col("event_type").isin(CHECK_PLANNED, CHECKED)).join(planned, "run_id", "left")
    alone = F.col("first_plan").isNull() | (F.col("first_plan") > F.col("event_id"))
    return checks.where((F.col("event_type") == CHECKED) | alone).select(
        "event_id", "ts", "run_id", F.concat("asset", F.lit("__checks")).alias("job_name"),
        F.col("asset").alias("dataset_name"),
        F.when(F.col("event_type") == CHECKED, "COMPLETE").otherwise("START").alias("event_type"),
    )


def reduce_actions(actions: DataFrame, cursors: DataFrame, specs: DataFrame,
                   patterns: Sequence[str] = ()) -> DataFrame:
    """Finished workflow actions newer than their asset's cursor, as typed events.

    ``actions``: asset, state, kind, start_secs and any further columns; ``cursors``: asset,
    last_secs; ``specs``: check_name, parent_asset. A success is a materialization, anything else
    an observation with an alert; an assertion is a check result of its parent, alerting when it
    failed. Assertions no spec names come out as ``unmatched_check`` and do not move the cursor.
    """
    named = actions.where(starts_with_regex(F.col("asset"), patterns) & (F.col("state") != "RUNNING"))
    fresh = named.join(cursors, "asset", "left").where(
        F.col("start_secs") > F.coalesce(F.col("last_secs"), F.lit(0))
    ).drop("last_secs")
    matched = fresh.join(specs.withColumnRenamed("check_name", "asset"), "asset", "left")
    is_check, ok = F.col("kind") == "assertion", F.col("state") == "SUCCEEDED"
    known = ~is_check | F.col("parent_asset").isNotNull()
    event = (
        F.when(~known, "unmatched_check").when(is_check, "check").when(ok, "materialization").otherwise("observation")
    )
    alert = known & ~ok
    label = F.when(is_check, "check-failure").otherwise("invocation-failure")
    return matched.withColumns({
        "event": event,
        "passed": F.when(is_check & known, ok),
        "alert_key": F.when(alert, F.concat_ws("-", label, "asset", F.col("start_secs").cast("string"))),
    })


def advance_cursors(cursors: DataFrame, events: DataFrame) -> DataFrame:
    """Old cursors merged with the latest start handled per asset; never moves back."""
    moved = events.where("event <> 'unmatched_check'").select("asset", F.col("start_secs").alias("last_secs"))
    return cursors.unionByName(moved).groupBy("asset").agg(F.max("last_secs").alias("last_secs"))


def latest_build(builds: DataFrame, environment: str) -> DataFrame:
    """Newest build of the environment's branch that carries no prefix."""
    plain = F.coalesce(F.col("prefix"), F.lit("")) == ""
    return builds.where((F.col("branch") == environment) & plain).orderBy(F.desc("created"), "name").limit(1)


def alert_feed(events: DataFrame, name: str, statuses: Sequence[str] = ("FAILURE",),
               include: Sequence[str] = ("*",), exclude: Sequence[str] = ()) -> DataFrame:
    """Status events to be told about, one row and one key per alert."""
    hit = events.where(F.col("status").isin(*statuses) & name_filter(F.col(name), include, exclude))
    key = F.concat_ws("-", F.lower("status"), name, F.col("event_id").cast("string"))
    return hit.withColumn("alert_key", key)


def started_within(df: DataFrame, ts: str, now: dt.datetime, minutes: int) -> DataFrame:
    """Rows that started in the last ``minutes`` before ``now``."""
    dtype = df.schema[ts].dataType
    return df.where(F.col(ts) > time_literal(now - dt.timedelta(minutes=minutes), dtype))
