"""Whole lineage documents: run, job, inputs, outputs and their facets, as one JSON text per event.

Besides the columns of a log, a row may carry ``schema`` (array of name, type, description), ``column_deps`` (map of
an output column to an array of asset, column), ``uri``, ``message`` and ``stack_trace``. Missing columns and nulls
leave their facet out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetloom.functions.names import nominal_window
from assetloom.operators.events import ASSET_FAILED, LINEAGE_TYPES, MATERIALIZED, OBSERVED, _lookup

# Fixed value: the time form of lineage documents.
TIME_FORM = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
FACET_COLUMNS = {
    "schema": "array<struct<name: string, type: string, description: string>>",
    "column_deps": "map<string, array<struct<asset: string, column: string>>>",
    "uri": "string", "message": "string", "stack_trace": "string",
}


def input_sets(edges: DataFrame) -> DataFrame:
    """``asset`` (and ``run_id`` where the edges have one) with the set of its inputs."""
    keys = [c for c in ("run_id", "asset") if c in edges.columns]
    return edges.groupBy(*keys).agg(F.sort_array(F.collect_set("input")).alias("inputs"))


def lineage_documents(log: DataFrame, namespace: Column | str, edges: DataFrame | None = None) -> DataFrame:
    """``event_id`` and ``event``: a JSON document per log row of a known type.

    ``edges`` (``asset``, ``input``, optionally ``run_id``) give a materialized asset its inputs: one join, for which
    the log is shuffled only when the sets of inputs are too many to broadcast. All else is a projection.
    """
    kind = F.col("event_type")
    rows = log.where(kind.isin(*LINEAGE_TYPES, OBSERVED)).select("*", *[
        F.lit(None).cast(t).alias(c) for c, t in FACET_COLUMNS.items() if c not in log.columns])
    rows = rows.withColumn("namespace", F.lit(namespace) if isinstance(namespace, str) else namespace)
    if edges is None:
        rows = rows.withColumn("inputs", F.lit(None).cast("array<string>"))
    else:
        sets = input_sets(edges)
        keys = [c for c in ("run_id", "asset") if c in sets.columns]
        done = rows.withColumn("_asset", F.when(kind == MATERIALIZED, F.col("asset"))).alias("l")
        on = [F.col("l._asset") == F.col("s.asset")] + [F.col("l.run_id") == F.col("s.run_id")] * ("run_id" in keys)
        rows = done.join(sets.alias("s"), on, "left").select("l.*", "s.inputs")
    step, asset = kind.startswith("STEP_"), kind.startswith("ASSET_")
    name = F.when(asset, F.col("asset")).when(step, F.concat_ws(".", "job_name", "step_key")).otherwise(F.col("job_name"))
    run = F.struct(
        F.when(step, F.concat_ws(".", "run_id", "step_key")).otherwise(F.col("run_id")).alias("runId"),
        run_facets(kind, step).alias("facets"))
    outputs = F.array(F.struct("namespace", F.col("asset").alias("name"),
                               F.when(kind == MATERIALIZED, dataset_facets()).alias("facets")))
    inputs = F.transform("inputs", lambda x: F.struct(F.col("namespace"), x.alias("name")))
    dataset = F.struct("namespace", F.col("asset").alias("name"), dataset_facets().alias("facets"))
    observed = kind == OBSERVED
    document = F.struct(
        _lookup(LINEAGE_TYPES, kind).alias("eventType"), F.date_format("ts", TIME_FORM).alias("eventTime"),
        F.when(~observed, run).alias("run"),
        F.when(~observed, F.struct("namespace", name.alias("name"))).alias("job"),
        F.when(kind == MATERIALIZED, F.coalesce(inputs, F.array().cast("array<struct<namespace: string, name: string>>")))
        .alias("inputs"),
        F.when(asset & ~observed, outputs).alias("outputs"), F.when(observed, dataset).alias("dataset"))
    return rows.select("event_id", F.to_json(document).alias("event"))


def run_facets(kind: Column, step: Column) -> Column:
    """Parent of a step, nominal time of a finished asset, error of a failed one."""
    parent = F.struct(F.struct(F.col("run_id").alias("runId")).alias("run"),
                      F.struct("namespace", F.col("job_name").alias("name")).alias("job"))
    window = nominal_window(F.when(kind.isin(MATERIALIZED, ASSET_FAILED), F.col("partition_key")))
    nominal = F.struct(F.date_format(window["start"], TIME_FORM).alias("nominalStartTime"),
                       F.date_format(window["end"], TIME_FORM).alias("nominalEndTime"))
    error = F.struct("message", F.lit("python").alias("programmingLanguage"), F.col("stack_trace").alias("stackTrace"))
    return F.struct(
        F.when(step, parent).alias("parent"), F.when(window["start"].isNotNull(), nominal).alias("nominalTime"),
        F.when((kind == ASSET_FAILED) & (F.col("message") != ""), error).alias("errorMessage"))


def dataset_facets() -> Column:
    """Schema, column lineage and source of a dataset; a dependency without a column is dropped."""
    def fields(deps: Column) -> Column:
        known = F.filter(deps, lambda d: d["column"].isNotNull())
        return F.struct(F.transform(known, lambda d: F.struct(
            F.col("namespace"), d["asset"].alias("name"), d["column"].alias("field"))).alias("inputFields"))

    lineage = F.struct(F.transform_values("column_deps", lambda _, deps: fields(deps)).alias("fields"))
    return F.struct(
        F.when(F.col("schema").isNotNull(), F.struct(F.col("schema").alias("fields"))).alias("schema"),
        F.when(F.col("column_deps").isNotNull(), lineage).alias("columnLineage"),
        F.when(F.col("uri") != "", F.struct("uri")).alias("dataSource"))
