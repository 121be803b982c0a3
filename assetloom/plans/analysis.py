"""Queries over event logs, checks, profiles, curation and vectors."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from assetloom.functions import names, text
from assetloom.operators import contracts, curation, events, graph, lineage, profiles, states, usage, vectors
from assetloom.operators.contracts import ColumnSpec, Contract, Rule
from assetloom.plans.registry import query, table
from assetloom.plans.run_log import (
    ACTIONS_SQL, LOG_SQL, USAGE_SQL, action_cursors, actions, check_specs, log, usage_log,
)
from assetloom.plans.storage import fresh
from assetloom.session import scratch
from assetloom.sources import files

# White space as in functions.text, for SQL regexes.
_SPACE = (
    r"\t\n\x0B\f\r\x1C-\x1F \x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)


def _words(column: str) -> str:
    return f"len(regexp_extract_all({column}, '[^{_SPACE}]+'))"


# --- graph and states ----------------------------------------------------------------------------

_EDGES_SQL = """edges AS (
  SELECT 'order-' || o_orderkey AS node, 'customer-' || o_custkey AS depends_on FROM orders
  UNION ALL SELECT 'customer-' || c_custkey, 'nation-' || c_nationkey FROM customer
  UNION ALL SELECT 'nation-' || n_nationkey, 'region-' || n_regionkey FROM nation)"""


def _edges(spark, sf):
    def pairs(name, source, target, left, right):
        return table(spark, sf, name).select(
            F.concat_ws("-", F.lit(left), source).alias("node"), F.concat_ws("-", F.lit(right), target)
            .alias("depends_on"))

    return (
        pairs("orders", "o_orderkey", "o_custkey", "order", "customer")
        .unionByName(pairs("customer", "c_custkey", "c_nationkey", "customer", "nation"))
        .unionByName(pairs("nation", "n_nationkey", "n_regionkey", "nation", "region")))


@query(f"""WITH RECURSIVE {_EDGES_SQL},
    chosen AS (SELECT 'customer-' || c_custkey AS node FROM customer WHERE c_mktsegment = 'BUILDING'),
    up(node, steps) AS (SELECT node, 0 FROM chosen
      UNION SELECT e.depends_on, steps + 1 FROM up JOIN edges e ON e.node = up.node),
    down(node, steps) AS (SELECT node, 0 FROM chosen
      UNION SELECT e.node, steps + 1 FROM down JOIN edges e ON e.depends_on = down.node)
    SELECT node, 'selected' AS reached, 0 AS steps FROM chosen
    UNION ALL SELECT node, 'dependency', min(steps) FROM up WHERE steps > 0 GROUP BY node
    UNION ALL SELECT node, 'dependent', min(steps) FROM down WHERE steps > 0 GROUP BY node""")
def dependency_closure(spark, sf):
    nodes = table(spark, sf, "customer").select(
        F.concat_ws("-", F.lit("customer"), "c_custkey").alias("node"), F.array("c_mktsegment").alias("tags"))
    chosen = graph.select_targets(nodes, tags=["BUILDING"])
    return graph.with_dependencies(_edges(spark, sf), chosen, dependencies=True, dependents=True)


@query(f"""WITH {_EDGES_SQL}
    SELECT DISTINCT o.node, c.depends_on FROM edges o JOIN edges c ON o.depends_on = c.node
    WHERE o.node LIKE 'order-%'
    UNION SELECT node, depends_on FROM edges WHERE node LIKE 'nation-%'""")
def hidden_pass_through(spark, sf):
    hidden = table(spark, sf, "customer").select(F.concat_ws("-", F.lit("customer"), "c_custkey").alias("node"))
    return graph.pass_through_hidden(_edges(spark, sf), hidden)


@query("""WITH r AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'check_' || event_type ELSE 'other' END
                       AS check_name, event_type <> 'error' AS passed FROM events)
          SELECT event_id, check_name, passed,
                 CASE WHEN check_name IN ('check_click', 'check_error') THEN 'asset_' || check_name END AS asset,
                 check_name IN ('check_click', 'check_error') AS matched FROM r""")
def check_matching(spark, sf):
    rows = table(spark, sf, "events")
    name = F.when(F.col("user_id") % 3 == 0, F.concat(F.lit("check_"), "event_type")).otherwise("other")
    results = rows.select("event_id", name.alias("check_name"), (F.col("event_type") != "error").alias("passed"))
    specs = spark.createDataFrame(
        [(c, f"asset_{c}") for c in ("check_click", "check_error")], "check_name string, asset string")
    return states.match_checks(results, specs)


@query("""WITH w AS (SELECT user_id, event_type, ts >= TIMESTAMP '2024-01-16' AS late FROM events),
          a AS (SELECT user_id, event_type, count(*) AS n FROM w WHERE NOT late GROUP BY 1, 2),
          b AS (SELECT user_id, event_type, count(*) AS n FROM w WHERE late GROUP BY 1, 2)
          SELECT user_id, event_type, CASE WHEN a.n IS NULL THEN 'added' WHEN b.n IS NULL THEN 'removed'
                   ELSE 'changed' END AS change, a.n AS old_n_rows, b.n AS new_n_rows
          FROM a FULL JOIN b USING (user_id, event_type) WHERE a.n IS DISTINCT FROM b.n""")
def state_comparison(spark, sf):
    rows = table(spark, sf, "events")
    cut = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    keys = ["user_id", "event_type"]
    last, current = profiles.row_counts(rows.where(~cut), *keys), profiles.row_counts(rows.where(cut), *keys)
    return states.compare_state(current, last, keys)


# --- event logs ----------------------------------------------------------------------------------


@query(f"""WITH {LOG_SQL}
    SELECT event_id, ts AS event_time,
      CASE WHEN event_type = 'ASSET_OBSERVATION' THEN 'DatasetEvent' ELSE 'RunEvent' END AS event_class,
      CASE WHEN event_type IN ('RUN_START', 'STEP_START', 'ASSET_MATERIALIZATION_PLANNED') THEN 'START'
           WHEN event_type IN ('RUN_SUCCESS', 'STEP_SUCCESS', 'ASSET_MATERIALIZATION') THEN 'COMPLETE'
           WHEN event_type IN ('RUN_FAILURE', 'STEP_FAILURE', 'ASSET_FAILED_TO_MATERIALIZE') THEN 'FAIL'
           WHEN event_type = 'RUN_CANCELED' THEN 'ABORT' END AS event_type,
      'prod' AS namespace,
      CASE WHEN event_type = 'ASSET_OBSERVATION' THEN NULL WHEN event_type LIKE 'STEP%' THEN run_id || '.' || step_key
           ELSE run_id END AS run_id,
      CASE WHEN event_type LIKE 'STEP%' THEN run_id END AS parent_run_id,
      CASE WHEN event_type = 'ASSET_OBSERVATION' THEN NULL WHEN event_type LIKE 'ASSET%' THEN asset
           WHEN event_type LIKE 'STEP%' THEN job_name || '.' || step_key ELSE job_name END AS job_name,
      CASE WHEN event_type LIKE 'ASSET%' THEN asset END AS dataset_name,
      CASE WHEN event_type <> 'ASSET_OBSERVATION' AND event_id % 3 = 0 THEN date_trunc('day', ts)::TIMESTAMP END
        AS nominal_start,
      CASE WHEN event_type <> 'ASSET_OBSERVATION' AND event_id % 3 = 0
           THEN date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY END AS nominal_end
    FROM log WHERE event_type NOT LIKE 'ASSET_CHECK%'""")
def lineage_events(spark, sf):
    return events.lineage_events(log(spark, sf), "prod")


@query(f"""WITH {LOG_SQL},
    edges AS (SELECT DISTINCT asset, 'asset' || i AS input FROM log, LATERAL (SELECT unnest([k * 3 % 11, (k + 1) % 11]) AS i)),
    sets AS (SELECT asset, string_agg(DISTINCT input, ',' ORDER BY input) AS inputs FROM edges GROUP BY asset)
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time,
      CASE WHEN event_type IN ('RUN_START', 'STEP_START', 'ASSET_MATERIALIZATION_PLANNED') THEN 'START'
           WHEN event_type IN ('RUN_SUCCESS', 'STEP_SUCCESS', 'ASSET_MATERIALIZATION') THEN 'COMPLETE'
           WHEN event_type IN ('RUN_FAILURE', 'STEP_FAILURE', 'ASSET_FAILED_TO_MATERIALIZE') THEN 'FAIL'
           WHEN event_type = 'RUN_CANCELED' THEN 'ABORT' END AS event_type,
      CASE WHEN event_type = 'ASSET_OBSERVATION' THEN NULL WHEN event_type LIKE 'STEP%' THEN run_id || '.' || step_key
           ELSE run_id END AS run_id,
      CASE WHEN event_type LIKE 'STEP%' THEN run_id || ' of prod.' || job_name END AS parent,
      CASE WHEN event_type IN ('ASSET_MATERIALIZATION', 'ASSET_FAILED_TO_MATERIALIZE') AND event_id % 3 = 0 THEN
        strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%S.%fZ') || ' to '
        || strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S.%fZ') END AS nominal,
      CASE WHEN event_type = 'ASSET_FAILED_TO_MATERIALIZE' AND event_id % 5 > 0 THEN 'value ' || event_id % 5 END AS error,
      CASE WHEN event_type = 'ASSET_OBSERVATION' THEN NULL WHEN event_type LIKE 'ASSET%' THEN asset
           WHEN event_type LIKE 'STEP%' THEN job_name || '.' || step_key ELSE job_name END AS job,
      CASE WHEN event_type = 'ASSET_MATERIALIZATION' THEN inputs END AS inputs,
      CASE WHEN event_type LIKE 'ASSET%' AND event_type <> 'ASSET_OBSERVATION' THEN asset END AS output,
      CASE WHEN event_type = 'ASSET_OBSERVATION' THEN asset END AS dataset,
      CASE WHEN event_type IN ('ASSET_MATERIALIZATION', 'ASSET_OBSERVATION') AND event_id % 2 = 0
           THEN 'user_id bigint, value double of purchases' END AS fields,
      CASE WHEN event_type IN ('ASSET_MATERIALIZATION', 'ASSET_OBSERVATION') AND event_id % 4 = 1
           THEN CASE WHEN k % 2 = 0 THEN 'prod.raw.amount' ELSE '' END END AS value_from,
      CASE WHEN event_type IN ('ASSET_MATERIALIZATION', 'ASSET_OBSERVATION') AND k % 7 > 0
           THEN 'file:///data/' || k % 7 END AS uri
    FROM log LEFT JOIN sets USING (asset) WHERE event_type NOT LIKE 'ASSET_CHECK%'""")
def lineage_json(spark, sf):
    """The documents, read again from their JSON text."""
    rows = log(spark, sf)
    k, even = F.col("k"), F.col("event_id") % 2 == 0
    field = lambda *x: F.struct(*[F.lit(v).cast("string").alias(c) for v, c in zip(x, ("name", "type", "description"))])
    dep = lambda asset, column: F.struct(F.lit(asset).alias("asset"), column.cast("string").alias("column"))
    deps = F.create_map(F.lit("value"), F.array(
        dep("raw", F.when(k % 2 == 0, "amount")), dep("all", F.lit(None))))
    rich = rows.withColumns({
        "schema": F.when(even, F.array(field("user_id", "bigint", None), field("value", "double", "purchases"))),
        "column_deps": F.when(F.col("event_id") % 4 == 1, deps),
        "uri": F.when(k % 7 > 0, F.concat(F.lit("file:///data/"), k % 7)).otherwise(""),
        "message": F.when(F.col("event_id") % 5 > 0, F.concat(F.lit("value "), F.col("event_id") % 5))})
    number = rows.groupBy("asset").agg(F.collect_set("k").alias("ks"))
    edges = number.select("asset", F.explode("ks").alias("k")).select("asset", F.explode(F.array(
        F.concat(F.lit("asset"), k * 3 % 11), F.concat(F.lit("asset"), (k + 1) % 11))).alias("input")).distinct()
    v = F.parse_json("event")
    text = lambda path, kind="string": F.try_variant_get(F.col("v"), path, kind)
    joined = lambda path: F.array_join(text(path, "array<struct<name: string>>")["name"], ",")
    facets = F.coalesce(text("$.outputs[0].facets", "variant"), text("$.dataset.facets", "variant"))
    fields = F.try_variant_get(F.col("f"), "$.schema.fields", "array<struct<name: string, type: string, description: string>>")
    value_from = F.try_variant_get(F.col("f"), "$.columnLineage.fields.value.inputFields",
                                   "array<struct<namespace: string, name: string, field: string>>")
    return lineage.lineage_documents(rich, "prod", edges).select("event_id", v.alias("v")).withColumn("f", facets).select(
        "event_id", text("$.eventTime").alias("event_time"), text("$.eventType").alias("event_type"),
        text("$.run.runId").alias("run_id"),
        F.concat(text("$.run.facets.parent.run.runId"), F.lit(" of "), text("$.run.facets.parent.job.namespace"), F.lit("."),
                 text("$.run.facets.parent.job.name")).alias("parent"),
        F.concat(text("$.run.facets.nominalTime.nominalStartTime"), F.lit(" to "),
                 text("$.run.facets.nominalTime.nominalEndTime")).alias("nominal"),
        text("$.run.facets.errorMessage.message").alias("error"), text("$.job.name").alias("job"),
        joined("$.inputs").alias("inputs"), text("$.outputs[0].name").alias("output"),
        text("$.dataset.name").alias("dataset"),
        F.array_join(F.transform(fields, lambda x: F.concat_ws(" of ", F.concat_ws(" ", x["name"], x["type"]),
                                                               x["description"])), ", ").alias("fields"),
        F.array_join(F.transform(value_from, lambda x: F.concat_ws(".", x["namespace"], x["name"], x["field"])), ",")
        .alias("value_from"),
        F.try_variant_get(F.col("f"), "$.dataSource.uri", "string").alias("uri"))


@query("""SELECT 'user' || user_id AS output_asset, x.c AS output_column, 'prod' AS namespace, x.a AS input_asset,
                 x.i AS input_column FROM events, LATERAL (
            SELECT 'value' AS c, event_type AS a, 'value' AS i
            UNION ALL SELECT 'value', 'raw', 'amount' WHERE event_id % 2 = 0
            UNION ALL SELECT 'props', 'raw', 'props') x""")
def column_lineage(spark, sf):
    def dep(asset, column):
        return F.struct(asset.alias("asset"), column.cast("string").alias("column"))

    rows = table(spark, sf, "events").select(
        F.concat(F.lit("user"), "user_id").alias("asset"),
        F.create_map(
            F.lit("value"), F.array(
                dep(F.col("event_type"), F.lit("value")),
                dep(F.lit("raw"), F.when(F.col("event_id") % 2 == 0, "amount"))),
            F.lit("props"), F.array(dep(F.lit("raw"), F.lit("props"))),
        ).alias("deps"))
    return events.column_lineage(rows, "asset", "deps", "prod")


_ENDS = "('RUN_SUCCESS', 'RUN_FAILURE', 'RUN_CANCELED')"


@query(f"""WITH {LOG_SQL},
    a AS (SELECT *, coalesce(sum((event_type IN {_ENDS})::INT) OVER (PARTITION BY run_id ORDER BY event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run_no
          FROM log WHERE event_type LIKE 'STEP%' OR event_type IN {_ENDS}),
    b AS (SELECT *, coalesce(sum((event_type <> 'STEP_START')::INT) OVER (PARTITION BY run_id, run_no, step_key
                    ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS span_no
          FROM a WHERE event_type LIKE 'STEP%')
    SELECT run_id, run_no::BIGINT AS run_no, step_key, span_no::BIGINT AS span_no,
           min(ts) FILTER (WHERE event_type = 'STEP_START') AS started,
           max(ts) FILTER (WHERE event_type <> 'STEP_START') AS finished,
           max(event_type) FILTER (WHERE event_type <> 'STEP_START') AS outcome,
           count(*) FILTER (WHERE event_type = 'STEP_START') AS n_starts
    FROM b GROUP BY 1, 2, 3, 4""")
def step_spans(spark, sf):
    return events.step_spans(log(spark, sf))


@query(f"""WITH {LOG_SQL},
    a AS (SELECT *, coalesce(sum((event_type IN {_ENDS})::INT) OVER (PARTITION BY run_id ORDER BY event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run_no
          FROM log WHERE event_type = 'RUN_START' OR event_type IN {_ENDS})
    SELECT run_id, run_no::BIGINT AS run_no, min(ts) FILTER (WHERE event_type = 'RUN_START') AS started,
           max(ts) FILTER (WHERE event_type IN {_ENDS}) AS finished,
           max(event_type) FILTER (WHERE event_type IN {_ENDS}) AS outcome
    FROM a GROUP BY 1, 2""")
def run_spans(spark, sf):
    return events.run_spans(log(spark, sf))


@query(f"""WITH {LOG_SQL} SELECT run_id, max(event_id) AS last_event_id, arg_max(event_type, event_id) AS state,
    arg_max(ts, event_id) AS last_ts FROM log GROUP BY run_id""")
def latest_run_state(spark, sf):
    return events.latest_state(log(spark, sf))


@query(f"""WITH {LOG_SQL}, s AS (SELECT run_id, max(event_id) AS last_event_id,
             arg_max(event_type, event_id) AS state FROM log GROUP BY run_id)
    SELECT * FROM s WHERE state NOT IN {_ENDS} ORDER BY last_event_id DESC LIMIT 1000""")
def open_runs(spark, sf):
    """The most recently touched open runs (the bounded set is the feature)."""
    return events.open_runs(log(spark, sf), keep=1000).select("run_id", "last_event_id", "state")


def _missing_sql(closing: str, failing: str) -> str:
    return f"""WITH {LOG_SQL},
    a AS (SELECT *, coalesce(sum((event_type IN {closing})::INT) OVER (PARTITION BY run_id ORDER BY event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run_no FROM log),
    p AS (SELECT run_id, run_no, asset, arg_max(event_type, event_id) AS state FROM a
          WHERE event_type IN ('ASSET_MATERIALIZATION_PLANNED', 'ASSET_MATERIALIZATION',
                               'ASSET_FAILED_TO_MATERIALIZE') GROUP BY 1, 2, 3)
    SELECT p.run_id, p.asset, a.event_id AS end_id, a.ts AS end_ts, a.event_type AS end_type
    FROM p JOIN a ON a.run_id = p.run_id AND a.run_no = p.run_no AND a.event_type IN {failing}
    WHERE p.state = 'ASSET_MATERIALIZATION_PLANNED'"""


@query(_missing_sql(_ENDS, _ENDS))
def missing_as_failed(spark, sf):
    return events.missing_as_failed(log(spark, sf)).drop("message")


_WRITER_CLOSING = (events.RUN_FAILURE, events.STEP_FAILURE, events.RUN_SUCCESS, events.RUN_CANCELED)


@query(_missing_sql(str(_WRITER_CLOSING), str(_WRITER_CLOSING[:2])))
def missing_as_failed_by_writer(spark, sf):
    return events.missing_as_failed(log(spark, sf), _WRITER_CLOSING, _WRITER_CLOSING[:2]).drop("message")


@query("""SELECT event_id, event_type AS check_name, value < 50 AND NOT (user_id % 2 = 0) AS success,
                 CASE WHEN user_id % 5 = 0 THEN 'value' END AS checked_column FROM events""")
def quality_assertions(spark, sf):
    checks = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("check_name"), (F.col("value") < 50).alias("passed"),
        F.when(F.col("user_id") % 2 == 0, "WARN").otherwise("ERROR").alias("severity"),
        F.when(F.col("user_id") % 5 == 0, F.create_map(F.lit("column"), F.lit("value"))).alias("metadata"))
    return events.assertions(checks, strict=True).select("event_id", "check_name", "success", "checked_column")


@query(f"""WITH {LOG_SQL}, p AS (SELECT run_id, min(event_id) AS first_plan FROM log
                                 WHERE event_type = 'ASSET_MATERIALIZATION_PLANNED' GROUP BY run_id)
    SELECT event_id, l.run_id, asset || '__checks' AS job_name,
           CASE WHEN event_type = 'ASSET_CHECK_EVALUATION' THEN 'COMPLETE' ELSE 'START' END AS event_type
    FROM log l LEFT JOIN p ON p.run_id = l.run_id
    WHERE event_type = 'ASSET_CHECK_EVALUATION' OR (event_type = 'ASSET_CHECK_EVALUATION_PLANNED'
      AND (first_plan IS NULL OR first_plan > event_id))""")
def check_runs(spark, sf):
    return events.check_runs(log(spark, sf)).select("event_id", "run_id", "job_name", "event_type")


@query("""WITH r AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN '' ELSE 'team' || (user_id % 3) END AS team
                     FROM events)
          SELECT event_id, CASE WHEN team = '' THEN 'prod/lake' ELSE 'prod/' || team || '/lake' END AS namespace
          FROM r""")
def namespace_template(spark, sf):
    team = F.col("user_id") % 3
    tags = F.when(team != 0, F.create_map(F.lit("team"), F.concat(F.lit("team"), team))).otherwise(
        F.create_map().cast("map<string,string>"))
    return table(spark, sf, "events").select(
        "event_id", names.namespace_of("/{namespace}//{tag:team}/lake/", "prod", tags).alias("namespace"))


_EVENT_SQL = """reduced AS (
  SELECT a.event_id, a.asset, a.start_secs, a.state,
    CASE WHEN kind = 'assertion' AND parent_asset IS NULL THEN 'unmatched_check' WHEN kind = 'assertion' THEN 'check'
         WHEN state = 'SUCCEEDED' THEN 'materialization' ELSE 'observation' END AS event,
    CASE WHEN kind = 'assertion' AND parent_asset IS NOT NULL THEN state = 'SUCCEEDED' END AS passed,
    CASE WHEN state <> 'SUCCEEDED' AND (kind <> 'assertion' OR parent_asset IS NOT NULL) THEN
      CASE WHEN kind = 'assertion' THEN 'check-failure-' ELSE 'invocation-failure-' END || a.asset || '-' || start_secs
      END AS alert_key
  FROM actions a LEFT JOIN cursors c ON c.asset = a.asset LEFT JOIN specs s ON s.check_name = a.asset
  WHERE state <> 'RUNNING' AND start_secs > coalesce(last_secs, 0)
    AND regexp_matches(a.asset, '^(?:(?:check_)|(?:table_[1-7]))'))"""
_PATTERNS = ("check_", "table_[1-7]")


def _reduced(spark, sf):
    rows = actions(table(spark, sf, "events"))
    cursors = action_cursors(rows)
    return cursors, events.reduce_actions(rows, cursors, check_specs(rows), _PATTERNS)


@query(f"WITH {ACTIONS_SQL}, {_EVENT_SQL} SELECT event_id, asset, event, passed, alert_key FROM reduced")
def workflow_actions(spark, sf):
    return _reduced(spark, sf)[1].select("event_id", "asset", "event", "passed", "alert_key")


@query(f"""WITH {ACTIONS_SQL}, {_EVENT_SQL}, u AS (SELECT asset, last_secs FROM cursors
    UNION ALL SELECT asset, start_secs FROM reduced WHERE event <> 'unmatched_check')
    SELECT asset, max(last_secs) AS last_secs FROM u GROUP BY asset""")
def workflow_cursors(spark, sf):
    return events.advance_cursors(*_reduced(spark, sf))


@query("""SELECT event_id::VARCHAR AS name, ts AS created FROM events
          WHERE event_type = 'click' AND user_id % 2 = 1 ORDER BY ts DESC LIMIT 1""")
def latest_build(spark, sf):
    builds = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("name"), F.col("event_type").alias("branch"),
        F.when(F.col("user_id") % 2 == 0, "test").alias("prefix"), F.col("ts").alias("created"))
    return events.latest_build(builds, "click").select("name", "created")


@query(f"""WITH {LOG_SQL} SELECT event_id, job_name, 'run_failure-' || job_name || '-' || event_id AS alert_key
    FROM log WHERE event_type = 'RUN_FAILURE' AND regexp_matches(job_name, '^job[0-4]$') AND job_name <> 'job3'""")
def alert_feed(spark, sf):
    rows = log(spark, sf).withColumn("status", F.col("event_type"))
    return events.alert_feed(rows, "job_name", (events.RUN_FAILURE,), ("job[0-4]",), ("job3",)).select(
        "event_id", "job_name", "alert_key")


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 2880 MINUTE")
def started_within(spark, sf):
    now = dt.datetime(2024, 1, 20, 12)
    return events.started_within(table(spark, sf, "events"), "ts", now, 2880).select("event_id", "ts")


# --- counts, profiles, checks --------------------------------------------------------------------


@query("SELECT event_type, ts::DATE AS day, count(*) AS n_rows FROM events GROUP BY 1, 2")
def partition_row_counts(spark, sf):
    return profiles.row_counts(
        table(spark, sf, "events").withColumn("day", F.to_date("ts")), "event_type", "day")


_PROFILED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


@query(" UNION ALL ".join(f"""SELECT '{c}' AS column_name, count({c}) AS n_values,
    count(*) - count({c}) AS n_nulls, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
    min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM lineitem""" for c in _PROFILED))
def column_profile(spark, sf):
    out = profiles.profile(table(spark, sf, "lineitem").select(*_PROFILED))
    return out.select(
        "column_name", "n_values", "n_nulls", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
        F.col("min").cast("double").alias("min"), F.col("max").cast("double").alias("max"))


@query(" UNION ALL ".join(f"""SELECT '{c}' AS column_name, quantile_disc({c}, 0.25)::DOUBLE AS p25,
    quantile_disc({c}, 0.5)::DOUBLE AS p50, quantile_disc({c}, 0.75)::DOUBLE AS p75 FROM lineitem"""
    for c in ("l_extendedprice", "l_quantity")))
def exact_quartiles(spark, sf):
    lines = table(spark, sf, "lineitem")
    parts = [profiles.exact_quantiles(lines, c) for c in ("l_extendedprice", "l_quantity")]
    return parts[0].unionByName(parts[1])


@query("""SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_size::VARCHAR AS p_size FROM part
          ORDER BY md5('0:' || part.p_partkey) LIMIT 5""")
def sample_preview(spark, sf):
    return profiles.preview(table(spark, sf, "part").select("p_partkey", "p_name", "p_size"), "p_partkey")


_ROW = "md5(concat_ws(chr(31), doc_id::VARCHAR, md5(text), lang, source, n_chars::VARCHAR))"
_HALVES = [f"('0x' || substr({_ROW}, {at}, 16))::UBIGINT" for at in (1, 17)]
_SIGNED = [f"(CASE WHEN {h} >= 9223372036854775808 THEN {h}::HUGEINT - 18446744073709551616 ELSE {h}::HUGEINT END)"
           for h in _HALVES]
_HASH_SUM = " || ':' || ".join(f"sum({h})::VARCHAR" for h in _SIGNED)
_HASH_XOR = " || ':' || ".join(f"bit_xor({h}::BIGINT)::VARCHAR" for h in _SIGNED)


@query(f"""SELECT lang AS split, count(*) AS num_rows, {_HASH_SUM} AS hash_sum,
                  {_HASH_XOR} AS hash_xor, 'doc_id,text,lang,source,n_chars' AS features, false AS streaming,
                  'materialized' AS execution_mode, 'main' AS revision FROM documents GROUP BY lang""")
def dataset_metadata(spark, sf):
    docs = table(spark, sf, "documents").withColumn("text", F.md5("text"))
    names_ = ["doc_id", "text", "lang", "source", "n_chars"]
    return profiles.dataset_metadata(docs, "lang", names_, "main").select(
        "split", "num_rows", "hash_sum", "hash_xor", "features", "streaming", "execution_mode", "revision")


@query(f"""SELECT source, count(*) AS n_rows, {_HASH_SUM} AS hash_sum, {_HASH_XOR} AS hash_xor
           FROM documents GROUP BY source""")
def content_fingerprint(spark, sf):
    docs = table(spark, sf, "documents").withColumn("text", F.md5("text"))
    return profiles.fingerprint(docs, "source", columns=["doc_id", "text", "lang", "source", "n_chars"])


@query(f"""WITH {USAGE_SQL} SELECT asset, output_name, provider, count(*) AS calls,
    sum(input_tokens)::BIGINT AS input_tokens, sum(coalesce(output_tokens, 0))::BIGINT AS output_tokens
    FROM usage_log WHERE is_last GROUP BY 1, 2, 3""")
def usage_totals(spark, sf):
    return usage.usage_totals(
        usage_log(table(spark, sf, "conversations")), ["asset", "output_name", "provider"], "is_last")


@query("""WITH f AS (SELECT user_id, count(*) AS n_documents,
                            count(*) FILTER (WHERE event_type = 'error') AS n_failures FROM events GROUP BY 1)
          SELECT user_id, n_documents, n_failures, 'WARN' AS severity,
                 n_documents >= 20 AND n_failures <= 15 AS passed FROM f""")
def threshold_checks(spark, sf):
    facts = table(spark, sf, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("event_type") == "error", 1)).alias("bad"))
    return contracts.threshold_checks(facts, "n", "bad", 20, 15, "WARN")


_ORDERS_CONTRACT = dict(
    columns=(
        ColumnSpec("o_orderkey", "bigint", nullable=False, unique=True, description="order number"),
        ColumnSpec("o_custkey", "bigint", nullable=False, unique=True),
        ColumnSpec("o_totalprice", "string"), ColumnSpec("o_comment", "string"),
        ColumnSpec("o_orderstatus", "string"), ColumnSpec("o_orderdate", "timestamp_ntz"),
    ),
)


@query("""SELECT * FROM (VALUES ('missing_column', 'o_comment', 'ERROR', 1, false),
             ('extra_column', 'o_orderpriority', 'ERROR', 1, false), ('wrong_type', 'o_totalprice', 'ERROR', 1, false))
            v(check_name, column_name, severity, n_failed, passed)
    UNION ALL SELECT 'not_null', 'o_orderkey', 'ERROR', count(*), count(*) = 0 FROM orders WHERE o_orderkey IS NULL
    UNION ALL SELECT 'not_null', 'o_custkey', 'ERROR', count(*), count(*) = 0 FROM orders WHERE o_custkey IS NULL
    UNION ALL SELECT 'high_price', '', 'WARN', count(*), count(*) = 0 FROM orders WHERE NOT (o_totalprice < 400000)
    UNION ALL SELECT 'unique', 'o_orderkey', 'ERROR', coalesce(sum(n), 0), coalesce(sum(n), 0) = 0
      FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey) WHERE n > 1
    UNION ALL SELECT 'unique', 'o_custkey', 'ERROR', coalesce(sum(n), 0), coalesce(sum(n), 0) = 0
      FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey) WHERE n > 1""")
def contract_checks(spark, sf):
    rule = Rule("high_price", F.col("o_totalprice") < 400000, "WARN")
    return contracts.check(table(spark, sf, "orders"), Contract(**_ORDERS_CONTRACT, rules=(rule,)))


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN n_chars < 200 THEN 'long' END,
                   CASE WHEN n > 1 THEN 'unique:text' END], lambda x: x IS NOT NULL), ',') AS violations
          FROM (SELECT *, count(*) OVER (PARTITION BY text) AS n FROM documents) WHERE n > 1 OR n_chars < 200""")
def contract_violations(spark, sf):
    wanted = Contract(
        (ColumnSpec("doc_id", "bigint", False), ColumnSpec("text", "string", False, unique=True)),
        (Rule("long", F.col("n_chars") >= 200),), allow_extra=True)
    rows = contracts.violating_rows(table(spark, sf, "documents"), wanted)
    return rows.select("doc_id", F.array_join("violations", ",").alias("violations"))


@query("""SELECT 'no_debt' AS check_name, 'customer' AS asset, count(*) AS n_failed,
                 CASE WHEN count(*) = 0 THEN 'SUCCEEDED' ELSE 'FAILED' END AS state, count(*) = 0 AS passed
          FROM customer WHERE c_acctbal < -500""")
def sql_assertion(spark, sf):
    return contracts.sql_assertion(
        spark, "no_debt", "customer", "SELECT * FROM {customers} WHERE c_acctbal < -500",
        {"customers": table(spark, sf, "customer")})


@query("""SELECT conv_id, turn // 4 AS part, count(*) AS n_items,
                 'Summarise: ' || string_agg(text, '|' ORDER BY turn) || '.' AS prompt
          FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn
                FROM conversations) GROUP BY 1, 2""")
def assembled_text(spark, sf):
    return usage.assemble_text(
        table(spark, sf, "conversations"), ["conv_id"], "turn", "text", max_items=4, head="Summarise: ", tail=".")


@query("SELECT user_id, max(ts) AS last_updated FROM events GROUP BY user_id")
def last_updated(spark, sf):
    rows = table(spark, sf, "events")
    return contracts.last_updated(rows, rows, "user_id", "ts")


@query("""WITH u AS (SELECT user_id, max(ts) AS last_updated FROM events GROUP BY user_id)
          SELECT *, floor(epoch(TIMESTAMP '2024-01-31' - last_updated) / 60)::BIGINT AS lag_minutes,
                 TIMESTAMP '2024-01-31' - last_updated > INTERVAL 1440 MINUTE AS is_late FROM u""")
def freshness(spark, sf):
    rows = table(spark, sf, "events")
    updates = contracts.last_updated(rows, rows, "user_id", "ts")
    return contracts.freshness(updates, dt.datetime(2024, 1, 31))


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def first_rows(spark, sf):
    return profiles.first_by_key(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 100)


@query("SELECT doc_id, lang FROM documents WHERE substr(md5('3:' || doc_id), 1, 8) < '40000000'")
def sample_fraction(spark, sf):
    return profiles.fraction_by_hash(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 0.25, 3)


@query("""SELECT l_orderkey, l_partkey, 1 AS n_left, 0 AS n_right FROM lineitem WHERE l_discount > 0.09
          UNION ALL SELECT -l_orderkey - 1, l_partkey, 0, 1 FROM lineitem WHERE l_tax > 0.07""")
def table_difference(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_discount", "l_tax")
    added = lines.where("l_tax > 0.07").withColumn("l_orderkey", -F.col("l_orderkey") - 1)
    changed = lines.where("NOT l_discount > 0.09").unionByName(added)
    return profiles.difference(lines, changed).select("l_orderkey", "l_partkey", "n_left", "n_right")


# --- curation ------------------------------------------------------------------------------------


@query("""SELECT min(doc_id) AS doc_id, lang, md5(text) AS text_hash FROM documents GROUP BY text, lang""")
def exact_dedupe(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    rows = curation.first_per_key(docs, ["text", "lang"], "doc_id")
    return rows.select("doc_id", "lang", F.md5("text").alias("text_hash"))


@query(f"SELECT doc_id, {_words('text')} AS n_words FROM documents WHERE {_words('text')} >= 50")
def length_filter(spark, sf):
    docs = curation.long_enough(table(spark, sf, "documents").select("doc_id", "text"), ["text"], 50)
    return docs.select("doc_id", text.word_count(F.col("text")).cast("bigint").alias("n_words"))


@query(f"""WITH n AS (SELECT doc_id, replace(regexp_replace(text, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g'),
                             chr(10), ' ') AS text FROM documents)
           SELECT doc_id, md5(text) AS text_hash, length(text) AS text_length, 'unknown' AS url FROM n""")
def normalised_text(spark, sf):
    docs = curation.normalise_text(table(spark, sf, "documents").select("doc_id", "text"), "text", "url")
    return docs.select("doc_id", F.md5("text").alias("text_hash"), "text_length", "url")


def _pairs(spark, sf):
    """Each conversation turn and its role as a question pair."""
    return table(spark, sf, "conversations").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.col("text").alias("question1"),
        F.concat_ws(" ", F.lit("Is this what a"), "role", F.lit("would say?")).alias("question2"))


_PAIRS_SQL = f"""pairs AS (SELECT conv_id * 100 + turn AS id, text AS question1,
    'Is this what a ' || role || ' would say?' AS question2 FROM conversations),
  firsts AS (SELECT min(id) AS id, question1, question2 FROM pairs GROUP BY question1, question2),
  kept AS (SELECT * FROM firsts WHERE {_words('question1')} >= 5)"""


def _curated(spark, sf):
    both = ("question1", "question2")
    return curation.curate(
        _pairs(spark, sf), both, "id", 5, {c: text.normal_case(F.col(c)) for c in both})


@query(f"""WITH {_PAIRS_SQL} SELECT id, md5(lower(regexp_replace(question1, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')))
    AS question1_hash, lower(question2) AS question2 FROM kept""")
def curated_pairs(spark, sf):
    rows = _curated(spark, sf)[0]
    return rows.select("id", F.md5("question1").alias("question1_hash"), "question2")


@query(f"""WITH {_PAIRS_SQL} SELECT 0 AS step, 'sampled' AS name, count(*) AS n_rows FROM pairs
    UNION ALL SELECT 1, 'deduplicated', count(*) FROM firsts UNION ALL SELECT 2, 'filtered', count(*) FROM kept
    UNION ALL SELECT 3, 'normalised', count(*) FROM kept""")
def curation_counts(spark, sf):
    return _curated(spark, sf)[1]


@query("""SELECT doc_id, CASE WHEN b < 0.7 THEN 'train' WHEN b < 0.9 THEN 'valid' ELSE 'test' END AS split
          FROM (SELECT doc_id, ('0x' || substr(md5('5:' || doc_id), 1, 8))::BIGINT / 4294967296.0 AS b
                FROM documents) WHERE b < 0.9""")
def split_subset(spark, sf):
    """Three declared splits, two of them wanted."""
    docs = curation.assign_split(
        table(spark, sf, "documents").select("doc_id"), "doc_id", {"train": 0.7, "valid": 0.2, "test": 0.1}, 5)
    path = scratch(spark, "splits")
    curation.write_splits(docs, path, ["train", "valid", "test"], ["train", "valid"])
    return spark.read.parquet(path).select("doc_id", "split")


@query("""SELECT page_id, regexp_replace(regexp_replace(lower(url), '[^\\p{L}\\p{N}]', '-', 'g'), '^-+|-+$', '', 'g')
                   AS slug, array_to_string(list_filter(string_split(url, '/'), lambda x: x <> ''), '/') AS path,
                 'config' AS kind, url || ':' || page_id AS value FROM pages""")
def text_keys(spark, sf):
    url = F.col("url")
    key = text.typed_key(F.lit("config"), F.concat_ws(":", url, "page_id"))
    parsed = text.parse_typed_key(key)
    return table(spark, sf, "pages").select(
        "page_id", text.slug(url).alias("slug"), text.clean_path(url).alias("path"), parsed["kind"].alias("kind"),
        parsed["value"].alias("value"))


# --- vectors -------------------------------------------------------------------------------------


def _corpus(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def _label_means(spark, sf):
    """The mean vector of every label: the queries."""
    rows = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = rows.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("vector"))


_NEAREST = """WITH e AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS i FROM embeddings),
    m AS (SELECT label, i, avg(x) AS x FROM e GROUP BY label, i),
    q AS (SELECT label AS query_id, list(x ORDER BY i) AS v FROM m GROUP BY label),
    s AS (SELECT query_id, vec_id AS id, round(list_cosine_similarity(embedding::DOUBLE[], v), 9) AS cosine
          FROM embeddings, q),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, id) AS rank FROM s)
    SELECT query_id::BIGINT AS query_id, id, rank, round((1 + cosine) / 2, 6) AS certainty FROM r WHERE rank <= 5"""


@query(_NEAREST)
def nearest_vectors(spark, sf):
    found = vectors.nearest(_corpus(spark, sf), _label_means(spark, sf), 5)
    return found.select("query_id", "id", F.col("rank").cast("bigint").alias("rank"),
                        F.round("certainty", 6).alias("certainty"))


@query(r"""WITH d AS (SELECT doc_id AS id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
                  lambda w: w <> '')) AS term FROM documents),
    q AS (SELECT item_id AS query_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
                  lambda w: w <> '')) AS term FROM benchmark),
    n AS (SELECT count(*) + 1.0 AS n FROM documents),
    f AS (SELECT term, count(DISTINCT id) AS df FROM d GROUP BY term),
    dw AS (SELECT id, term, count(*) * ln(any_value(n) / (any_value(df) + 1)) AS w FROM d JOIN f USING (term), n
           GROUP BY id, term),
    qw AS (SELECT query_id, term, count(*) * ln(any_value(n) / (coalesce(any_value(df), 0) + 1)) AS w
           FROM q LEFT JOIN f USING (term), n GROUP BY query_id, term),
    dl AS (SELECT id, sqrt(sum(w * w)) AS l FROM dw GROUP BY id),
    ql AS (SELECT query_id, sqrt(sum(w * w)) AS l FROM qw GROUP BY query_id),
    hit AS (SELECT query_id, id, sum(dw.w / dl.l * qw.w / ql.l) AS s
            FROM qw JOIN ql USING (query_id) JOIN dw USING (term) JOIN dl USING (id) GROUP BY query_id, id),
    every AS (SELECT item_id AS query_id, doc_id AS id FROM benchmark, documents),
    s AS (SELECT query_id, id, round(coalesce(s, 0), 9) AS cosine FROM every LEFT JOIN hit USING (query_id, id)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, id) AS rank FROM s)
    SELECT query_id, id, rank, round((1 + cosine) / 2, 6) AS certainty FROM r WHERE rank <= 3""")
def nearest_texts(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return vectors.nearest_texts(docs, asked, 3).select(
        "query_id", "id", F.col("rank").cast("bigint").alias("rank"), F.round("certainty", 6).alias("certainty"))


@query("""SELECT vec_id AS id, CASE WHEN label = 3 THEN 100 ELSE label END AS label FROM embeddings
          UNION ALL SELECT -vec_id - 1, label FROM embeddings WHERE label = 4""")
def insert_objects(spark, sf):
    rows = table(spark, sf, "embeddings").withColumnsRenamed({"vec_id": "id", "embedding": "vector"})
    collection = fresh(spark, "objects")
    vectors.insert_objects(collection, rows, 64)
    again = rows.where("label = 3").withColumn("label", F.lit(100)).unionByName(
        rows.where("label = 4").withColumn("id", -F.col("id") - 1))
    vectors.insert_objects(collection, again, 64)
    return collection.read(columns=["id", "label"])


def _in_lists(spark, sf, probes):
    corpus = _corpus(spark, sf)
    centroids = vectors.train_centroids(corpus, 16)
    path = scratch(spark, "lists")
    files.write_parquet(vectors.assign_lists(corpus, centroids), path, partition_by=["list_id"])
    found = vectors.nearest_in_lists(spark.read.parquet(path), centroids, _label_means(spark, sf), 5, probes)
    return found.select("query_id", "id", F.col("rank").cast("bigint").alias("rank"),
                        F.round("certainty", 6).alias("certainty"))


@query()
def nearest_in_lists(spark, sf):
    """Some lists; the recall is tested."""
    return _in_lists(spark, sf, 4)


@query(_NEAREST)
def nearest_in_all_lists(spark, sf):
    return _in_lists(spark, sf, 16)
