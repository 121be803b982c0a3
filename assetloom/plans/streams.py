"""Streaming queries: each drains what is there and gives the rows its batch form would give."""

from __future__ import annotations

from pyspark.sql import functions as F

from assetloom.operators import usage
from assetloom.operators.tables import AssetTable
from assetloom.plans.analysis import _PATTERNS, _missing_sql, _ENDS
from assetloom.plans.registry import query, table
from assetloom.plans.run_log import ACTIONS_SQL, LOG_SQL, USAGE_SQL, actions, check_specs, run_log, usage_log
from assetloom.plans.storage import DAILY, fresh
from assetloom.session import scratch
from assetloom.streaming import aggregates, files, late, runs, sinks


def _stream(spark, sf, name, max_files=None):
    """A table as a stream, stored as one file or as a folder (a glob admits both); event times get a
    zone, as watermarks need one."""
    schema = table(spark, sf, name).schema
    df = files.stream_parquet(spark, f"{sf}/{name}[.]parquet", schema, max_files)
    return df.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in df.columns else df


def _in_batches(spark, sf, name, key, n=6):
    """A table as a stream of n batches in order of a key: one stored folder after the other, one file a batch."""
    rows = table(spark, sf, name)
    bounds = rows.agg(F.percentile_approx(key, [k / n for k in range(1, n)], 1000)).first()[0] or []
    path, lower = scratch(spark, f"{name}-batches"), None
    for k, upper in enumerate([*bounds, None]):
        some = F.lit(True) if lower is None else F.col(key) > lower
        some = some if upper is None else some & (F.col(key) <= upper)
        # One file a batch; filtered by many tasks, and read by many as its row groups are small.
        rows.where(some).repartition(1).write.option("parquet.block.size", 8 << 20).parquet(f"{path}/{k}")
        lower = upper
    df = files.stream_parquet(spark, f"{path}/*", rows.schema, 1)
    return df.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in df.columns else df


def _ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _drained(spark, df, name, mode="append", **sink) -> AssetTable:
    out = fresh(spark, name)
    checkpoint = scratch(spark, f"{name}-checkpoint")
    files.drain(df, checkpoint, sinks.table_sink(out, name, **sink), mode)
    return out


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_tail(spark, sf):
    out = _drained(spark, _stream(spark, sf, "events", 1000), "tail", layout=DAILY)
    return out.read(columns=["event_id", "user_id", "event_type", "value"])


@query(_missing_sql(_ENDS, _ENDS))
def stream_missing_as_failed(spark, sf):
    """Over six batches; no run is silent for so long that a timer would report it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", runs.STATE_PROVIDER)
    failures = runs.missing_as_failed_stream(run_log(_in_batches(spark, sf, "events", "event_id")), idle="90 days")
    out = _drained(spark, failures, "failures")
    rows = out.read(allow_missing=True, schema=failures.schema).drop("message")
    return _ntz(rows, "end_ts")


@query("SELECT DISTINCT user_id, event_type, props FROM events")
def stream_dedupe(spark, sf):
    rows = _stream(spark, sf, "events").select("user_id", "event_type", "props", "ts")
    unique = sinks.dedupe_in_stream(rows, ["user_id", "event_type", "props"], "ts", "60 days")
    return _drained(spark, unique, "unique").read(columns=["user_id", "event_type", "props"])


@query(f"""WITH {ACTIONS_SQL} SELECT asset, max(start_secs) AS last_secs FROM actions a
    WHERE state <> 'RUNNING' AND (kind <> 'assertion' OR asset IN (SELECT check_name FROM specs))
      AND regexp_matches(asset, '^(?:(?:check_)|(?:table_[1-7]))') GROUP BY asset""")
def stream_high_water(spark, sf):
    specs = check_specs(actions(table(spark, sf, "events")))
    cursors, emitted = fresh(spark, "cursors"), fresh(spark, "emitted")
    sink = aggregates.high_water_sink(cursors, emitted, specs, "poll", _PATTERNS)
    files.drain(actions(_stream(spark, sf, "events")), scratch(spark, "poll-checkpoint"), sink)
    return cursors.read()


@query("""SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value
          FROM events GROUP BY user_id, event_type""")
def stream_upsert(spark, sf):
    rows = _stream(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    out = fresh(spark, "latest")
    sink = sinks.table_sink(out, "latest", "upsert", ["user_id", "event_type"], "event_id")
    files.drain(rows, scratch(spark, "latest-checkpoint"), sink)
    return out.read()


@query("""SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY
                   AS window_end, event_type, count(*) AS n_rows, round(sum(value), 2) AS total_value
          FROM events GROUP BY 1, 2, 3""")
def stream_windows(spark, sf):
    """Daily windows with late data; update mode, the last result per window is kept."""
    aggs = {"n_rows": F.count(F.lit(1)), "total_value": F.round(F.sum("value"), 2)}
    daily = aggregates.windowed(_stream(spark, sf, "events"), "ts", "1 day", ["event_type"], aggs, "1 hour")
    out = fresh(spark, "windows")
    sink = sinks.table_sink(out, "windows", "upsert", ["window_start", "event_type"])
    files.drain(daily, scratch(spark, "windows-checkpoint"), sink, "update")
    return _ntz(out.read(), "window_start", "window_end")


@query(f"""WITH {USAGE_SQL} SELECT asset, provider, count(*) AS calls, sum(input_tokens)::BIGINT AS input_tokens,
    sum(coalesce(output_tokens, 0))::BIGINT AS output_tokens FROM usage_log WHERE is_last GROUP BY 1, 2""")
def stream_usage(spark, sf):
    totals = usage.usage_totals(usage_log(_stream(spark, sf, "conversations")), ["asset", "provider"], "is_last")
    out = fresh(spark, "usage")
    sink = sinks.table_sink(out, "usage", "upsert", ["asset", "provider"])
    files.drain(totals, scratch(spark, "usage-checkpoint"), sink, "update")
    return out.read()


@query(f"""WITH {LOG_SQL},
    a AS (SELECT *, coalesce(sum((event_type IN {_ENDS})::INT) OVER (PARTITION BY run_id ORDER BY event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run_no FROM log),
    ends AS (SELECT run_id, count(*) AS n FROM log WHERE event_type IN {_ENDS} GROUP BY 1),
    b AS (SELECT *, coalesce(sum((event_type <> 'STEP_START')::INT) OVER (PARTITION BY run_id, run_no, step_key
                    ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS span_no
          FROM a WHERE event_type LIKE 'STEP%'),
    steps AS (SELECT 'step' AS kind, run_id, run_no::BIGINT AS run_no, step_key, span_no::BIGINT AS span_no,
           min(ts) FILTER (WHERE event_type = 'STEP_START') AS started,
           max(ts) FILTER (WHERE event_type <> 'STEP_START') AS finished,
           max(event_type) FILTER (WHERE event_type <> 'STEP_START') AS outcome,
           count(*) FILTER (WHERE event_type = 'STEP_START') AS n_starts
    FROM b GROUP BY ALL)
    SELECT steps.* FROM steps LEFT JOIN ends USING (run_id) WHERE outcome IS NOT NULL OR run_no < n
    UNION ALL SELECT 'run', run_id, run_no::BIGINT, NULL, NULL, min(ts) FILTER (WHERE event_type = 'RUN_START'),
           max(ts) FILTER (WHERE event_type IN {_ENDS}), max(event_type) FILTER (WHERE event_type IN {_ENDS}), NULL
    FROM a WHERE event_type = 'RUN_START' OR event_type IN {_ENDS} GROUP BY run_id, run_no
    HAVING max(event_type) FILTER (WHERE event_type IN {_ENDS}) IS NOT NULL""")
def stream_spans(spark, sf):
    """Live spans over six batches: those that have ended."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", runs.STATE_PROVIDER)
    spans = runs.span_stream(run_log(_in_batches(spark, sf, "events", "event_id")), idle="90 days")
    out = _drained(spark, spans, "spans")
    return _ntz(out.read(allow_missing=True, schema=spans.schema), "started", "finished")


@query("SELECT event_id, user_id FROM events")
def stream_late_rows(spark, sf):
    """Rows in time and late rows of six batches in an order unlike that of time: together they are all rows."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", runs.STATE_PROVIDER)
    rows = _in_batches(spark, sf, "events", "value").select("event_id", "user_id", "ts")
    kept, behind = fresh(spark, "in_time"), fresh(spark, "late")
    sink = late.late_sink(sinks.table_sink(kept, "in-time"), behind, "late")
    files.drain(late.split_late(rows, "ts", "1 day", ["event_id"]), scratch(spark, "late-checkpoint"), sink)
    parts = [t.read(allow_missing=True, schema=rows.schema) for t in (kept, behind)]
    return parts[0].unionByName(parts[1]).select("event_id", "user_id")
