"""Streams give their batch form's rows; a batch played again changes nothing."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from assetloom.operators import events as ev
from assetloom.operators.slices import LayoutField, TimeDim
from assetloom.operators.tables import AssetTable
from assetloom.streaming import aggregates, files, late, runs, sinks
from compare import values
from test_events import make_log, random_rows


@pytest.mark.parametrize("compact_at", [1000, 2])
def test_runs_in_many_batches(spark, root, compact_at, monkeypatch):
    monkeypatch.setattr(runs.PendingAssets.__init__, "__defaults__", (compact_at,))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", runs.STATE_PROVIDER)
    log = make_log(spark, random_rows(300)).withColumn("ts", F.col("ts").cast("timestamp"))
    for n in range(3):  # files in id order
        log.where(f"event_id >= {n * 100} AND event_id < {(n + 1) * 100}").coalesce(1).write.parquet(f"{root}/log/{n}")
    stream = files.stream_parquet(spark, f"{root}/log/*", log.schema, max_files=1)
    out = AssetTable(spark, root, "failures")
    files.drain(runs.missing_as_failed_stream(stream, shards=3), f"{root}/ck", sinks.table_sink(out, "q"))
    want = ev.missing_as_failed(log)
    columns = ["run_id", "asset", "end_id", "end_type"]
    assert values(out.read(), *columns) == values(want, *columns)


def test_replayed_batches_are_skipped(spark, root):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    t = AssetTable(spark, root, "t")
    write = sinks.table_sink(t, "q", "append")
    write(df, 0)
    write(df, 0)
    write(df, 1)
    assert t.read().count() == 4
    u = AssetTable(spark, root, "u")
    merge = sinks.table_sink(u, "q", "upsert", ["k"], "v")
    merge(df, 0)
    merge(spark.createDataFrame([("a", 5), ("a", 3), ("c", 1)], "k string, v int"), 1)
    merge(spark.createDataFrame([("a", 9)], "k string, v int"), 1)
    assert values(u.read()) == [("a", 5), ("b", 2), ("c", 1)]
    merge(spark.createDataFrame([("a", 4), ("c", 7)], "k string, v int"), 2)
    assert values(u.read()) == [("a", 5), ("b", 2), ("c", 7)]


@pytest.mark.parametrize("mode", ["append", "upsert"])
def test_a_batch_is_evaluated_once(spark, root, mode):
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    t = AssetTable(spark, root, "t")
    write = sinks.table_sink(t, "q", mode, ["k"], "v")
    for n in (1, 2):
        df = spark.createDataFrame([("a", n), ("b", n)], "k string, v int").mapInPandas(counted, "k string, v int")
        write(df, n)
        assert seen.value == 2 * n


@pytest.mark.parametrize("mode", ["overwrite_slice", "overwrite_partitions"])
def test_slice_sinks(spark, root, mode):
    rows = [(dt.datetime(2024, 1, 1), 1), (dt.datetime(2024, 1, 2), 2)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v int")
    day = (TimeDim("ts", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)),)
    t = AssetTable(spark, root, mode)
    write = sinks.table_sink(t, "q", mode, dims=day, layout=(LayoutField("ts", "day"),))
    write(df, 0)
    write(df.where("v = 1").withColumn("v", F.lit(10)), 1)
    assert values(t.read(), "v") == [(10,), (2,)]


def test_new_files_only(spark, root):
    spark.range(3).write.parquet(f"{root}/in/a")
    seen = []

    def each(batch, _):
        seen.append(sorted(r.name for r in batch.collect()))

    def poll():
        files.drain(files.stream_manifest(spark, f"{root}/in", "*.parquet"), f"{root}/ck", each)

    poll()
    first = [n for names in seen for n in names]
    poll()
    assert sorted(n for names in seen for n in names) == sorted(first)
    spark.range(2).coalesce(1).write.parquet(f"{root}/in/b")
    poll()
    assert len([n for names in seen for n in names]) == len(first) + 1


def test_dedupe_within_the_watermark(spark, root):
    rows = [(1, "a", dt.datetime(2024, 1, 1)), (2, "a", dt.datetime(2024, 1, 1, 0, 5)), (3, "b", dt.datetime(2024, 1, 1))]
    spark.createDataFrame(rows, "id int, k string, ts timestamp").coalesce(1).write.parquet(f"{root}/in")
    stream = files.stream_parquet(spark, f"{root}/in", spark.read.parquet(f"{root}/in").schema)
    out = AssetTable(spark, root, "unique")
    files.drain(sinks.dedupe_in_stream(stream, ["k"], "ts", "1 hour"), f"{root}/ck", sinks.table_sink(out, "q"))
    assert values(out.read(), "k") == [("a",), ("b",)]


def test_high_water_marks(spark, root):
    schema = "asset string, state string, kind string, start_secs long"
    specs = spark.createDataFrame([], "check_name string, parent_asset string")
    cursors, emitted = AssetTable(spark, root, "cursors"), AssetTable(spark, root, "emitted")
    write = aggregates.high_water_sink(cursors, emitted, specs, "q")
    first = spark.createDataFrame([("a", "SUCCEEDED", "table", 10), ("b", "RUNNING", "table", 5)], schema)
    write(first, 0)
    write(first, 0)
    write(spark.createDataFrame([("a", "SUCCEEDED", "table", 7), ("a", "FAILED", "table", 12), ("b", "SUCCEEDED", "table", 5)],
                                schema), 1)
    assert values(emitted.read(), "asset", "event", "start_secs") == [
        ("a", "materialization", 10), ("a", "observation", 12), ("b", "materialization", 5)]
    assert values(cursors.read()) == [("a", 12), ("b", 5)]


def test_windows_equal_batch(spark, root):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i)) for i in range(40)]
    spark.createDataFrame(rows, "id int, ts timestamp").coalesce(1).write.parquet(f"{root}/in")
    batch = spark.read.parquet(f"{root}/in")
    aggs = {"n": F.count(F.lit(1)), "total": F.sum("id")}
    out = AssetTable(spark, root, "w")
    daily = aggregates.windowed(files.stream_parquet(spark, f"{root}/in", batch.schema), "ts", "1 day", [], aggs, "1 hour")
    files.drain(daily, f"{root}/ck", sinks.table_sink(out, "q", "upsert", ["window_start"]), "update")
    assert values(out.read()) == values(aggregates.windowed(batch, "ts", "1 day", [], aggs, "1 hour"))


def in_files(spark, root, rows, schema, size):
    """One file after the other, each a batch of the stream."""
    for n in range(0, len(rows), size):
        spark.createDataFrame(rows[n : n + size], schema).coalesce(1).write.parquet(f"{root}/in/{n:04}")
    return files.stream_parquet(spark, f"{root}/in/*", spark.createDataFrame([], schema).schema, max_files=1)


def test_spans_in_many_batches(spark, root):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", runs.STATE_PROVIDER)
    log = make_log(spark, random_rows(360)).withColumn("ts", F.col("ts").cast("timestamp"))
    rows = [tuple(r) for r in log.orderBy("event_id").collect()]
    stream = in_files(spark, root, rows, log.schema, 60)
    out = AssetTable(spark, root, "spans")
    files.drain(runs.span_stream(stream, shards=3), f"{root}/ck", sinks.table_sink(out, "q"))
    ended = log.where(F.col("event_type").isin(*ev.RUN_ENDS)).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
    steps = ev.step_spans(log).join(ended, "run_id", "left").where("outcome IS NOT NULL OR run_no < n")
    columns = ["run_id", "run_no", "step_key", "span_no", "started", "finished", "outcome", "n_starts"]
    got = out.read()
    assert values(got.where("kind = 'step'"), *columns) == values(steps, *columns)
    columns = ["run_id", "run_no", "started", "finished", "outcome"]
    assert values(got.where("kind = 'run'"), *columns) == values(ev.run_spans(log).where("outcome IS NOT NULL"), *columns)


def test_silent_runs_are_reported(spark, root):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", runs.STATE_PROVIDER)
    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    schema = "event_id long, ts timestamp, run_id string, job_name string, event_type string, step_key string, asset string"
    rows = [(1, day(0), "silent", "j", ev.RUN_START, None, None), (2, day(0), "silent", "j", ev.STEP_START, "s", None),
            (3, day(0.1), "silent", "j", ev.PLANNED, None, "a"), (4, day(0.1), "silent", "j", ev.MATERIALIZED, None, "b"),
            (5, day(1), "live", "j", ev.RUN_START, None, None)]
    for d in range(8):  # only events that an operator uses move its time on
        rows += [(10 + 2 * d, day(1 + d), "live", "j", ev.STEP_START, "s", None),
                 (11 + 2 * d, day(1 + d), "live", "j", ev.MATERIALIZED, None, "c")]
    rows += [(30, day(9), "live", "j", ev.RUN_SUCCESS, None, None), (31, day(9), "silent", "j", ev.RUN_FAILURE, None, None)]
    stream = in_files(spark, root, rows, schema, 3)
    found = {}
    for name, df in (("spans", runs.span_stream(stream, "2 days", "1 hour")),
                     ("failures", runs.missing_as_failed_stream(stream, idle="2 days", late="1 hour", shards=2))):
        found[name] = AssetTable(spark, root, name)
        files.drain(df, f"{root}/ck-{name}", sinks.table_sink(found[name], name))
    assert values(found["failures"].read(), "run_id", "asset", "end_id", "end_type") == [("silent", "a", 3, runs.IDLE)]
    assert values(found["spans"].read(), "kind", "run_id", "step_key", "finished", "outcome", "n_starts") == [
        ("run", "live", None, day(9), "RUN_SUCCESS", None), ("run", "silent", None, None, "IDLE", None),
        ("run", "silent", None, day(9), "RUN_FAILURE", None), ("step", "live", "s", None, None, 8),
        ("step", "silent", "s", None, "IDLE", 1)]


def test_late_rows_are_kept_apart(spark, root):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", runs.STATE_PROVIDER)
    day = lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)
    rows = [(1, day(0), "a"), (2, day(5), "a"), (3, day(1), "a"), (4, day(4.5), None), (5, None, "b"), (6, day(9), "b"),
            (7, day(2), "a"), (8, day(8.5), "c"), (9, day(0), "d"), (10, day(30), "d"), (11, day(9), "d"), (12, day(29.5), "a")]
    stream = in_files(spark, root, rows, "id int, ts timestamp, _shard string", 2)
    kept, behind = AssetTable(spark, root, "kept"), AssetTable(spark, root, "late")
    sink = late.late_sink(sinks.table_sink(kept, "k"), behind, "l")
    files.drain(late.split_late(stream.withColumnRenamed("_shard", "k"), "ts", "1 day"), f"{root}/ck", sink)
    # The watermark of a batch comes from the batches before it.
    assert values(behind.read(), "id") == [(11,), (3,), (7,), (9,)]
    assert values(kept.read(), "id") == [(1,), (10,), (12,), (2,), (4,), (5,), (6,), (8,)]
    assert values(kept.read().where("id = 8"), "ts", "k") == [(day(8.5), "c")]
    assert sum(r.appended_rows or 0 for r in behind.history().collect()) == 4


class CountingHandle:
    """A state store of one key that counts the calls."""

    def __init__(self):
        self.calls, self.value, self.timers = 0, None, set()

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def registerTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.calls += 1
        self.timers.remove(at)

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return max(self.timers, default=0) + 1

    getExpiryTimeInMs = getCurrentWatermarkInMs  # noqa: N815


@pytest.mark.parametrize("kind", ["failures", "spans"])
def test_state_calls_do_not_grow_with_the_runs(kind):
    """A batch reads and writes the state of all runs of a bucket at once; null runs, assets and steps are keys too."""
    at = pd.Timestamp("2024-01-01")
    processor = runs.PendingAssets(ev.RUN_ENDS, ev.RUN_ENDS, 1000) if kind == "failures" else runs.RunSpans(1000)
    handle = CountingHandle()
    processor.init(handle)
    begin, name = (ev.PLANNED, "asset") if kind == "failures" else (ev.STEP_START, "step_key")
    names = [None, *[f"r{n}" for n in range(300)]]
    first = [(r, 10 * n + k, at, x, begin, 0) for n, r in enumerate(names) for k, x in ((1, "a"), (2, None), (2, None))]
    last = [(r, 10 * n + 5, at, None, ev.RUN_FAILURE, 0) for n, r in enumerate(names[:101])]
    found = []
    for rows in (first, first, last):
        frame = pd.DataFrame(rows, columns=["run_id", "event_id", "ts", name, "event_type", "shard"])
        found.append(pd.concat(processor.handleInputRows((0,), iter([frame[:7], frame[7:]]), handle), ignore_index=True)
                     if rows is last else [*processor.handleInputRows((0,), iter([frame]), handle)])
    assert handle.calls < 15 and not found[0] and not found[1]
    ended = found[2] if kind == "failures" else found[2][found[2]["kind"] == "step"]
    key = lambda f: sorted(((r, x) for r, x in zip(f["run_id"], f[name])), key=repr)
    plain = lambda pairs: sorted(((None if pd.isna(r) else r, None if pd.isna(x) else x) for r, x in pairs), key=repr)
    assert plain(key(ended)) == plain((r, x) for r in names[:101] for x in ("a", None))
    silent = pd.concat(processor.handleExpiredTimer((0,), handle, handle))
    assert plain(key(silent)) == plain((r, x) for r in names[101:] for x in ("a", None))
    assert handle.value is None
