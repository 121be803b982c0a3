"""Event-log reduction against a step-by-step model of a log."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from assetloom.operators import events as ev
from assetloom.operators import graph, states
from compare import values

SCHEMA = ("event_id long, ts timestamp_ntz, run_id string, job_name string, event_type string, step_key string,"
          " asset string, partition_key string")


def make_log(spark, rows):
    start = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(i, start + dt.timedelta(minutes=i), run, f"job_{run}", kind, step, asset, key)
         for i, (run, kind, step, asset, key) in enumerate(rows)], SCHEMA)


def random_rows(n=400, seed=3):
    rng = random.Random(seed)
    kinds = ([ev.PLANNED] * 5 + [ev.MATERIALIZED] * 3 + [ev.ASSET_FAILED] + [ev.STEP_START] * 3 + [ev.STEP_SUCCESS] * 2
             + [ev.STEP_FAILURE, ev.RUN_START, *ev.RUN_ENDS])
    # Most events belong to one run.
    return [(rng.choice(["hot"] * 6 + ["a", "b"]), rng.choice(kinds), rng.choice("xyz"), rng.choice("pqrs"), None)
            for _ in range(n)]


@pytest.mark.parametrize("ranges", [1, 5])
@pytest.mark.parametrize("closing, failing", [
    (ev.RUN_ENDS, ev.RUN_ENDS),
    ((ev.RUN_FAILURE, ev.STEP_FAILURE, ev.RUN_SUCCESS, ev.RUN_CANCELED), (ev.RUN_FAILURE, ev.STEP_FAILURE)),
])
def test_missing_as_failed(spark, closing, failing, ranges):
    rows, want, planned = random_rows(), [], {}
    for i, (run, kind, _, asset, _) in enumerate(rows):
        if kind == ev.PLANNED:
            planned.setdefault(run, set()).add(asset)
        elif kind in (ev.MATERIALIZED, ev.ASSET_FAILED):
            planned.setdefault(run, set()).discard(asset)
        elif kind in closing:
            gone = planned.pop(run, set())
            want += [(run, a, i, kind) for a in gone] if kind in failing else []
    got = ev.missing_as_failed(make_log(spark, rows), closing, failing, ranges)
    assert want and values(got, "run_id", "asset", "end_id", "end_type") == sorted(want, key=repr)


def test_step_spans(spark):
    rows, open_steps, spans = random_rows(seed=8), {}, []
    start = dt.datetime(2024, 1, 1)
    for i, (run, kind, step, _, _) in enumerate(rows):
        ts = start + dt.timedelta(minutes=i)
        if kind == ev.STEP_START:
            open_steps.setdefault((run, step), [ts, 0])[1] += 1
        elif kind in (ev.STEP_SUCCESS, ev.STEP_FAILURE):
            first, n = open_steps.pop((run, step), [None, 0])
            spans.append((run, step, first, ts, kind, n))
        elif kind in ev.RUN_ENDS:
            for key in [k for k in open_steps if k[0] == run]:
                first, n = open_steps.pop(key)
                spans.append((*key, first, None, None, n))
    spans += [(*k, first, None, None, n) for k, (first, n) in open_steps.items()]
    got = values(ev.step_spans(make_log(spark, rows), 4), "run_id", "step_key", "started", "finished", "outcome", "n_starts")
    assert got == sorted(spans, key=repr)


def test_open_runs(spark):
    rows = [("a", ev.RUN_START, None, None, None), ("b", ev.RUN_START, None, None, None),
            ("a", ev.RUN_SUCCESS, None, None, None), ("c", ev.RUN_START, None, None, None),
            ("b", ev.STEP_START, "s", None, None)]
    log = make_log(spark, rows)
    assert values(ev.open_runs(log), "run_id", "state") == [("b", ev.STEP_START), ("c", ev.RUN_START)]
    assert values(ev.open_runs(log, keep=1), "run_id") == [("b",)]


def test_lineage_events(spark):
    rows = [("r", ev.RUN_START, None, None, None), ("r", ev.STEP_START, "s", None, None),
            ("r", ev.PLANNED, None, "x/y", None), ("r", ev.MATERIALIZED, None, "x/y", "2024-03-01"),
            ("r", ev.OBSERVED, None, "x/y", "2024-03-01"), ("r", ev.RUN_CANCELED, None, None, None),
            ("r", "SOMETHING_ELSE", None, None, None)]
    out = ev.lineage_events(make_log(spark, rows), "ns").orderBy("event_id")
    got = [(r.event_class, r.event_type, r.run_id, r.parent_run_id, r.job_name, r.dataset_name) for r in out.collect()]
    assert got == [
        ("RunEvent", "START", "r", None, "job_r", None), ("RunEvent", "START", "r.s", "r", "job_r.s", None),
        ("RunEvent", "START", "r", None, "x/y", "x/y"), ("RunEvent", "COMPLETE", "r", None, "x/y", "x/y"),
        ("DatasetEvent", None, None, None, None, "x/y"), ("RunEvent", "ABORT", "r", None, "job_r", None)]
    windows = [(r.nominal_start, r.nominal_end) for r in out.collect()]
    assert windows[3] == (dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2)) and windows[4] == (None, None)
    docs = [json.loads(r.event) for r in ev.lineage_json(out).orderBy("event_id").collect()]
    assert docs[3]["run"]["runId"] == "r" and docs[3]["dataset"] == {"namespace": "ns", "name": "x/y"}
    assert "run" not in docs[4] and "Exchange" not in out.limit(3).drop("x")._jdf.queryExecution().optimizedPlan().toString()


def test_check_runs_standalone_rule(spark):
    rows = [("solo", ev.CHECK_PLANNED, None, "a", None), ("solo", ev.CHECKED, None, "a", None),
            ("both", ev.PLANNED, None, "b", None), ("both", ev.CHECK_PLANNED, None, "b", None),
            ("both", ev.CHECKED, None, "b", None)]
    got = values(ev.check_runs(make_log(spark, rows)), "event_id", "job_name", "event_type")
    assert got == [(0, "a__checks", "START"), (1, "a__checks", "COMPLETE"), (4, "b__checks", "COMPLETE")]


@pytest.mark.parametrize("passed, severity, strict, success", [
    (True, "ERROR", False, True), (True, "WARN", False, True), (True, "WARN", True, False),
    (True, "ERROR", True, True), (False, "WARN", False, False), (False, "ERROR", True, False)])
def test_assertions(spark, passed, severity, strict, success):
    df = spark.createDataFrame([("c", passed, severity, {"column": "x"})],
                               "check_name string, passed boolean, severity string, metadata map<string,string>")
    row = ev.assertions(df, strict).first()
    assert (row.success, row.checked_column) == (success, "x")


def test_workflow_actions(spark):
    actions = spark.createDataFrame([
        ("t1", "SUCCEEDED", "table", 100), ("t1", "FAILED", "table", 200), ("t1", "RUNNING", "table", 300),
        ("t2", "SUCCEEDED", "table", 50), ("c1", "FAILED", "assertion", 70), ("c2", "SUCCEEDED", "assertion", 70),
        ("other", "SUCCEEDED", "table", 10)], "asset string, state string, kind string, start_secs long")
    cursors = spark.createDataFrame([("t2", 50), ("t1", 100)], "asset string, last_secs long")
    specs = spark.createDataFrame([("c1", "t1")], "check_name string, parent_asset string")
    out = ev.reduce_actions(actions, cursors, specs, ["t", "c"])
    assert values(out, "asset", "event", "passed", "alert_key") == sorted([
        ("t1", "observation", None, "invocation-failure-t1-200"), ("c1", "check", False, "check-failure-c1-70"),
        ("c2", "unmatched_check", None, None)], key=repr)
    assert values(ev.advance_cursors(cursors, out)) == [("c1", 70), ("t1", 200), ("t2", 50)]


def test_builds_and_alerts(spark):
    builds = spark.createDataFrame([("b1", "main", None, 1), ("b2", "main", "", 2), ("b3", "main", "dev", 3),
                                    ("b4", "test", None, 4)], "name string, branch string, prefix string, created int")
    assert ev.latest_build(builds, "main").first().name == "b2"
    alerts = spark.createDataFrame([(1, "FAILURE", "etl_a"), (2, "SUCCESS", "etl_a"), (3, "FAILURE", "tmp_a")],
                                   "event_id long, status string, job string")
    assert values(ev.alert_feed(alerts, "job", exclude=["tmp*"]), "alert_key") == [("failure-etl_a-1",)]


def test_closure_survives_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")],
                                  "node string, depends_on string")
    seeds = spark.createDataFrame([("a",)], "node string")
    assert values(graph.closure(edges, seeds, "node", "depends_on")) == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]
    both = graph.with_dependencies(edges, spark.createDataFrame([("d",)], "n string"), True, True)
    assert values(both, "node", "reached") == sorted([
        ("d", "selected"), ("c", "dependent"), ("b", "dependent"), ("a", "dependent")])
    nodes = spark.createDataFrame([("a", ["t"]), ("b", []), ("c", None)], "node string, tags array<string>")
    assert values(graph.select_targets(nodes, ["b"], ["t"])) == [("a",), ("b",)]
    assert graph.select_targets(nodes).count() == 3


def test_hidden_nodes_are_passed_through(spark):
    edges = spark.createDataFrame([("p", "h1"), ("h1", "h2"), ("h2", "raw"), ("p", "src"), ("h1", "src2")],
                                  "node string, depends_on string")
    hidden = spark.createDataFrame([("h1",), ("h2",)], "node string")
    assert values(graph.pass_through_hidden(edges, hidden)) == [("p", "raw"), ("p", "src"), ("p", "src2")]


def test_state_comparison(spark):
    now = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), ("d", 4, "n")], "k string, n int, v string")
    was = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")], "k string, n int, v string")
    assert values(states.compare_state(now, was, ["k"]), "k", "change") == [
        ("b", "changed"), ("c", "removed"), ("d", "added")]


def test_column_lineage_drops_dependencies_without_column(spark):
    df = spark.sql("""SELECT 'out' AS asset, map('c', array(named_struct('asset', 'up', 'column', 'x'),
                      named_struct('asset', 'up', 'column', CAST(NULL AS STRING)))) AS deps""")
    assert values(ev.column_lineage(df, "asset", "deps", "ns")) == [("out", "c", "ns", "up", "x")]
