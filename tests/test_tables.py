import datetime as dt
import decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assetloom.operators import schemas, upsert as ups
from assetloom.operators.slices import LayoutField, Slice, StaticDim, TimeDim
from assetloom.operators.tables import AssetTable
from assetloom.operators.upsert import UpsertOptions
from assetloom.session import scratch
from compare import values
from test_slices import minutes

HOUR = (TimeDim("timestamp", dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 1, 1)),)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_hour_slice_append_and_overwrite(spark, root):
    hour = minutes(spark).where("timestamp < '2023-01-01 01:00:00'")
    t = AssetTable(spark, root, "hours")
    t.append(hour, layout=(LayoutField("timestamp", "hour"),))
    t.append(hour)
    assert t.read().count() == 120
    t.overwrite_slice(hour, HOUR)
    assert t.read().count() == 60
    t.overwrite_slice(hour, HOUR)
    assert t.read().count() == 60
    assert t.layout() == (LayoutField("timestamp", "hour"),)


def test_layout_comes_from_the_first_slice(spark, root):
    t = AssetTable(spark, root, "t")
    t.overwrite_slice(minutes(spark), [*HOUR, StaticDim("category", ("A",))])
    assert [f.name for f in t.layout()] == ["part_timestamp", "part_category"]
    assert t.read(dims=[StaticDim("category", ("A",)), *HOUR]).count() == 20


def test_slice_of_an_unpartitioned_table(spark, root):
    t = AssetTable(spark, root, "t")
    t.overwrite(minutes(spark))
    t.overwrite_slice(minutes(spark).where("timestamp < '2023-01-01 00:30:00'"), HOUR)
    assert t.read().count() == 1440 - 30
    assert t.layout() == ()


def test_unaligned_slice_keeps_its_neighbours(spark, root):
    t = AssetTable(spark, root, "t")
    t.overwrite(minutes(spark), layout=(LayoutField("timestamp", "hour"),))
    odd = [TimeDim("timestamp", dt.datetime(2023, 1, 1, 0, 30), dt.datetime(2023, 1, 1, 2, 15))]
    t.overwrite_slice(minutes(spark).limit(0), odd)
    assert t.read().count() == 1440 - 105
    last = t.last_version()
    assert (last.appended_rows, last.total_rows) == (75, 1440 - 105)


def test_reject_rows_outside(spark, root):
    t = AssetTable(spark, root, "t")
    with pytest.raises(ValueError, match="outside"):
        t.overwrite_slice(minutes(spark), HOUR, reject_outside=True)


def test_missing_partition_column(spark, root):
    t = AssetTable(spark, root, "t")
    with pytest.raises(ValueError, match="not in the data"):
        t.append(minutes(spark).drop("timestamp"), layout=(LayoutField("timestamp", "hour"),))


def test_upsert_examples(spark, root):
    t = AssetTable(spark, root, "u")
    t.overwrite(frame(spark, [("a", 1), ("b", 2)], "col1 string, col2 long"))
    t.upsert(frame(spark, [("a", 10), ("c", 3)], "col1 string, col2 long"), UpsertOptions(("col1",)))
    assert values(t.read()) == [("a", 10), ("b", 2), ("c", 3)]
    n = AssetTable(spark, root, "n")
    n.overwrite(frame(spark, [(1, 4), (2, 5), (3, 6), (4, 7)], "a long, b long"))
    n.upsert(frame(spark, [(4, 1), (8, 2), (12, 3), (16, 5)], "b long, a long"), UpsertOptions(("a",)))
    assert values(n.read()) == [(1, 4), (2, 8), (3, 12), (4, 7), (5, 16)]
    with pytest.raises(ValueError, match="join columns"):
        n.upsert(n.read(), UpsertOptions())
    with pytest.raises(ValueError, match="several rows"):
        n.upsert(frame(spark, [(1, 1), (1, 2)], "a long, b long"), UpsertOptions(("a",)))


def test_upsert_moves_a_row_between_partitions(spark, root):
    t = AssetTable(spark, root, "m")
    t.overwrite(frame(spark, [(1, "x"), (2, "x"), (3, "y")], "id int, p string"), layout=(LayoutField("p"),))
    t.upsert(frame(spark, [(1, "y"), (9, "z")], "id int, p string"), UpsertOptions(("id",)))
    assert values(t.read()) == [(1, "y"), (2, "x"), (3, "y"), (9, "z")]
    assert t.last_version().appended_rows == 3  # the untouched partition y is not rewritten


ROWS = st.dictionaries(st.one_of(st.none(), st.integers(0, 8)), st.integers(0, 99), max_size=9)


@settings(max_examples=12, deadline=None)
@given(ROWS, ROWS, st.booleans(), st.booleans())
def test_upsert_equals_a_dict(spark, old, new, update, insert):
    schema = "k int, v int"
    got = ups.upsert(frame(spark, list(old.items()), schema), frame(spark, list(new.items()), schema), ["k"],
                     update, insert)
    want = [(k, new[k] if update and k is not None and k in new else v) for k, v in old.items()]
    if insert:
        want += [(k, v) for k, v in new.items() if k is None or k not in old]
    assert values(got) == sorted(want, key=repr)


def test_upsert_null_safe(spark):
    old, new = frame(spark, [(None, 1), (2, 2)], "k int, v int"), frame(spark, [(None, 9), (3, 3)], "k int, v int")
    assert values(ups.upsert(old, new, ["k"], null_safe=True)) == sorted([(None, 9), (2, 2), (3, 3)], key=repr)


def test_outcomes(spark):
    old = frame(spark, [(1, "a"), (2, None)], "k int, v string")
    new = frame(spark, [(1, "b"), (2, None), (3, "c"), (4, "bad")], "k int, v string")
    rows = ups.outcomes(old, new, ["k"], reject=F.col("v") == "bad")
    assert values(rows, "k", "outcome") == [(1, "updated"), (2, "unchanged"), (3, "inserted"), (4, "rejected")]
    counts = {r.result_type: r.n for r in ups.outcome_counts(rows).groupBy("result_type").agg(
        F.sum("n_rows").alias("n")).collect()}
    assert counts == {"successful": 3, "failed": 1}


def test_stored_outcomes(spark, root):
    old = frame(spark, [(1, "a"), (2, None)], "k int, v string")
    new = frame(spark, [(1, "b"), (2, None), (3, "c"), (4, "bad")], "k int, v string")
    rows = ups.outcomes(old, new, ["k"], insert=False, reject=F.col("v") == "bad")
    for _ in range(2):  # a job that runs again replaces its own files only
        stored = ups.store_outcomes(rows, f"{root}/log", "a/1", {"batch": F.lit(7)})
        other = ups.store_outcomes(rows.where("k < 3"), f"{root}/log", "b", {"batch": F.lit(8)})
    assert values(stored, "job_id", "batch", "k", "v", "result_type") == sorted([
        ("a/1", 7, 1, "b", "successful"), ("a/1", 7, 2, None, "successful"), ("a/1", 7, 3, "c", "unprocessed"),
        ("a/1", 7, 4, "bad", "failed")], key=repr)
    assert values(ups.outcome_counters(stored.unionByName(other))) == [("a/1", 2, 1, 1), ("b", 2, 0, 0)]
    assert ups.store_outcomes(rows.where("false"), f"{root}/log", "empty").count() == 0
    with pytest.raises(ValueError, match="clash"):
        ups.store_outcomes(rows, f"{root}/log", "c", {"v": F.lit(1)})


def test_versions_and_schema_overwrite(spark, root):
    t = AssetTable(spark, root, "v")
    t.append(frame(spark, [(1,), (2,), (3,)], "a long"))
    t.append(frame(spark, [(1,), (2,), (3,)], "a long"))
    assert values(t.history(), "version", "appended_rows", "total_rows") == [(0, 3, 3), (1, 3, 6)]
    t.overwrite(frame(spark, [("x",)], "b string"), schema_mode="overwrite")
    assert t.read().columns == ["b"]
    assert t.read(version=0).count() == 3 and t.read(version="1").count() == 6
    pinned = AssetTable(spark, root, "v", version=0)
    assert pinned.read().count() == 3
    with pytest.warns(UserWarning):
        assert pinned.read(version=1).count() == 6
    with pytest.raises(ValueError, match="no version"):
        t.read(version=7)


def test_schema_modes(spark, root):
    t = AssetTable(spark, root, "s")
    t.append(frame(spark, [(1, "x")], "a long, b string"))
    with pytest.raises(ValueError, match="schema changed"):
        t.append(frame(spark, [(2, 1.0)], "a long, c double"))
    with pytest.raises(ValueError, match="type changed"):
        t.append(frame(spark, [("2", "x")], "a string, b string"), schema_mode="update")
    t.append(frame(spark, [(2, 1.0)], "a long, c double"), schema_mode="update")
    assert values(t.read(), "a", "c") == [(1, None), (2, 1.0)] and t.read().columns == ["a", "c"]
    t.append(frame(spark, [(3, 2.0, "new")], "a long, c double, b string"), schema_mode="update")
    assert values(t.read(), "a", "b") == [(1, None), (2, None), (3, "new")]  # the dropped values stay gone
    assert values(t.read(version=0)) == [(1, "x")]
    diff = schemas.schema_diff(t.read(version=0).schema, t.read().schema)
    assert (diff.added, diff.removed, diff.retyped) == (("c",), (), ())


def test_relayout_down_to_none(spark, root):
    t = AssetTable(spark, root, "r")
    t.overwrite(minutes(spark), layout=(LayoutField("timestamp", "hour"), LayoutField("category")))
    with pytest.raises(ValueError, match="layout changed"):
        t.append(minutes(spark), layout=(LayoutField("timestamp", "day"),))
    t.append(minutes(spark), layout=(LayoutField("timestamp", "day"),), layout_mode="update")
    assert t.layout() == (LayoutField("timestamp", "day"),) and t.read().count() == 2880
    t.relayout(())
    assert t.layout() == () and t.read().count() == 2880
    assert t.read(version=0).count() == 1440


def test_create_if_absent(spark, root):
    t = AssetTable(spark, root, "c")
    assert t.create(minutes(spark).schema, (LayoutField("category"),), properties={"owner": "me"}) == 0
    assert t.create(spark.range(1).schema) == 0
    assert t.read().count() == 0 and t.layout() == (LayoutField("category"),)
    t.upsert(minutes(spark), UpsertOptions(("timestamp",)))
    t.append(minutes(spark))
    assert t.read(dims=[StaticDim("category", ("A",))]).count() == 960
    assert t.history().where("version = 0").first().properties == {"owner": "me"}
    with pytest.raises(TypeError):
        AssetTable(spark, root, "d").create(minutes(spark).schema, (LayoutField("value"),))


def test_missing_and_empty(spark, root):
    t = AssetTable(spark, root, "e")
    with pytest.raises(FileNotFoundError):
        t.read()
    schema = minutes(spark).schema
    assert t.read(allow_missing=True, schema=schema).count() == 0
    t.append(None, run_id="r", partition_key="k")
    t.append(minutes(spark).limit(0))
    assert values(t.history(), "version", "missing") == [(0, True), (1, True)]
    assert t.read(allow_missing=True).columns == schema.fieldNames()
    t.append(minutes(spark))
    assert t.read().count() == 1440


def test_overwritten_partitions_with_null_and_odd_keys(spark, root):
    t = AssetTable(spark, root, "p")
    rows = [("a b/c=d", 1), (None, 2), ("é'\"", 3)]
    t.overwrite(frame(spark, rows, "k string, v int"), layout=(LayoutField("k"),))
    t.overwrite_partitions(frame(spark, [(None, 20), ("é'\"", 30)], "k string, v int"))
    assert values(t.read()) == sorted([("a b/c=d", 1), (None, 20), ("é'\"", 30)], key=repr)


def test_mixed_types_round_trip(spark, root):
    schema = ("l long, d double, s string, a array<long>, st struct<a:long>, t timestamp_ntz, dt date, "
              "de decimal(38,9), m map<bigint,decimal(10,2)>, b binary, by byte, sh short, f float, bo boolean, "
              "z timestamp, iv interval day to second")
    row = (1, float("nan"), "x", [1, None], (5,), dt.datetime(2024, 1, 1), dt.date(2024, 1, 2), decimal.Decimal("1.5"),
           {1: decimal.Decimal("2.25")}, bytearray(b"\x00\x01"), 1, 2, 0.5, True, dt.datetime(2024, 1, 1, 12),
           dt.timedelta(days=1, seconds=2))
    empty = (2, 1.0, "", [], (None,), None, None, None, {}, bytearray(b""), None, None, None, None, None, None)
    t = AssetTable(spark, root, "mixed")
    df = frame(spark, [row, empty, (None,) * 16], schema)
    t.overwrite(df)
    back = t.read()
    assert [f.dataType for f in back.schema] == [f.dataType for f in df.schema]
    assert repr(back.orderBy("l").collect()) == repr(df.orderBy("l").collect())


def test_many_commits_read_as_a_model(spark):
    """Random appends, slice and partition overwrites against a list of rows."""
    import random

    rng = random.Random(5)
    t = AssetTable(spark, scratch(spark, "model"), "model")
    layout, model = (LayoutField("p"),), []
    for step in range(10):
        rows = [(rng.choice("abcd"), step * 100 + i) for i in range(rng.randint(1, 6))]
        df = frame(spark, rows, "p string, v int")
        action = rng.choice(["append", "partitions", "slice"])
        if action == "append" or step == 0:
            t.append(df, layout=layout if step == 0 else None)
        elif action == "partitions":
            gone = {p for p, _ in rows}
            t.overwrite_partitions(df)
            model = [r for r in model if r[0] not in gone]
        else:
            keys = tuple(rng.sample("abcd", 2))
            t.overwrite_slice(df, [StaticDim("p", keys)])
            model = [r for r in model if r[0] not in keys]
        model += rows
        assert t.last_version().total_rows == len(model)
    assert values(t.read()) == sorted(model, key=repr)


def test_filter_does_not_grow_with_commits(spark):
    import json
    import random

    from pyspark.sql import Row

    from assetloom.operators.tables import _live_predicate

    rng = random.Random(2)
    commits, model = [], set()
    for v in range(1500):
        key, day = f"p{rng.randrange(30)}", rng.randrange(1, 28)
        spec = [{"columns": ["part_k"], "in": [[key]]}, {"columns": ["part_d"], "between": [f"{day:02}", f"{day + 1:02}"]}][v % 2]
        hit = (lambda r: r[1] == key) if v % 2 == 0 else (lambda r: f"{day:02}" <= r[2] <= f"{day + 1:02}")
        model = {r for r in model if not hit(r)} | {(v, key, f"{day:02}")}
        commits.append(Row(version=v, missing=False, generation=0, replaced_json=json.dumps("all" if v == 0 else spec)))
    rows = frame(spark, sorted({(r.version, f"p{k}", f"{d:02}") for r in commits[-40:] for k in range(30) for d in (1, 9)}
                               | model), "_v int, part_k string, part_d string")
    cond = _live_predicate(commits)
    kept = {tuple(r) for r in rows.where(cond).collect()}
    assert model <= kept
    assert len(str(rows.where(cond)._jdf.queryExecution().optimizedPlan().toString())) < 60_000


def test_empty_null_and_marked_keys_stay_apart(spark, root):
    t = AssetTable(spark, root, "keys")
    rows = [("", 1), (None, 2), ("\x02", 3), ("a", 4)]
    t.overwrite(frame(spark, rows, "k string, v int"), layout=(LayoutField("k"),))
    assert values(t.read(dims=[StaticDim("k", ("",))])) == [("", 1)]
    t.overwrite_slice(frame(spark, [("", 10)], "k string, v int"), [StaticDim("k", ("",))])
    t.overwrite_partitions(frame(spark, [("\x02", 30)], "k string, v int"))
    assert values(t.read()) == sorted([("", 10), (None, 2), ("\x02", 30), ("a", 4)], key=repr)


def test_slice_read_prunes_files_and_columns(spark, root):
    t = AssetTable(spark, root, "plan")
    t.overwrite(minutes(spark), layout=(LayoutField("timestamp", "hour"),))
    t.overwrite_slice(minutes(spark).where("timestamp < '2023-01-01 01:00:00'"), HOUR)
    part = t.read_slice(Slice("plan", ("value",), HOUR))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "part_timestamp" in plan.split("PartitionFilters")[1]
    assert "ReadSchema: struct<timestamp:timestamp_ntz,value:double>" in plan
    assert "Exchange" not in plan
    assert len(part.inputFiles()) >= 1
    files = {r[0] for r in part.select("value", F.input_file_name()).select("input_file_name()").distinct().collect()}
    assert all("_v=1" in f and "2023-01-01-00" in f for f in files)


def test_failed_commit_leaves_no_rows(spark, root):
    t = AssetTable(spark, root, "f")
    t.append(frame(spark, [(1,)], "a int"))
    broken = frame(spark, [(2,), (3,)], "a int").select(
        F.when(F.col("a") == 3, F.raise_error(F.lit("boom")).cast("int")).otherwise(F.col("a")).alias("a"))
    with pytest.raises(Exception, match="boom"):
        t.append(broken)
    assert values(t.read()) == [(1,)]
    t.append(frame(spark, [(4,)], "a int"))
    assert values(t.read()) == [(1,), (4,)]
