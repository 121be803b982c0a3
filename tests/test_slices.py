import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetloom.operators import positions, slices
from assetloom.operators.slices import LayoutField, Slice, StaticDim, TimeDim

DAY = dt.timedelta(days=1)


def minutes(spark):
    """One row per minute of a day, categories A, B, C."""
    return spark.range(1440).select(
        (F.lit("2023-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("timestamp"),
        F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("id") % 3 + 1).cast("int")).alias("category"),
        F.rand(876).alias("value"))


def test_window_is_half_open(spark):
    dim = TimeDim("timestamp", dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 1, 1))
    part = slices.read_slice(minutes(spark), Slice("t", ("timestamp",), (dim,)))
    assert part.columns == ["timestamp"]
    assert part.count() == 60


def test_window_on_date_and_zoned_columns(spark):
    df = spark.sql("SELECT DATE '2024-01-01' AS d, TIMESTAMP '2024-01-01 12:00:00' AS z")
    zone = dt.timezone(dt.timedelta(hours=2))
    day = TimeDim("d", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    late = TimeDim("z", dt.datetime(2024, 1, 1, 14, tzinfo=zone), dt.datetime(2024, 1, 1, 15, tzinfo=zone))
    assert slices.read_slice(df, Slice("t", None, (day, late))).count() == 1


def test_bad_dimensions(spark):
    df = minutes(spark)
    with pytest.raises(TypeError):
        slices.slice_predicate([StaticDim("value", ("a",))], df.schema)
    with pytest.raises(TypeError):
        slices.slice_predicate([TimeDim("category", dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 2))], df.schema)
    with pytest.raises(ValueError):
        slices.slice_predicate([StaticDim("nope", ("a",))], df.schema)
    assert slices.read_slice(df, Slice("t", None, (StaticDim("category", ()),))).count() == 0


@pytest.mark.parametrize("start, end, transform", [
    (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1), "hour"),
    (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), "day"),
    (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 8), "day"),
    (dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), "month"),
    (dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1), "month"),
    (dt.datetime(2024, 1, 31), dt.datetime(2024, 2, 29), "month"),
])
def test_window_transforms(start, end, transform):
    assert slices.window_transform(start, end) == transform


def test_window_transform_refuses_others():
    with pytest.raises(ValueError):
        slices.window_transform(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 1))


def test_merge_windows():
    days = [(dt.datetime(2022, 1, d), dt.datetime(2022, 1, d + 1)) for d in (2, 1, 3)]
    assert slices.merge_windows(days) == (dt.datetime(2022, 1, 1), dt.datetime(2022, 1, 4))
    with pytest.raises(ValueError, match="consecutive"):
        slices.merge_windows([days[0], (dt.datetime(2022, 1, 5), dt.datetime(2022, 1, 6))])
    with pytest.raises(ValueError, match="length"):
        slices.merge_windows([days[0], (dt.datetime(2022, 1, 3), dt.datetime(2022, 1, 5))])
    hours = [(dt.datetime(2022, 1, 1, h), dt.datetime(2022, 1, 1, h + 1)) for h in range(3)]
    assert slices.merge_windows(hours) == (dt.datetime(2022, 1, 1), dt.datetime(2022, 1, 1, 3))


def test_layout_checks():
    schema = T.StructType().add("ts", "timestamp_ntz").add("c", "string").add("n", "integer")
    slices.check_layout((LayoutField("ts", "day"), LayoutField("c")), schema)
    with pytest.raises(TypeError):
        slices.check_layout((LayoutField("n"),), schema)
    with pytest.raises(TypeError):
        slices.check_layout((LayoutField("c", "day"),), schema)
    with pytest.raises(ValueError):
        slices.check_layout((LayoutField("gone"),), schema)
    with pytest.raises(ValueError, match="clashes"):
        slices.check_layout((LayoutField("c"),), T.StructType().add("c", "string").add("part_c", "string"))
    assert slices.partition_by("c") == ["c"]
    assert slices.partition_by({"date": "ts", "kind": "c"}) == ["ts", "c"]
    with pytest.raises(TypeError):
        slices.partition_by(3)


def test_layout_diff():
    stored = (LayoutField("ts", "day"), LayoutField("c"))
    wanted = (LayoutField("ts", "month"), LayoutField("d"))
    assert slices.layout_diff(stored, wanted) == {"new": ["d"], "updated": ["ts"], "deleted": ["c"]}


def test_key_mappings(spark):
    keys = spark.createDataFrame([("2024-01-02",), ("2024-01-03",)], "k string")
    pairs = {tuple(r) for r in slices.map_time_offset(keys, "k", "yyyy-MM-dd", -1, 0).collect()}
    assert pairs == {("2024-01-02", "2024-01-01"), ("2024-01-02", "2024-01-02"),
                     ("2024-01-03", "2024-01-02"), ("2024-01-03", "2024-01-03")}
    multi = spark.createDataFrame([("a|2024-01-01",)], "k string")
    assert slices.map_multi_to_single(multi, "k", 1).first().up_key == "2024-01-01"
    fixed = slices.map_static(keys, "k", {"2024-01-02": ["x", "y"]})
    assert sorted(r.up_key for r in fixed.collect()) == ["x", "y"]


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
def test_running_totals_with_a_hot_key(spark, ranges):
    """Two thirds of the rows share a key; the ranges must not change the result."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(None).alias("k"), "id", (F.col("id") % 5).alias("x"))
    got = positions.running_totals(df, ["k"], "id", {"upto": F.col("x")}, ranges=ranges)
    before = positions.running_totals(df, ["k"], "id", {"upto": F.col("x")}, before=True, ranges=ranges)
    sums, want, want_before = {}, {}, {}
    for i in range(3000):
        k = i % 7 if i % 3 == 0 else None
        want_before[i] = sums.get(k, 0)
        sums[k] = want[i] = sums.get(k, 0) + i % 5
    assert {r.id: r.upto for r in got.collect()} == want
    assert {r.id: r.upto for r in before.collect()} == want_before


def test_row_index(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("key"))
    rows = positions.row_index(df, "key", "i", 100).collect()
    assert all(r.i == r.key + 100 for r in rows) and len(rows) == 1000
    assert positions.row_index(df.where("key < 0"), "key").count() == 0


@pytest.mark.parametrize("dtype", ["int", "double", "decimal(12,2)", "date", "timestamp", "timestamp_ntz"])
def test_ranges_of_every_order_type(spark, dtype):
    """Half of the rows share one order value and some have none; sums per value stay those of a plain sum."""
    value = F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).cast("int")
    made = F.date_add(F.lit("2024-01-01").cast("date"), value).cast(dtype) if dtype[0] in "dt" and dtype[1] in "ai" \
        else value.cast(dtype)
    df = spark.range(400).select("id", made.alias("at")).groupBy("at").agg(F.count("*").alias("n"))
    got = positions.running_totals(df, [], "at", {"upto": F.col("n")}, ranges=9).orderBy("at").collect()
    seen = 0
    for row in got:
        seen += row.n
        assert row.upto == seen
    assert seen == 400 and len(got) == 201  # 200 odd numbers, 5 among them, and null


def test_plan_does_not_grow_with_the_ranges(spark):
    df = spark.range(20_000)
    plans = []
    for ranges in (8, 2000):
        out = positions.row_index(df, "id", ranges=ranges)
        assert out.where("id <> row_index").count() == 0
        plans.append(len(out._jdf.queryExecution().optimizedPlan().toString()))
    assert plans[1] < plans[0] + 500


def test_key_runs(spark):
    days = ["2024-02-28", "2024-02-29", "2024-03-01", "2024-03-01", None, "no day", "2024-03-04", "2024-02-31"]
    keys = spark.createDataFrame([(x,) for x in days], "k string")
    got = sorted(tuple(r) for r in slices.key_runs(keys, "k", "yyyy-MM-dd").collect())
    assert got == [("2024-02-28", "2024-03-01", 3), ("2024-03-04", "2024-03-04", 1)]
    months = spark.createDataFrame([("2023-12",), ("2024-01",), ("2024-03",)], "k string")
    got = sorted(tuple(r) for r in slices.key_runs(months, "k", "yyyy-MM", "month").collect())
    assert got == [("2023-12", "2024-01", 2), ("2024-03", "2024-03", 1)]
    assert slices.key_runs(keys.where("false"), "k", "yyyy-MM-dd").count() == 0
    with pytest.raises(ValueError, match="steps by"):
        slices.key_runs(keys, "k", "yyyy", "century")


def test_all_and_specific_keys(spark):
    down = spark.createDataFrame([("a",), ("b",)], "k string")
    up = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-02",), ("2024-01-04",)], "d string")
    assert sorted(tuple(r) for r in slices.map_all(down, "k", up, "d").collect()) == [
        ("a", "2024-01-01", "2024-01-04", 3), ("b", "2024-01-01", "2024-01-04", 3)]
    assert [tuple(r) for r in slices.map_all(down, "k", up.where("false"), "d").limit(1).collect()] == [("a", None, None, 0)]
    got = slices.map_specific(down, "k", up.where("d < '2024-01-03'"), "d", "yyyy-MM-dd")
    assert sorted(tuple(r) for r in got.collect()) == [("a", "2024-01-01", "2024-01-02", 2), ("b", "2024-01-01", "2024-01-02", 2)]
    with pytest.raises(ValueError, match="between 2024-01-02 and 2024-01-04"):
        slices.map_specific(down, "k", up, "d", "yyyy-MM-dd")
    with pytest.raises(ValueError, match="none"):
        slices.map_specific(down, "k", up.where("false"), "d", "yyyy-MM-dd")
