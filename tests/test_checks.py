import datetime as dt

import pytest
from pyspark.sql import functions as F

from assetloom.operators import contracts, curation, documents, profiles, publish, usage
from assetloom.operators.contracts import ColumnSpec, Contract, Rule
from compare import values

WANTED = Contract((ColumnSpec("foo", "string", nullable=False, unique=True, description="a key"),
                   ColumnSpec("bar", "bigint")))


def test_contract_examples(spark):
    good = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "foo string, bar long")
    bad = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3)], "foo string, bar long")
    assert contracts.require(good, WANTED) is good
    with pytest.raises(ValueError, match="unique"):
        contracts.require(bad, WANTED)
    assert contracts.require(bad, WANTED, validated=True) is bad
    assert values(contracts.violating_rows(bad, WANTED), "foo", "bar") == [("a", 1), ("a", 2)]
    assert WANTED.schema()["foo"].metadata == {"comment": "a key"}


def test_contract_finds_schema_null_and_rule_problems(spark):
    df = spark.createDataFrame([(None, 1, 1.0), ("b", 2, float("nan"))], "foo string, bar int, more double")
    rules = Contract(WANTED.columns, (Rule("small", F.col("bar") < 2, "WARN"),))
    got = {(r.check_name, r.column_name): (r.n_failed, r.passed) for r in contracts.check(df, rules).collect()}
    assert got == {("wrong_type", "bar"): (1, False), ("extra_column", "more"): (1, False),
                   ("not_null", "foo"): (1, False), ("small", ""): (1, False), ("unique", "foo"): (0, True)}


def test_empty_frame_meets_rules(spark):
    empty = spark.createDataFrame([], "foo string, bar long")
    assert all(r.passed for r in contracts.check(empty, WANTED).collect())


def test_thresholds(spark):
    facts = spark.createDataFrame([("a", 5, 0), ("b", None, None), ("c", 9, 2)], "k string, n int, bad int")
    got = values(contracts.threshold_checks(facts, "n", "bad"), "k", "n_documents", "passed")
    assert got == [("a", 5, True), ("b", 0, False), ("c", 9, False)]


def test_updates_and_freshness(spark):
    history = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("a", dt.datetime(2024, 1, 2))],
                                    "t string, ts timestamp_ntz")
    names = spark.createDataFrame([("a",), ("b",)], "t string")
    with pytest.raises(Exception, match="no update known for b"):
        contracts.last_updated(history, names, "t", "ts").collect()
    latest = contracts.last_updated(history, names, "t", "ts", strict=False)
    got = contracts.freshness(latest, dt.datetime(2024, 1, 3, 0, 1))
    assert values(got, "t", "lag_minutes", "is_late") == [("a", 1441, True), ("b", None, True)]
    assert contracts.freshness(latest, dt.datetime(2024, 1, 3)).where("t = 'a'").first().is_late is False


def test_profile_counts_nan_and_nested(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, CAST('NaN' AS DOUBLE), 'b', array(1)), (2, NULL, 'a', NULL),
                      (3, 1.0, NULL, array()) AS t(i, d, s, a)""")
    got = {r.column_name: r for r in profiles.profile(df).collect()}
    assert (got["i"].n_values, got["i"].mean, got["i"].p50) == (3, 2.0, 2.0)
    assert (got["d"].n_values, got["d"].n_nulls) == (2, 1)
    assert (got["s"].min, got["s"].max, got["s"].mean) == ("a", "b", None)
    assert (got["a"].n_values, got["a"].n_nulls, got["a"].min) == (2, 1, None)


def test_exact_quantiles_with_one_dominant_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).cast("double").alias("x"))
    assert tuple(profiles.exact_quantiles(df, "x").first())[1:] == (7.0, 7.0, 2249.0)


def test_previews(spark):
    df = spark.range(100).select("id", F.array("id").alias("a"))
    assert profiles.preview(df, "id").collect() == profiles.preview(df.repartition(7), "id").collect()
    assert 10 < profiles.preview(df, "id", None, 0.3).count() < 50
    assert profiles.preview(df, "id", None).count() == 100
    with pytest.raises(ValueError):
        profiles.preview(df, "id", 5, 0.3)


def test_fingerprint_ignores_order_only(spark):
    df = spark.range(50).select("id", F.col("id").cast("string").alias("s"))
    same = profiles.fingerprint(df.repartition(5)).first()
    assert same == profiles.fingerprint(df).first()
    assert same != profiles.fingerprint(df.withColumn("s", F.when(F.col("id") == 3, "x").otherwise(F.col("s")))).first()


def test_difference(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "i int, s string")
    right = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "s string, i int")
    assert values(profiles.difference(left, right)) == [(1, "a", 2, 1), (3, "z", 0, 1)]
    assert profiles.difference(left, left.repartition(3)).isEmpty()


def test_column_schema(spark):
    out = profiles.column_schema(spark, WANTED.schema(), {"bar": "a number"})
    assert values(out) == [(0, "foo", "string", "a key"), (1, "bar", "bigint", "a number")]


def test_curation_of_question_pairs(spark):
    rows = [(1, "What is the best way ?", "How do I do that ?", 0), (2, "What is the best way ?", "How do I do that ?", 1),
            (3, "Too short", "How do I do that ?", 1), (4, None, "How do I do that ?", 0),
            (5, "  WHAT is the best way now ", "Is this a good one ?", 1)]
    df = spark.createDataFrame(rows, "id int, question1 string, question2 string, label int")
    both = ["question1", "question2"]
    from assetloom.functions.text import normal_case

    out, steps = curation.curate(df, both, "id", 5, {c: normal_case(F.col(c)) for c in both})
    assert values(out, "id", "question1", "label") == [(1, "what is the best way ?", 0), (5, "what is the best way now", 1)]
    assert values(steps, "name", "n_rows") == [("deduplicated", 4), ("filtered", 2), ("normalised", 2), ("sampled", 5)]


def test_dedupe_with_most_rows_alike(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 10 > 2, "same").otherwise(F.col("id").cast("string")).alias("k"),
                                  "id", (F.col("id") * 2).alias("v"))
    out = curation.first_per_key(df, ["k"], "id")
    assert out.count() == 601 and out.columns == df.columns
    assert out.where("k = 'same'").first().v == 6
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_usage_counts_nulls_as_zero(spark):
    df = spark.createDataFrame([("a", 5, None, True), ("a", 7, 2, False), ("a", 1, 1, True)],
                               "asset string, input_tokens int, output_tokens int, last boolean")
    assert values(usage.usage_totals(df, ["asset"])) == [("a", 3, 13, 3)]
    assert values(usage.usage_totals(df, ["asset"], "last")) == [("a", 2, 6, 1)]


def test_assembled_reviews_are_whole(spark):
    df = spark.range(2500).select(F.lit("book").alias("k"), "id", F.concat(F.lit("r"), "id").alias("t"))
    whole = usage.assemble_text(df, ["k"], "id", "t", separator="'").collect()
    assert [r.prompt for r in whole] == ["'".join(f"r{i}" for i in range(2500))]
    out = usage.assemble_text(df, ["k"], "id", "t", max_items=1000, head="<", tail=">").orderBy("part").collect()
    assert [r.n_items for r in out] == [1000, 1000, 500]
    assert "|".join(r.prompt[1:-1] for r in out) == "|".join(f"r{i}" for i in range(2500))


def test_bulk_export(spark, root):
    df = spark.createDataFrame([("a:b/c", "x", None), ("d", "y\n", 2)], "_id string, title string, n int")
    out = documents.to_bulk(df, "idx", "_id")
    assert values(out) == [("idx", "a:b/c", '{"title":"x","n":null}'), ("idx", "d", '{"title":"y\\n","n":2}')]
    assert documents.to_bulk(df.drop("_id"), "idx", "_id").where("_id IS NULL").count() == 2
    many = documents.to_bulk(spark.range(2500).withColumn("title", F.repeat(F.lit("z"), 10)), "idx", "id")
    sizes = documents.batched(many.coalesce(1), 500, 10**6).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in sizes) == [500] * 5
    small = documents.batched(many.coalesce(1), 500, 240).groupBy("batch_id").agg(
        F.sum(F.octet_length("_source")).alias("b"), F.count("*").alias("n")).collect()
    assert max(r.b for r in small) <= 240 and sum(r.n for r in small) == 2500
    assert documents.batched(many.limit(0)).count() == 0
    documents.write_ndjson(out, f"{root}/nd")
    lines = [r.value for r in spark.read.text(f"{root}/nd").collect()]
    assert len(lines) == 4 and '{"index":{"_index":"idx","_id":"d"}}' in lines


def test_builds_swap_and_retention(spark, root):
    alias = publish.Published(spark, f"{root}/b", "docs")
    schema = spark.range(1).schema
    assert alias.read(schema).count() == 0
    with pytest.raises(FileNotFoundError):
        alias.read()
    names = [alias.publish(spark.range(n), strategy="timestamp", keep_last=2, now=dt.datetime(2024, 1, n)) for n in (1, 2, 3)]
    assert names == sorted(names) and "2024-01-01" in names[0]
    assert alias.builds() == names[1:] and alias.read().count() == 3
    old = alias.publish(spark.range(9), strategy="timestamp", keep_last=1, now=dt.datetime(2023, 1, 1))
    assert alias.builds() == [old] and alias.read().count() == 9  # the current build always stays
    alias.publish(spark.range(4), partition_key="EU|2024")
    assert alias.read(partition_key="EU|2024").count() == 4
    assert publish.build_suffix(spark, "run_id", run_id="a-b") == "a-b"
    assert publish.build_suffix(spark, "none") == publish.build_suffix(spark, "none")
    for wrong in ("partition", "other"):
        with pytest.raises(ValueError):
            publish.build_suffix(spark, wrong)


def test_retention_leaves_other_aliases_alone(spark, root):
    names = ("docs", "docs-fr", "docs_fr", "docs`x")
    for n, name in enumerate(names):
        publish.Published(spark, root, name).publish(spark.range(n + 1), strategy="run_id", run_id="1")
    publish.Published(spark, root, "docs").publish(spark.range(9), keep_last=1, strategy="run_id", run_id="2")
    assert [publish.Published(spark, root, name).read().count() for name in names] == [9, 2, 3, 4]
    assert [publish.Published(spark, root, name).builds() for name in names] == [["2"], ["1"], ["1"], ["1"]]


def test_published_dataset_card(spark, root):
    df = curation.assign_split(spark.range(200), "id", {"train": 0.5, "test": 0.3, "rest": 0.2})
    card = publish.publish_dataset(df, f"{root}/d", ["train", "test"], source="numbers", steps=["Kept all"],
                                   metadata={"task": "none"})
    stored = spark.read.parquet(f"{root}/d/data")
    assert {r.split for r in stored.select("split").distinct().collect()} == {"train", "test"}
    n = {r["split"]: r["count"] for r in stored.groupBy("split").count().collect()}
    assert f"- train: {n['train']} rows" in card and "- Kept all" in card and "- task: none" in card
    assert "\n".join(r.value for r in spark.read.text(f"{root}/d/card").collect()).startswith("# numbers")
