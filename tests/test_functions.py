import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assetloom.functions import names, text
from assetloom.functions.display import display_value

TEXTS = ["  a b\tc ", "", " ", "x y z", "Ünï çode", "one\ntwo", "a--b/c", "ÀÉ 12", "　wide　", None]


def test_text_functions_follow_python(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    c = F.col("t")
    rows = df.select("t", text.word_count(c).alias("w"), text.strip(c).alias("s"), text.normal_case(c).alias("n"),
                     text.one_line(c).alias("o"), text.slug(c).alias("g")).collect()
    for r in rows:
        if r.t is None:
            assert (r.w, r.s, r.n, r.o, r.g) == (None,) * 5
            continue
        assert r.w == len(r.t.split())
        assert r.s == r.t.strip()
        assert r.n == r.t.strip().lower()
        assert r.o == r.t.strip().replace("\n", " ")
        assert r.g == "".join(ch if ch.isalnum() else "-" for ch in r.t.lower()).strip("-")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_word_count_on_any_text(spark, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", text.word_count(F.col("t")).alias("w"), text.strip(F.col("t")).alias("s")).collect()
    for r in got:
        assert r.w == len(r.t.split())
        assert r.s == r.t.strip()


def test_words_and_nulls(spark):
    df = spark.createDataFrame([("a b c d e", "f g h i j"), ("a b", "f g h i j"), (None, "f g h i j")], "x string, y string")
    assert df.where(text.has_words(5, F.col("x"), F.col("y"))).count() == 1


def test_typed_keys(spark):
    df = spark.createDataFrame([("config:qqp",), ("date:2025-01-01T00:00",)], "k string")
    got = [tuple(r.p) for r in df.select(text.parse_typed_key(F.col("k")).alias("p")).collect()]
    assert got == [("config", "qqp"), ("date", "2025-01-01T00:00")]
    bad = spark.createDataFrame([("plain",)], "k string").select(text.parse_typed_key(F.col("k")).alias("p"))
    with pytest.raises(Exception, match="partition key is not"):
        bad.collect()


def test_nominal_windows(spark):
    cases = {
        "2026-04-23": (dt.datetime(2026, 4, 23), dt.datetime(2026, 4, 24)),
        "2026-04-23-07:30": (dt.datetime(2026, 4, 23, 7), dt.datetime(2026, 4, 23, 8)),
        "2026-04-23T07:30": (dt.datetime(2026, 4, 23, 7), dt.datetime(2026, 4, 23, 8)),
        "2026-04-23T07:30:15": (dt.datetime(2026, 4, 23, 7), dt.datetime(2026, 4, 23, 8)),
        "us-east-1": None, "2026-04-23|c": None, "2026": None, "20260423": None, "2026-02-30": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "k string")
    for r in df.select("k", names.nominal_window(F.col("k")).alias("w")).collect():
        assert (None if r.w is None else tuple(r.w)) == cases[r.k], r.k


def test_name_patterns(spark):
    df = spark.createDataFrame([("raw_orders",), ("raw.orders",), ("stg_orders",), ("tmp[1]",)], "n string")

    def hits(cond):
        return sorted(r.n for r in df.where(cond).collect())

    n = F.col("n")
    assert hits(names.name_filter(n)) == ["raw.orders", "raw_orders", "stg_orders", "tmp[1]"]
    assert hits(names.name_filter(n, ["raw*"], ["*.*"])) == ["raw_orders"]
    assert hits(names.name_filter(n, ["raw?orders"])) == ["raw.orders", "raw_orders"]
    assert hits(names.name_filter(n, ["[rs]*"])) == ["raw.orders", "raw_orders", "stg_orders"]
    assert hits(names.name_filter(n, ["[!rs]*"])) == ["tmp[1]"]
    assert hits(names.starts_with_regex(n, ["stg", "raw_"])) == ["raw_orders", "stg_orders"]
    assert re.match(names.glob_regex("a.b"), "a.b") and not re.match(names.glob_regex("a.b"), "axb")


def test_namespaces(spark):
    df = spark.createDataFrame([({"team": "x"},), ({},), (None,)], "tags map<string,string>")

    def resolved(template):
        return [r[0] for r in df.select(names.namespace_of(template, "ns", F.col("tags"))).collect()]

    assert resolved("{namespace}/{tag:team}") == ["ns/x", "ns", "ns"]
    assert resolved("/a//{tag:team}//b/") == ["a/x/b", "a/b", "a/b"]
    assert resolved("{tag:team}") == ["x", "ns", "ns"]
    for bad in ("{tag:}", "{other}"):
        with pytest.raises(ValueError):
            names.namespace_of(bad, "ns", F.col("tags"))


def test_display_values(spark):
    df = spark.sql("""SELECT 1 AS i, CAST(1.50 AS DECIMAL(10,2)) AS d, array(1, 2) AS a, named_struct('x', 1) AS s,
                      DATE '2024-01-02' AS t, CAST(NULL AS STRING) AS n, X'0AFF' AS b""")
    row = df.select(*[display_value(F.col(f.name), f.dataType).alias(f.name) for f in df.schema]).first()
    assert tuple(row) == ("1", "1.5", "[1,2]", '{"x":1}', "2024-01-02", "", "0AFF")
