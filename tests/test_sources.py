import datetime as dt
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetloom.sources import databases, files, logs, packs, paged
from compare import values


def put(path, text, when=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    if when is not None:
        os.utime(path, (when.timestamp(), when.timestamp()))


def test_parquet_scans(spark, root):
    spark.range(20).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(f"{root}/t")
    put(f"{root}/t/p=0/_hidden.parquet", "no parquet")
    put(f"{root}/t/p=0/broken.parquet", "no parquet at all")
    df = files.scan_parquet(spark, f"{root}/t", tolerant=True, schema=T.StructType().add("id", "long").add("p", "integer"))
    assert df.count() == 20 and set(df.columns) == {"id", "p"}
    assert df.where("p = 1").count() == 10
    spark.range(20).write.parquet(f"{root}/u")
    assert files.scan_parquet(spark, f"{root}/u", n_rows=7).count() == 7
    got = values(files.scan_parquet(spark, f"{root}/u", index_by="id", index_offset=5, n_rows=3))
    assert got == [(0, 5), (1, 6), (2, 7)]


def test_absent_files(spark, root):
    schema = spark.range(1).schema
    assert files.scan_or_empty(spark, f"{root}/none", schema).count() == 0
    with pytest.raises(AnalysisException):
        files.scan_or_empty(spark, f"{root}/none", schema, allow_missing=False)


def test_manifest_and_contents(spark, root):
    old, new = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc), dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc)
    put(f"{root}/in/a/Report.CSV", "1", old)
    put(f"{root}/in/a/b/report2.csv", "22", new)
    put(f"{root}/in/notes", "333", new)
    all_files = files.manifest(spark, f"{root}/in")
    assert values(all_files, "name", "stem", "extension", "length") == [
        ("Report.CSV", "Report", ".csv", 1), ("notes", "notes", "", 3), ("report2.csv", "report2", ".csv", 2)]
    assert all_files.where("name = 'report2.csv'").first().parent.endswith("/in/a/b")
    assert files.manifest(spark, f"{root}/in", extension=".csv").count() == 2
    assert files.manifest(spark, f"{root}/in", pattern="*.csv").count() == 1
    for pattern, n in (("**/*.csv", 1), ("a/*.CSV", 1), ("*/*", 1), ("**/*", 3), ("a/**", 2), ("a/?/r*2.csv", 1), ("b/*", 0)):
        assert files.manifest(spark, f"{root}/in", pattern=pattern).count() == n, pattern
    assert files.manifest(spark, f"{root}/in", contains="REPORT", limit=1).count() == 1
    assert files.manifest(spark, f"{root}/in", modified_after=new).count() == 2
    assert files.manifest(spark, f"{root}/in", modified_before=old).count() == 1
    assert [r.name for r in files.new_files(all_files, old, "REPORT*").collect()] == ["report2.csv", "Report.CSV"]
    wanted = all_files.where("extension = '.csv'")
    assert values(files.read_contents(spark, f"{root}/in", wanted).select(F.col("content").cast("string"))) == [
        ("1",), ("22",)]
    plan = all_files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_folder_rollup(spark):
    df = spark.createDataFrame([("/r/a/x", 1, 10), ("/r/a/y", 2, 30), ("/r/a/c/z", 4, 20), ("/r/w", 8, 5)],
                               "path string, length long, modificationTime long")
    got = values(files.folder_rollup(df), "folder", "parent", "n_children", "n_files", "n_bytes", "last_change")
    assert got == sorted([("", None, 1, 4, 15, 30), ("r", "", 2, 4, 15, 30), ("r/a", "r", 3, 3, 7, 30),
                          ("r/a/c", "r/a", 1, 1, 4, 20)], key=repr)
    assert values(files.folder_rollup(df, under="/r", recursive=False), "folder") == [("r/a",)]
    assert values(files.folder_rollup(df, under="r/a"), "folder") == [("r/a",), ("r/a/c",)]


def test_bulk_load_separates_bad_lines(spark, root):
    put(f"{root}/c/one.csv", "1|a\nx|b\n3|c\n")
    schema = T.StructType().add("n", "integer").add("s", "string")
    good, bad = files.load_files(spark, f"{root}/c", "csv", schema, {"sep": "|"})
    assert values(good) == [(1, "a"), (3, "c")]
    assert [r["_corrupt_record"] for r in bad.collect()] == ["x|b"]
    put(f"{root}/j/one.json", '{"n": 1, "s": "a"}\nnot json\n')
    good, bad = files.load_files(spark, f"{root}/j", "json", schema)
    assert values(good) == [(1, "a")] and len(bad.collect()) == 1


@pytest.mark.parametrize("mode, rows", [("append", 4), ("overwrite", 2), ("ignore", 2)])
def test_save_modes(spark, root, mode, rows):
    files.write_parquet(spark.range(2), f"{root}/m")
    files.write_parquet(spark.range(2), f"{root}/m", mode)
    assert spark.read.parquet(f"{root}/m").count() == rows
    with pytest.raises(AnalysisException):
        files.write_parquet(spark.range(2), f"{root}/m")


def test_writer_options(spark, root):
    import pyarrow.parquet as pq

    df = spark.range(100000).coalesce(1)
    files.write_parquet(df, f"{root}/z", compression="zstd", level=3, row_group_bytes=128 * 1024, statistics=True)
    name = next(f for f in os.listdir(f"{root}/z") if f.endswith(".parquet"))
    meta = pq.ParquetFile(f"{root}/z/{name}").metadata
    assert meta.row_group(0).column(0).compression == "ZSTD" and meta.num_row_groups > 1
    assert meta.row_group(0).column(0).statistics is not None
    files.export_files(df, f"{root}/e", "parquet", max_records=30000)
    assert len([f for f in os.listdir(f"{root}/e") if f.endswith(".parquet")]) == 4


def test_jdbc_options():
    assert databases.jdbc_options("u", query="SELECT 1") == {"url": "u", "query": "SELECT 1"}
    got = databases.jdbc_options("u", query="SELECT 1", column="k", lower=0, upper=9, partitions=3)
    assert got["dbtable"] == "(SELECT 1) q" and got["partitionColumn"] == "k" and got["numPartitions"] == "3"
    for bad in ({}, {"table": "t", "query": "q"}, {"table": "t", "column": "k"}):
        with pytest.raises(ValueError):
            databases.jdbc_options("u", **bad)


def test_transfer_takes_one_source(spark):
    seen = []
    databases.transfer(spark, seen.append, source_table="t", views={"t": spark.range(3)}, mapping={"id": "n"})
    assert seen[0].columns == ["n"]
    with pytest.raises(ValueError):
        databases.transfer(spark, seen.append, source_table="t", select="SELECT 1")
    with pytest.raises(ValueError):
        databases.transfer(spark, seen.append)


def test_incremental(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, TIMESTAMP '2024-01-01 00:00:00', named_struct('a', 1)),
                      (2, TIMESTAMP '2024-01-02 00:00:00', named_struct('a', 2)) AS t(id, ts, address)""")
    out = databases.incremental(df, "ts", dt.datetime(2024, 1, 2, 0, 0, 0, 999))
    assert values(out, "id") == [(2,)] and out.columns == ["id", "ts"]
    assert databases.incremental(df, limit=1).count() == 1
    assert databases.simple_fields(df.withColumnRenamed("address", "Name").schema) == ["id", "ts", "Name"]


def test_paged_source(spark, root):
    """Pages as files; each names the next one."""
    for q in ("x", "y"):
        for n in range(3):
            page = {"rows": [[q, n * 2], [q, n * 2 + 1]], "next": str(n + 1) if n < 2 else None}
            put(f"{root}/{q}-{n}.json", json.dumps(page))

    def fetch(query, since, until, cursor, page_size):
        with open(f"{root}/{query}-{cursor or 0}.json") as f:
            page = json.load(f)
        return [tuple(r) for r in page["rows"]], page["next"]

    chains = [paged.Chain("x"), paged.Chain("y")]
    spark.dataSource.register(paged.paged_source("pages_all", "q string, n int", fetch, chains))
    df = spark.read.format("pages_all").load()
    assert values(df) == [(q, n) for q in ("x", "y") for n in range(6)]
    spark.dataSource.register(paged.paged_source("pages_some", "q string, n int", fetch, chains, limit_per_chain=3))
    assert spark.read.format("pages_some").load().count() == 6
    start = dt.datetime(2024, 1, 1)
    parts = paged.split_window("q", start, start + dt.timedelta(hours=5), dt.timedelta(hours=2))
    assert [p.until[11:13] for p in parts] == ["02", "04", "05"]


def test_paged_limit_and_stream(spark, root):
    """Three runs of a stream over a service that grows: every page once, also after a restart."""
    def page(query, n, last):
        put(f"{root}/{query}-{n}.json", json.dumps({
            "rows": [[query, n * 2], [query, n * 2 + 1]] if n or query != "empty" else [], "next": None if last else str(n + 1)}))

    def stored(query, cursor):
        with open(f"{root}/{query}-{cursor or 0}.json") as f:
            return json.load(f)

    def fetch(query, since, until, cursor, page_size):
        found = stored(query, cursor)
        with open(f"{root}/fetched-{query}-{cursor or 0}", "a") as f:
            f.write("x")
        return [tuple(r) for r in found["rows"]], found["next"]

    def peek(query, since, until, cursor):
        return stored(query, cursor)["next"]

    chains = [paged.Chain("x"), paged.Chain("y"), paged.Chain("empty")]
    page("empty", 0, True)
    for q, n in (("x", 4), ("y", 1)):
        for i in range(n):
            page(q, i, i == n - 1)
    spark.dataSource.register(paged.paged_source("pages_limited", "q string, n int", fetch, chains, limit_per_chain=3))
    assert values(paged.read_limited(spark, "pages_limited", "n", 3).select("n")) == [(0,), (0,), (1,)]
    assert not os.path.exists(f"{root}/fetched-x-2")  # pages past the limit are not asked for
    spark.dataSource.register(paged.paged_source("pages_stream", "q string, n int", fetch, chains, peek=peek))

    def run():
        spark.readStream.format("pages_stream").load().writeStream.option(
            "checkpointLocation", f"{root}/offsets").format("parquet").trigger(availableNow=True).start(
            f"{root}/out").awaitTermination()
        return values(spark.read.schema("q string, n int").parquet(f"{root}/out"))

    assert run() == [("x", n) for n in range(8)] + [("y", n) for n in range(2)]
    for q, n in (("x", 3), ("y", 0)):
        page(q, n, False)
        page(q, n + 1, True)
    more = [("x", n) for n in range(10)] + [("y", n) for n in range(4)]
    assert run() == more
    assert run() == more
    with open(f"{root}/fetched-x-3") as f:
        assert f.read() == "x"
    spark.dataSource.register(paged.paged_source("pages_still", "q string, n int", fetch, chains))
    with pytest.raises(Exception, match="can't be streamed"):
        spark.readStream.format("pages_still").load().writeStream.format("noop").trigger(availableNow=True).start(
            ).awaitTermination()


def test_stored_logs(spark, root):
    put(f"{root}/pre/storage/a/run/step.out", "one\ntwo\n")
    put(f"{root}/pre/storage/apple/run/step.err", "bad\n")
    put(f"{root}/pre/storage/a/run/step.err.partial", "part\n")
    put(f"{root}/pre/other/a/run/step.out", "elsewhere\n")
    put(f"{root}/pre/storage/a/run/readme.txt", "no log\n")
    df = logs.read_logs(spark, root, "pre").where(logs.under_key(F.col("log_key"), ["a"]))
    got = values(df.select(F.array_join("log_key", "/").alias("k"), "io_type", "is_partial", "line"))
    assert got == [("a/run/step", "err", True, "part"), ("a/run/step", "out", False, "one"), ("a/run/step", "out", False, "two")]


def test_messages(spark):
    lines = [json.dumps({"version": "0.1", "method": "log", "params": {"message": "hi"}}),
             json.dumps({"version": "0.1", "method": "report_asset_materialization", "params": {"metadata": {
                 "n": 3, "typed": {"raw_value": "x", "type": "md"}, "plain": {"type": "md"}, "none": None}}}),
             "noise"]
    df = logs.parse_messages(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert values(df, "method") == sorted([("log",), ("report_asset_materialization",), (None,)], key=repr)
    meta = logs.metadata_values(
        df.where("method LIKE 'report%'").select(F.get_json_object("params", "$.metadata").alias("m")), "m")
    got = {r.key: (r.raw_value, r.type) for r in meta.collect()}
    assert got["n"] == ("3", "__infer__") and got["typed"] == ("x", "md")
    assert got["plain"] == ('{"type":"md"}', "__infer__") and got["none"][1] == "__infer__"


def test_query_pack(spark, root):
    put(f"{root}/pack/web/all_rows.sql", "SELECT count(*) AS n FROM nums")
    put(f"{root}/pack/web/even.sql", "WITH e AS (SELECT * FROM nums WHERE id % 2 = 0) SELECT count(*) AS n FROM e")
    queries = packs.read_pack(spark, f"{root}/pack")
    assert list(queries) == ["web.all_rows", "web.even"]
    out = packs.run_pack(spark, queries, {"nums": spark.range(10)}, f"{root}/out")
    assert {k: v.first().n for k, v in out.items()} == {"web.all_rows": 10, "web.even": 5}


def test_keyed_datasets(spark, root):
    df = spark.createDataFrame([(1, "a", "main", "train"), (2, "b", "main", "test")],
                               "n int, config string, revision string, split string")
    packs.write_dataset(df, f"{root}/d")
    assert values(packs.read_dataset(spark, f"{root}/d", "config:b", config="a"), "n") == [(2,)]
    assert values(packs.read_dataset(spark, f"{root}/d", split="train"), "n") == [(1,)]
    assert packs.parse_dataset_key("date:a:b") == ("date", "a:b")
    with pytest.raises(ValueError):
        packs.parse_dataset_key("main")


def test_registry(spark):
    registry = packs.SourceRegistry()
    registry.register("numbers", lambda s, n: s.range(n))
    assert registry.load(spark, "numbers", n=4).count() == 4
    with pytest.raises(KeyError):
        registry.load(spark, "letters")
