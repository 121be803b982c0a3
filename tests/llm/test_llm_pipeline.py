"""The pipeline: its stages keep what they should and hand on the columns of documents."""

import os
import re
import subprocess
import sys

import corpus_pipeline

#: What a process holds in MB, before and after it packs the passages of a few batches as a task does.
PACKING = """
import random, re
import pyarrow as pa
from assetloom.llm.repeats import _packer
from assetloom.llm.words import thrifty

def held():
    return sum(map(int, re.findall(r"Pss_Anon: *([0-9]+)", open("/proc/self/smaps_rollup").read()))) / 1024

rng = random.Random(3)
known = [f"w{k}" for k in range(2000)]
def batches():
    for k in range(4):
        texts = [" ".join(rng.choices(known, k=800)) for _ in range(2500)]
        ids = pa.array(range(k * 2500, (k + 1) * 2500), pa.int64())
        yield pa.RecordBatch.from_arrays([ids, pa.array(texts), ids], names=["doc", "body", "text"])

for task in (_packer, lambda *x: thrifty(_packer(*x))):
    for batch in task(50, 5, 8)(batches()):
        pass
    batch = None
    print("held", held())
"""



def test_stages_keep_the_columns_and_lose_only_what_they_name(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "minhash_near_dedup", "substring_dedup", "benchmark_decontamination", "source_mix"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert sorted(out.columns) == sorted(docs.columns) and dict(out.dtypes) == dict(docs.dtypes)
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert 0 < docs.count() < len(before)
    for r in docs.collect():
        assert set(r["text"].split()) <= set(before[r["doc_id"]]["text"].split())


def test_run_gives_the_rows_of_the_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame((out := stage(spark, docs, sf)).collect(), out.schema)
    key = lambda r: repr(sorted(r.asDict().items()))
    assert sorted(map(key, corpus_pipeline.run(spark, sf).collect())) == sorted(map(key, docs.collect()))


def test_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(20)
    odd = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "", "en", "s", 0), (None, "the of and", None, None, None)],
                                docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs.unionByName(odd), sf).collect()
        stage(spark, docs.limit(0), sf).collect()


def test_every_task_of_the_pipeline_gives_unused_memory_back(spark, sf, monkeypatch):
    frame = type(spark.range(1))
    tasks, plain = [], frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, func, *a, **b: (tasks.append(func), plain(self, func, *a, **b))[1])
    corpus_pipeline.run(spark, sf)
    assert len(tasks) >= 7
    for task in tasks:
        assert task.__qualname__.startswith("thrifty"), task.__qualname__


def test_a_task_that_ended_holds_little_memory():
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    ran = subprocess.run([sys.executable, "-c", PACKING], capture_output=True, text=True, timeout=120,
                         env=os.environ | {"PYTHONPATH": root})
    kept, given_back = map(float, re.findall(r"held ([0-9.]+)", ran.stdout))
    assert given_back < kept - 10, ran.stdout
