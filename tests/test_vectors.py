"""Vector search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assetloom.operators import vectors
from assetloom.operators.tables import AssetTable
from compare import values


def corpus(spark, n=600, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, dim))
    data[: n // 3] = data[0]  # a third of all vectors are copies
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    return spark.createDataFrame(rows, "id long, vector array<double>").repartition(5), data


def brute(data, queries, k):
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    out = []
    for q, v in queries:
        cos = np.round(unit @ (v / np.linalg.norm(v)), vectors.SCORE_DIGITS)
        order = np.lexsort((np.arange(len(cos)), -cos))[:k]
        out += [(q, int(i), rank + 1) for rank, i in enumerate(order)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("cells, block", [(4 * 2**20, 64 * 2**20), (50, 64 * 2**20), (50, 3 * 16 * 1024)])
def test_exact_nearest(spark, monkeypatch, cells, block):
    """One block or many, one score matrix or many: the same result."""
    monkeypatch.setattr(vectors, "SCORE_CELLS", cells)
    monkeypatch.setattr(vectors, "QUERY_BLOCK_BYTES", block)
    df, data = corpus(spark)
    asked = [(q, data[q * 70] * 2.0) for q in range(8)]
    queries = spark.createDataFrame([(q, [float(x) for x in v]) for q, v in asked], "query_id long, vector array<double>")
    got = vectors.nearest(df, queries, 4)
    assert values(got, "query_id", "id", "rank") == brute(data, asked, 4)
    top = got.where("rank = 1").agg(F.min("certainty")).first()[0]
    assert top == pytest.approx(1.0)


def test_text_ids_and_fewer_than_k(spark):
    df = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0])], "id string, vector array<float>")
    q = spark.createDataFrame([("q", [2.0, 0.0])], "query_id string, vector array<float>")
    assert values(vectors.nearest(df, q, 5), "rank", "id", "certainty") == [(1, "a", 1.0), (2, "b", 1.0), (3, "c", 0.5)]


def test_uneven_vectors_are_refused(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "id long, vector array<double>")
    q = spark.createDataFrame([(1, [2.0, 0.0])], "query_id long, vector array<double>")
    with pytest.raises(Exception, match="differ in length"):
        vectors.nearest(df.coalesce(1), q, 1).collect()


FRUIT = ["a pineapple from hawaii", "oranges from florida", "This is a document about pineapple", "apples and pears"]


@pytest.mark.parametrize("cells", [4 * 2**20, 3])
def test_nearest_texts(spark, monkeypatch, cells):
    monkeypatch.setattr(vectors, "SCORE_CELLS", cells)
    df = spark.createDataFrame(list(enumerate(FRUIT)), "id int, text string")
    df = df.select(F.col("id").cast("long").alias("id"), "text")
    q = spark.createDataFrame([(0, "This is a query document about hawaii"), (1, "pears, APPLES!"), (2, "")],
                              "query_id long, text string")
    got = {(r.query_id, r["rank"]): (r.id, r.cosine) for r in vectors.nearest_texts(df, q, 2).collect()}
    tokens = [t.lower().split() for t in FRUIT]
    df_count = {}
    for t in tokens:
        for w in set(t):
            df_count[w] = df_count.get(w, 0) + 1

    def weigh(words):
        v = {w: words.count(w) * np.log(5 / (df_count.get(w, 0) + 1)) for w in set(words)}
        n = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / n for w, x in v.items()}

    want = [sum(x * weigh(t).get(w, 0) for w, x in weigh("this is a query document about hawaii".split()).items())
            for t in tokens]
    assert got[(0, 1)][0] == int(np.argmax(want)) and got[(0, 1)][1] == pytest.approx(max(want), abs=1e-6)
    assert got[(1, 1)][0] == 3
    assert got[(2, 1)] == (0, 0.0)


def test_texts_are_cut_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    df = spark.createDataFrame(list(enumerate([*FRUIT, None])), "id long, text string").mapInPandas(counted, "id long, text string")
    q = spark.createDataFrame([(0, "apples from florida")], "query_id long, text string")
    assert values(vectors.nearest_texts(df, q, 2), "id", "rank") == [(1, 1), (3, 2)]
    assert seen.value == len(FRUIT) + 1


def test_probing_all_lists_is_exact(spark, root):
    df, data = corpus(spark, 300)
    centroids = vectors.train_centroids(df, 6)
    vectors.assign_lists(df, centroids).write.partitionBy("list_id").parquet(f"{root}/ix")
    index = spark.read.parquet(f"{root}/ix")
    asked = [(q, data[q * 29]) for q in range(10)]
    queries = spark.createDataFrame([(q, [float(x) for x in v]) for q, v in asked], "query_id long, vector array<double>")
    full = values(vectors.nearest_in_lists(index, centroids, queries, 3, 6), "query_id", "id", "rank")
    assert full == brute(data, asked, 3)
    some = values(vectors.nearest_in_lists(index, centroids, queries, 3, 2), "query_id", "id", "rank")
    assert len(set(some) & set(full)) / len(full) > 0.7


def test_insert_objects(spark, root):
    t = AssetTable(spark, root, "objects")
    vectors.insert_objects(t, spark.createDataFrame([(1, "q", [1.0, 2.0])], "id long, q string, vector array<double>"), 2)
    vectors.insert_objects(t, spark.createDataFrame([(1, "r", [3.0, 2.0]), (2, "s", [0.0, 1.0])],
                                                    "id long, q string, vector array<double>"), 2)
    assert values(t.read(), "id", "q") == [(1, "r"), (2, "s")]
    with pytest.raises(ValueError, match="dimension"):
        vectors.insert_objects(t, spark.createDataFrame([(3, "x", [1.0])], "id long, q string, vector array<double>"), 2)
