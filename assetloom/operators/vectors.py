"""Vector search: exact nearest k, nearest k by text, object insert, and probing by centroid lists.

The corpus is never shuffled. Queries travel to the tasks in blocks of a checked size; every task
keeps the best k per query over all its batches and emits only those, and a per-query window ranks
the small remainder. Scores are rounded before ranking and ties go to the smaller id, so the result
does not depend on how rows fall into batches.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetloom.operators.contracts import Contract, ColumnSpec, Rule, require
from assetloom.operators.tables import AssetTable
from assetloom.operators.upsert import UpsertOptions
from assetloom.session import checkpointed, scratch

QUERY_BLOCK_BYTES = 64 * 1024 * 1024
MIN_QUERY_BYTES = 16 * 1024  # so that a block holds at most 4096 queries
SCORE_CELLS = 4 * 1024 * 1024  # rows x queries scored at a time in a task
SCORE_DIGITS = 9


def certainty(cosine: Column) -> Column:
    return (F.lit(1.0) + cosine) / 2


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column as a dense matrix of unit rows; vectors must share one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        raise ValueError("a vector is null")
    values = np.asarray(column.flatten(), dtype=np.float64)
    rows = len(column)
    if rows == 0:
        return values.reshape(0, 0)
    lengths = np.diff(np.asarray(column.offsets))
    if (lengths != lengths[0]).any():
        raise ValueError("vectors differ in length")
    out = values.reshape(rows, -1)
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norms == 0, 1.0, norms)


class _Best:
    """The best k (score, id) per query seen so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.scores: list[np.ndarray] = [np.empty(0)] * queries
        self.ids: list[np.ndarray | None] = [None] * queries

    def add(self, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray | None = None) -> None:
        """Offer a block: ``scores`` is rows x queries, ``allowed`` masks pairs that do not count."""
        for q in range(scores.shape[1]):
            column = scores[:, q]
            rows = np.arange(len(column)) if allowed is None else np.flatnonzero(allowed[:, q])
            if len(self.scores[q]) == self.k:
                rows = rows[column[rows] >= self.scores[q][-1]]
            if not len(rows):
                continue
            if len(rows) > self.k:
                kth = -np.partition(-column[rows], self.k - 1)[self.k - 1]
                rows = rows[column[rows] >= kth]
            s = np.concatenate([self.scores[q], column[rows]])
            i = ids[rows] if self.ids[q] is None else np.concatenate([self.ids[q], ids[rows]])
            order = np.lexsort((i, -s))[: self.k]
            self.scores[q], self.ids[q] = s[order], i[order]

    def batches(self, query_ids: pa.Array, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for q, found in enumerate(self.ids):
            if found is not None and len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([query_ids[q].as_py()] * len(found), schema.field(0).type),
                     pa.array(found.tolist(), schema.field(1).type), pa.array(self.scores[q], pa.float64())],
                    schema=schema,
                )


def _ids(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist()) if pa.types.is_string(column.type) else np.asarray(column)


def _pieces(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose matrices of that width stay small; none when there is no query."""
    step = max(1, SCORE_CELLS // max(1, width))
    for at in range(0, batch.num_rows if width else 0, step):
        yield batch.slice(at, step)


def _rank(best: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("cosine"), "id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search(corpus: DataFrame, queries: DataFrame, k: int, bytes_per_query: int,
            kernel: Callable[[DataFrame], Callable]) -> DataFrame:
    """Run ``kernel`` per block of queries. One block is answered lazily; more than one are answered
    in turn into a table in the shared folder, so the driver and tasks hold one block at a time."""
    spark = corpus.sparkSession
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("id", corpus.schema["id"].dataType), T.StructField("cosine", T.DoubleType()),
    ])
    each = max(bytes_per_query, MIN_QUERY_BYTES)
    blocks = max(1, math.ceil(queries.count() * each / QUERY_BLOCK_BYTES))
    if blocks == 1:
        return _rank(corpus.mapInArrow(kernel(queries), schema), k)
    out = scratch(spark, "nearest")
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b)
        _rank(corpus.mapInArrow(kernel(block), schema), k).write.mode("append").parquet(out)
    return spark.read.parquet(out)


def nearest(corpus: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Exact nearest k by cosine: ``corpus(id, vector)``, ``queries(query_id, vector)``."""
    corpus, queries = corpus.select("id", "vector"), queries.select("query_id", "vector")
    first = queries.select(F.size("vector").alias("n")).first()
    width = first.n if first else 1

    def kernel(block: DataFrame):
        table = block.toArrow()  # one block: at most QUERY_BLOCK_BYTES
        matrix, names = _matrix(table["vector"]), table["query_id"].combine_chunks()
        id_type = pa.int64() if corpus.schema["id"].dataType == T.LongType() else None

        def run(batches):
            best, kind = _Best(len(names), k), id_type
            for batch in batches:
                kind = batch.schema.field("id").type
                for piece in _pieces(batch, len(names)):
                    scores = np.round(_matrix(piece.column("vector")) @ matrix.T, SCORE_DIGITS)
                    best.add(scores, _ids(piece.column("id")))
            if kind is not None:
                yield from best.batches(names, pa.schema(
                    [("query_id", names.type), ("id", kind), ("cosine", pa.float64())]))

        return run

    found = _search(corpus, queries, k, width * 8, kernel)
    return found.withColumn("certainty", F.round(certainty(F.col("cosine")), SCORE_DIGITS))


# --- text ----------------------------------------------------------------------------------------


def _terms(text: str) -> Column:
    """The terms of a text, lower-cased runs of letters and numbers, as 64-bit hashes."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _counted(corpus: DataFrame) -> DataFrame:
    """``id, terms, tf``: the different terms of each row's text and how often each occurs."""
    schema = T.StructType([corpus.schema["id"], T.StructField("terms", T.ArrayType(T.LongType())),
                           T.StructField("tf", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            terms = batch.column("terms")
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(terms.offsets)))
            flat = np.asarray(terms.flatten(), dtype=np.int64)
            order = np.lexsort((flat, row))
            row, flat = row[order], flat[order]
            first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (flat[1:] != flat[:-1])][: len(flat)])
            offsets = pa.array(np.searchsorted(row[first], np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64()))
                     for x in (flat[first], np.diff(np.r_[first, len(flat)]))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *lists], names=["id", "terms", "tf"])

    return corpus.select("id", _terms("text").alias("terms")).mapInArrow(run, schema)


def _weighed(counted: DataFrame, key: str, idf: Column, documents: DataFrame) -> DataFrame:
    """``key, term, weight`` of the TF-IDF vectors; a term no document holds weighs most."""
    rows = counted.join(documents, "term", "left").groupBy(key, "term").agg(
        F.sum("tf").alias("tf"), F.first("df").alias("df"))  # as they lie by term, rows are not moved again
    return rows.select(key, "term", (F.col("tf") * idf).alias("weight"))


def _runs(upto: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose share of a running total is about ``most``."""
    lo = 0
    while lo < len(upto):
        base = upto[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, base + most, side="right")))
        yield lo, hi
        lo = hi


def nearest_texts(corpus: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Nearest k texts by TF-IDF cosine: ``corpus(id, text)``, ``queries(query_id, text)``; ids are unique.

    Texts are cut and their terms counted once, into the shared folder. Document frequencies and lengths of vectors are
    grouped sums over all counted terms. The tasks then need only the terms of a block of queries; whole texts are weighed
    where they lie.
    """
    path = scratch(corpus.sparkSession, "terms")
    _counted(corpus).write.parquet(path)
    docs = corpus.sparkSession.read.parquet(path)
    asked = queries.select("query_id", _terms("text").alias("terms"))
    n_docs = docs.count()
    frequency = checkpointed(docs.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df")))
    idf = F.log(F.lit(n_docs + 1.0) / (F.coalesce("df", F.lit(0)) + 1))

    def lengths(weighed: DataFrame, key: str) -> DataFrame:
        return weighed.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"))

    counted = docs.select("id", F.inline(F.arrays_zip(F.col("terms").alias("term"), "tf")))
    measured = docs.join(lengths(_weighed(counted, "id", idf, frequency), "id"), "id", "left")
    once = asked.select("query_id", F.explode("terms").alias("term"), F.lit(1).alias("tf"))
    weighed = checkpointed(_weighed(once, "query_id", idf, frequency))
    unit = weighed.join(lengths(weighed, "query_id"), "query_id").join(
        frequency.select("term", idf.alias("idf")), "term").where("length > 0").groupBy("query_id").agg(
        F.collect_list(F.struct("term", (F.col("weight") / F.col("length")).alias("weight"), "idf")).alias("unit"))
    vectors = asked.select("query_id").join(unit, "query_id", "left")
    longest = vectors.agg(F.max(F.size("unit")).alias("n")).first().n or 1

    def kernel(block: DataFrame):
        table = block.select("query_id", F.inline_outer("unit")).toArrow()  # one block: at most QUERY_BLOCK_BYTES
        names, number = np.unique(np.array(table["query_id"].to_pylist()), return_inverse=True)
        there = ~np.asarray(table["term"].is_null())
        q_row = number[there]
        q_term, q_weight, q_idf = (np.asarray(table[c].drop_null()) for c in ("term", "weight", "idf"))
        by_term = np.argsort(q_term, kind="stable")
        q_row, q_weight = q_row[by_term], q_weight[by_term]
        used, first, held = np.unique(q_term[by_term], return_index=True, return_counts=True)
        rarity = q_idf[by_term][first]
        ids = pa.array(names.tolist(), table.schema.field("query_id").type)

        def run(batches):
            best, kind = _Best(len(names), k), None
            for batch in batches:
                kind = batch.schema.field("id").type
                for piece in _pieces(batch, len(names)):
                    terms = piece.column("terms")
                    row = np.repeat(np.arange(piece.num_rows), np.diff(np.asarray(terms.offsets)))
                    flat = np.asarray(terms.flatten(), dtype=np.int64)
                    at = np.minimum(np.searchsorted(used, flat), max(len(used) - 1, 0))
                    shared = used[at] == flat if len(used) else np.zeros(len(flat), dtype=bool)
                    row, at, tf = row[shared], at[shared], np.asarray(piece.column("tf").flatten())[shared]
                    weight = tf * rarity[at] / np.asarray(piece.column("length").fill_null(1.0))[row]
                    scores = np.zeros(piece.num_rows * len(names))
                    for lo, hi in _runs(np.cumsum(held[at]), SCORE_CELLS):
                        n = held[at[lo:hi]]
                        entry = np.arange(n.sum()) + np.repeat(first[at[lo:hi]] - (np.cumsum(n) - n), n)
                        cell = np.repeat(row[lo:hi], n) * len(names) + q_row[entry]
                        scores += np.bincount(cell, np.repeat(weight[lo:hi], n) * q_weight[entry], len(scores))
                    scores = np.round(scores.reshape(piece.num_rows, len(names)), SCORE_DIGITS)
                    best.add(scores, _ids(piece.column("id")))
            if kind is not None:
                yield from best.batches(ids, pa.schema(
                    [("query_id", ids.type), ("id", kind), ("cosine", pa.float64())]))

        return run

    found = _search(measured, vectors, k, longest * 24, kernel)
    return found.withColumn("certainty", F.round(certainty(F.col("cosine")), SCORE_DIGITS))


# --- storing -------------------------------------------------------------------------------------


def insert_objects(collection: AssetTable, objects: DataFrame, dimension: int, key: str = "id",
                   vector: str = "vector") -> int:
    """Add or replace objects by id in a collection; vectors of another dimension are refused."""
    spec = tuple(ColumnSpec(f.name, f.dataType.simpleString(), nullable=f.name not in (key, vector))
                 for f in objects.schema)
    require(objects, Contract(spec, (Rule("dimension", F.size(vector) == dimension),)))
    if collection.last_version() is None:
        return collection.overwrite(objects)
    return collection.upsert(objects, UpsertOptions((key,)))


# --- approximate ---------------------------------------------------------------------------------


def train_centroids(corpus: DataFrame, lists: int, seed: int = 7, iterations: int = 10) -> np.ndarray:
    """k-means centers of unit vectors (``lists`` x dimension numbers come back)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    data = corpus.select(array_to_vector(F.col("vector").cast("array<double>")).alias("features"))
    model = KMeans(k=lists, seed=seed, maxIter=iterations, distanceMeasure="cosine").fit(data)
    centers = np.vstack(model.clusterCenters())
    return centers / np.linalg.norm(centers, axis=1, keepdims=True)


def assign_lists(corpus: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``corpus(id, vector)`` with the list of its nearest centroid; store it partitioned by list."""
    schema = T.StructType(corpus.select("id", "vector").schema.fields + [T.StructField("list_id", T.IntegerType())])

    def run(batches):
        for batch in batches:
            rows = _matrix(batch.column("vector"))
            lists = np.argmax(rows @ centroids.T, axis=1) if len(rows) else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.array(lists.astype(np.int32))],
                names=["id", "vector", "list_id"])

    return corpus.select("id", "vector").mapInArrow(run, schema)


def nearest_in_lists(indexed: DataFrame, centroids: np.ndarray, queries: DataFrame, k: int,
                     probes: int) -> DataFrame:
    """Approximate nearest k: each query sees the vectors of its ``probes`` nearest lists only.

    Lists no query probes are pruned when the index is stored partitioned by ``list_id``. A list that
    holds most vectors is still read by many tasks, as the corpus is never grouped by list.
    """
    def kernel(block: DataFrame):
        table = block.toArrow()  # one block: at most QUERY_BLOCK_BYTES
        matrix, names = _matrix(table["vector"]), table["query_id"].combine_chunks()
        probed = np.zeros((len(centroids), len(names)), dtype=bool)
        if len(names):
            near = np.argsort(-(matrix @ centroids.T), axis=1)[:, :probes]
            probed[near.ravel(), np.repeat(np.arange(len(names)), near.shape[1])] = True

        def run(batches):
            best, kind = _Best(len(names), k), None
            for batch in batches:
                kind = batch.schema.field("id").type
                lists = np.asarray(batch.column("list_id"))
                rows = np.flatnonzero(probed[lists].any(axis=1)) if len(names) else np.empty(0, dtype=int)
                if not len(rows):
                    continue
                for piece in _pieces(batch.take(pa.array(rows)), len(names)):
                    scores = np.round(_matrix(piece.column("vector")) @ matrix.T, SCORE_DIGITS)
                    allowed = probed[np.asarray(piece.column("list_id"))]
                    best.add(scores, _ids(piece.column("id")), allowed)
            if kind is not None:
                yield from best.batches(names, pa.schema(
                    [("query_id", names.type), ("id", kind), ("cosine", pa.float64())]))

        return run

    queries = queries.select("query_id", "vector")
    found = _search(indexed.select("id", "vector", "list_id"), queries, k, centroids.shape[1] * 8, kernel)
    return found.withColumn("certainty", F.round(certainty(F.col("cosine")), SCORE_DIGITS))
