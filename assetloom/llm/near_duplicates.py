"""Near-duplicate classes by ProbMinHash.

The weighted set of a text holds its runs of ``n`` words (a shorter text is one run) with how often each occurs. Every
element sends arrivals of a Poisson process whose rate is its weight, each to one of ``REGISTERS`` registers without
replacement; a register keeps its earliest arrival. An element stops as soon as its next arrival comes after the latest
register, so long texts cost few arrivals per element. Two texts agree in a register with their probability Jaccard
similarity. Bands of registers propose pairs and the exact similarity of the whole texts decides.

Texts of equal words are one node, so copies never form pairs. In a bucket each node is compared with the smallest one.
Where that leaves several components in a bucket, blocks of its members are compared in memory: an inverted index of the
block bounds every similarity from above by the shared weight, and only pairs of different components that pass the bound
are compared exactly. So a candidate pair is either compared or already joined, no pairs are stored but the links found,
and a group of copies stays a star.

Nulls and texts without words are a class of their own. A null id has a null class. Rows of one id share a class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetloom.llm.components import components
from assetloom.llm.words import (
    Words,
    buffer,
    gram_hashes,
    mixed,
    pieces,
    single_spaced,
    small_batches,
    streams,
    thrifty,
    word_hashes,
    words_of,
)
from assetloom.session import checkpointed

REGISTERS = 128
#: 25 bands of 5: a pair of similarity 0.8 shares a band with probability 0.99995.
BANDS, ROWS = 25, 5
BLOCK = 512
#: Bytes of texts that are sketched or compared at a time; a longer text is taken alone.
_PIECE = 1 << 20


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                           threshold: float = 0.8) -> DataFrame:
    """``id_col``, ``class_id`` (smallest id of the class) of every row of ``docs``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("body"))
    sketched = checkpointed(rows.where("doc IS NOT NULL").mapInArrow(
        thrifty(_sketcher(n)), "doc long, digest binary, bands array<long>"))
    nodes = sketched.groupBy("digest").agg(F.min("doc").alias("node"), F.any_value("bands").alias("bands"))
    buckets = nodes.select("node", F.explode("bands").alias("key"))
    leaders = buckets.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = checkpointed(buckets.join(leaders, "key"))
    texts = rows.where("doc IS NOT NULL")
    stars = shared.where("node > a").select("a", F.col("node").alias("b")).distinct()
    links = checkpointed(_similar(stars, texts, n, threshold))
    links = links.unionByName(_rest(shared, components(links), texts, n, threshold))
    same = sketched.groupBy("digest").agg(F.min("doc").alias("a")).join(
        sketched.select("doc", "digest"), "digest").select("a", F.col("doc").alias("b"))
    roots = components(links.unionByName(same))
    return rows.select("doc").join(roots, F.col("doc") == F.col("node"), "left").select(
        F.col("doc").alias(id_col), F.coalesce("root", "doc").alias("class_id"))


def _rest(shared: DataFrame, labels: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """Links between components that meet in a bucket, where the comparison with the leader has not settled all.

    Buckets of the same members count once. A bucket beyond ``BLOCK`` is cut into blocks by hash and each pair of blocks
    is one group, so a group holds about ``2 * BLOCK`` texts however large the bucket is.
    """
    known = shared.join(labels, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    mixed_ones = known.groupBy("key").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.first("n").alias("n"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members")).where("low < high AND n > 2")
    chosen = mixed_ones.groupBy("members", "n").agg(F.min("key").alias("key"))
    blocks = F.ceil(F.col("n") / BLOCK)
    apart = known.join(chosen.select("key"), "key").withColumn("block", F.pmod(F.xxhash64("node"), blocks))
    dealt = apart.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).where(
        (F.col("other") != F.col("block")) | (blocks == 1))
    paired = checkpointed(dealt.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                                       "node", "root"))
    whole = paired.join(texts.select(F.col("doc").alias("node"), "body"), "node")
    return whole.groupBy("key", "x", "y").applyInArrow(_linker(n, threshold), "a long, b long")


def _similar(pairs: DataFrame, texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """The pairs whose exact similarity reaches the threshold."""
    whole = pairs.join(texts.select(F.col("doc").alias("b"), F.col("body").alias("right")), "b").join(
        texts.select(F.col("doc").alias("a"), F.col("body").alias("left")), "a")
    return whole.select("a", "b", "left", "right").mapInArrow(thrifty(_verifier(n, threshold)), "a long, b long")


def weighted_runs(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of each distinct run of n words, by text and hash."""
    hashes = word_hashes(words)
    grams = gram_hashes(hashes, n)
    doc = words.doc[: len(grams)]
    whole = doc == words.doc[n - 1 :] if len(grams) else np.zeros(0, bool)
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    parts = [np.sum(hashes[words.first[d] : words.first[d + 1]] * streams(n, 7)[: words.counts[d]],
                    dtype=np.uint64) + np.uint64(words.counts[d]) for d in short]
    doc = np.concatenate([doc[whole], short])
    runs = np.concatenate([grams[whole], mixed(parts)])
    order = np.lexsort((runs, doc))
    doc, runs = doc[order], runs[order]
    heads = np.concatenate([[True], (doc[1:] != doc[:-1]) | (runs[1:] != runs[:-1])]) if len(doc) else np.zeros(0, bool)
    at = np.flatnonzero(heads)
    return doc[at], runs[at], np.diff(np.concatenate([at, [len(doc)]])).astype(np.float64)


def signatures(doc: np.ndarray, runs: np.ndarray, weight: np.ndarray, texts: int) -> np.ndarray:
    """The run that each register of each text keeps."""
    times = np.full(texts * REGISTERS, np.inf)
    kept = np.zeros(texts * REGISTERS, np.uint64)
    latest = np.full(texts, np.inf)
    seed = mixed(runs ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    first, step = seed & np.uint64(REGISTERS - 1), (seed >> np.uint64(20)) | np.uint64(1)
    now, active = np.zeros(len(runs)), np.arange(len(runs))
    for i in range(REGISTERS):
        if not len(active):
            break
        draw = mixed(seed[active] + np.uint64(((i + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        uniform = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        now[active] -= np.log(uniform) * (REGISTERS / (REGISTERS - i)) / weight[active]
        active = active[now[active] < latest[doc[active]]]
        place = doc[active] * REGISTERS + ((first[active] + np.uint64(i) * step[active])
                                           & np.uint64(REGISTERS - 1)).astype(np.int64)
        better = now[active] < times[place]
        arrived, place = active[better], place[better]
        late_first = np.argsort(-now[arrived], kind="stable")
        times[place[late_first]] = now[arrived[late_first]]
        kept[place[late_first]] = runs[arrived[late_first]]
        latest = times.reshape(texts, REGISTERS).max(axis=1)
    return kept.reshape(texts, REGISTERS)


def _sketcher(n: int):
    factors, own = streams(ROWS, 11), streams(BANDS, 13)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "body", _PIECE):
                words = words_of(*buffer(piece.column("body")))
                some = np.flatnonzero(words.counts)
                if not len(some):
                    continue
                kept = signatures(*weighted_runs(words, n), piece.num_rows)[some, : BANDS * ROWS]
                bands = mixed((kept.reshape(len(some), BANDS, ROWS) * factors).sum(axis=2, dtype=np.uint64) + own)
                joined, left, right = single_spaced(words)
                ends = zip(left[words.first[some]].tolist(), right[words.first[some + 1] - 1].tolist())
                digests = [hashlib.sha256(joined[a:b]).digest() for a, b in ends]
                lists = pa.ListArray.from_arrays(np.arange(len(some) + 1, dtype=np.int32) * BANDS,
                                                 pa.array(bands.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc").take(pa.array(some)), pa.array(digests, pa.binary()), lists],
                    names=["doc", "digest", "bands"])

    return sketch


def probability_jaccard(pair: np.ndarray, v: np.ndarray, w: np.ndarray, pairs: int) -> np.ndarray:
    """Sum over shared elements d of 1 / sum over all elements e of max(v_e / v_d, w_e / w_d)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(w > 0, v / w, np.inf)
        order = np.lexsort((ratio, pair))
        pair, v, w, ratio = pair[order], v[order], w[order], ratio[order]
        heads = np.searchsorted(pair, np.arange(pairs + 1))
        sum_v, sum_w = np.concatenate([[0], np.cumsum(v)]), np.concatenate([[0], np.cumsum(w)])
        here = np.arange(len(pair))
        above = sum_v[heads[pair + 1]] - sum_v[here]
        below = sum_w[here] - sum_w[heads[pair]]
        shared = (v > 0) & (w > 0)
        terms = np.where(shared, 1 / (above / v + below / w), 0)
    return np.bincount(pair, terms, minlength=pairs)


def similarities(left: pa.Array, right: pa.Array, n: int) -> np.ndarray:
    """Exact probability Jaccard of each pair of texts."""
    a, b = weighted_runs(words_of(*buffer(left)), n), weighted_runs(words_of(*buffer(right)), n)
    pair, runs = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    v = np.concatenate([a[2], np.zeros(len(b[2]))])
    w = np.concatenate([np.zeros(len(a[2])), b[2]])
    order = np.lexsort((runs, pair))
    pair, runs, v, w = pair[order], runs[order], v[order], w[order]
    if not len(pair):
        return np.zeros(len(left))
    heads = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (runs[1:] != runs[:-1])]))
    return probability_jaccard(pair[heads], np.add.reduceat(v, heads), np.add.reduceat(w, heads), len(left))


def _verifier(n: int, threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "left", _PIECE):
                for half in pieces(piece, "right", _PIECE):
                    alike = similarities(half.column("left"), half.column("right"), n) >= threshold - 1e-9
                    yield half.select(["a", "b"]).filter(pa.array(alike))

    return verify


def _linker(n: int, threshold: float):
    def link(group: pa.Table) -> pa.Table:
        group = group.select(["node", "root", "body"]).sort_by("node").combine_chunks()
        nodes, roots = group["node"].to_numpy(), group["root"].to_numpy()
        doc, runs, weight = weighted_runs(words_of(*buffer(group["body"].combine_chunks())), n)
        found = list(_links(doc, runs, weight, roots, threshold))
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(nodes[a], pa.int64()), "b": pa.array(nodes[b], pa.int64())})

    return link


def _links(doc: np.ndarray, runs: np.ndarray, weight: np.ndarray, roots: np.ndarray,
           threshold: float) -> Iterator[tuple[int, int]]:
    """Similar pairs that join components; pairs already joined are passed over.

    With P and Q for the shares of two texts that lie in shared runs, the similarity is at most 1 / (1/P + 1/Q - 1).
    """
    size = len(roots)
    share = weight / np.bincount(doc, weight, minlength=size)[doc]
    _, run = np.unique(runs, return_inverse=True)
    order = np.argsort(run, kind="stable")
    holders, first = doc[order], np.searchsorted(run[order], np.arange(run.max() + 2)) if len(run) else np.zeros(1, int)
    edge = np.searchsorted(doc, np.arange(size + 1))
    _, group = np.unique(roots, return_inverse=True)
    rest = np.flatnonzero(group != np.bincount(group).argmax())  # any pair to compare has one of these
    held = share[order]
    for i in rest:
        own = slice(edge[i], edge[i + 1])
        begin, length = first[run[own]], np.diff(first)[run[own]]
        place = np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        mine = np.bincount(holders[place], np.repeat(share[own], length), minlength=size)
        theirs = np.bincount(holders[place], held[place], minlength=size)
        with np.errstate(divide="ignore"):
            bound = 1 / (1 / mine + 1 / theirs - 1)
        for j in np.flatnonzero((bound >= threshold - 1e-9) & (group != group[i])):
            if group[i] == group[j]:
                continue
            other = slice(edge[j], edge[j + 1])
            if _similarity(runs[own], weight[own], runs[other], weight[other]) >= threshold - 1e-9:
                group[group == group[j]] = group[i]
                yield i, j


def _similarity(a: np.ndarray, v: np.ndarray, b: np.ndarray, w: np.ndarray) -> float:
    both = np.union1d(a, b)
    x, y = np.zeros(len(both)), np.zeros(len(both))
    x[np.searchsorted(both, a)], y[np.searchsorted(both, b)] = v, w
    return float(probability_jaccard(np.zeros(len(both), np.int64), x, y, 1)[0])
