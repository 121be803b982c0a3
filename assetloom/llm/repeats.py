"""Removal of long passages that an earlier document holds, by super-k-mer partitioning.

A window is ``window`` consecutive words. Its minimiser is the smallest hash among the runs of ``minimiser`` words in
it. Consecutive windows with one minimiser travel as one packed string to the bucket of that minimiser, so equal windows
always meet there. In the bucket all windows are sorted and the smallest document of each is found; equal hashes are
compared byte by byte before they count as equal.

Skew: a task sends a packed string once, for the smallest document that holds it; the others are covered at once. A
bucket that is still beyond ``BUCKET_LIMIT`` opens its strings into window digests, which Spark's own aggregation counts
with partial sums, so no task holds more than the limit whatever a passage repeats.

Nulls and empty texts have no words and come back as they are. A null id covers nothing and is covered by nothing.
Repeated rows with one id do not cover each other. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetloom.llm.words import (
    buffer,
    gram_hashes,
    pieces,
    single_spaced,
    sliding_minimum,
    small_batches,
    thrifty,
    window_hashes,
    word_hashes,
    words_of,
)
from assetloom.session import checkpointed

BUCKET_BYTES = 4 << 20
BUCKET_LIMIT = 10 << 20
#: Packed strings hold about this many times the bytes of the texts.
OVERLAP = 3

_PACKED = "bucket long, strings binary, doc array<long>, text array<long>, start array<int>, windows array<int>"
_FOUND = "doc long, text long, start int, windows int, digest binary"


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50,
                             minimiser: int = 5, keep_columns: bool = False) -> DataFrame:
    """Return ``id_col``, ``text_hash``, ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by one space).

    A word goes if a window over it also starts in a document with a smaller id. With ``keep_columns`` the other columns
    come back too, in the same pass over the rows.
    """
    small_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c not in (id_col, text_col)] if keep_columns else []
    carried = [F.struct(F.col(id_col).alias("id"),
                        *[F.col(c).alias(f"c{k}") for k, c in enumerate(rest)]).alias("row")] if keep_columns else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("body"),
                       F.xxhash64(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, -(-int(size) * OVERLAP // BUCKET_BYTES))
    packed = rows.where("doc IS NOT NULL").mapInArrow(thrifty(_packer(window, minimiser, buckets)), _PACKED)
    met = packed.repartition("bucket").sortWithinPartitions("bucket")
    found = checkpointed(met.mapInArrow(thrifty(_resolver(window)), _FOUND))
    opened = found.where("digest IS NOT NULL")
    earliest = opened.groupBy("digest").agg(F.min("doc").alias("earliest"))
    late = opened.join(earliest, "digest").where("doc > earliest")
    spans = found.where("digest IS NULL").select("doc", "text", "start", "windows").unionByName(
        late.select("doc", "text", "start", "windows"))
    by_doc = spans.groupBy("doc", "text").agg(F.collect_list("start").alias("start"),
                                              F.collect_list("windows").alias("windows"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("body"),
                       F.xxhash64(text_col).alias("text"), *carried)
    schema = "doc long, text long, n_words long, n_removed long, kept_text string"
    if carried:
        schema += f", row {rows.schema['row'].dataType.simpleString()}, body string"
    kept = rows.join(by_doc, ["doc", "text"], "left").mapInArrow(thrifty(_cutter(window)), schema)
    if carried:
        return kept.select(F.col("row.id").alias(id_col), F.col("body").alias(text_col),
                           *[F.col(f"row.c{k}").alias(c) for k, c in enumerate(rest)], "n_removed", "kept_text")
    return kept.select(F.col("doc").alias(id_col), F.col("text").alias("text_hash"), "n_words", "n_removed",
                       "kept_text")


def _packer(window: int, size: int, buckets: int):
    schema = pa.schema([("bucket", pa.int64()), ("strings", pa.binary()), ("doc", pa.list_(pa.int64())),
                        ("text", pa.list_(pa.int64())), ("start", pa.list_(pa.int32())),
                        ("windows", pa.list_(pa.int32()))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=3)
        for batch in batches:
            for piece in pieces(batch, "body"):
                rows = list(_packed_rows(piece, window, size, buckets, codec))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return pack


def _packed_rows(piece: pa.RecordBatch, window: int, size: int, buckets: int, codec: pa.Codec) -> Iterator[tuple]:
    ids = piece.column("doc").to_numpy()
    texts = piece.column("text").to_numpy()
    words = words_of(*buffer(piece.column("body")))
    if len(words.start) < window:
        return
    least = sliding_minimum(gram_hashes(word_hashes(words), size), window - size + 1)
    doc = words.doc[: len(least)]
    valid = doc == words.doc[window - 1 :]
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (doc[1:] != doc[:-1]) | (least[1:] != least[:-1])
    at = np.flatnonzero(begins)
    if not len(at):
        return
    run = np.cumsum(begins) - 1
    count = np.bincount(run[valid], minlength=len(at))
    joined, left, right = single_spaced(words)
    spans = zip(left[at].tolist(), right[at + count + window - 2].tolist())
    strings = pa.array([joined[a:b] for a, b in spans], pa.large_binary())
    code = strings.dictionary_encode().indices.to_numpy()
    owner, mark = ids[doc[at]], texts[doc[at]]
    start = at - words.first[doc[at]]
    smallest = np.full(int(code.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(smallest, code, owner)
    late = owner > smallest[code]
    bucket = (least[at] % np.uint64(buckets)).astype(np.int64)
    if late.any():
        yield int(bucket[0]), None, owner[late], mark[late], start[late], count[late]
    sent = np.flatnonzero(~late)
    sent = sent[np.argsort(bucket[sent], kind="stable")]
    edges = np.flatnonzero(np.diff(bucket[sent])) + 1
    for part in np.split(sent, edges):
        body = b"\n".join(strings.take(pa.array(part)).to_pylist())
        head = len(body).to_bytes(8, "little")
        yield (int(bucket[part[0]]), head + codec.compress(body, asbytes=True), owner[part], mark[part], start[part],
               count[part])


def _resolver(window: int):
    schema = pa.schema([("doc", pa.int64()), ("text", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()),
                        ("digest", pa.binary())])

    def table(doc, text, start, count, digest=None) -> pa.RecordBatch:
        digests = pa.nulls(len(doc), pa.binary()) if digest is None else pa.array(digest, pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(text, pa.int64()), pa.array(start).cast(pa.int32()),
             pa.array(count).cast(pa.int32()), digests], schema=schema)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        current, held, size, open_bucket = None, [], 0, False
        for batch in batches:
            for i in range(batch.num_rows):
                bucket = batch.column("bucket")[i].as_py()
                if bucket != current:
                    if held:
                        yield from (table(*x) for x in (_opened if open_bucket else _resolved)(held, window))
                    current, held, size, open_bucket = bucket, [], 0, False
                doc, text, start, count = (batch.column(c)[i].values.to_numpy()
                                           for c in ("doc", "text", "start", "windows"))
                packed = batch.column("strings")[i].as_py()
                if packed is None:
                    yield table(doc, text, start, count)
                    continue
                body = codec.decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)
                held.append((body, doc, text, start))
                size += len(body)
                if size > BUCKET_LIMIT:
                    open_bucket = True
                    yield from (table(*x) for x in _opened(held, window))
                    held, size = [], 0
        if held:
            yield from (table(*x) for x in (_opened if open_bucket else _resolved)(held, window))

    return resolve


def _joined(held: list[tuple]) -> tuple:
    body = b"\n".join(x[0] for x in held)
    data = np.frombuffer(body, np.uint8)
    ends = np.concatenate([np.flatnonzero(data == 0x0A) + 1, [len(data)]])
    words = words_of(data, np.concatenate([[0], ends]))
    return body, words, *(np.concatenate([x[k] for x in held]) for k in (1, 2, 3))


def _windows(words, window: int) -> np.ndarray:
    """First words of the windows that lie in one string."""
    last = len(words.start) - window + 1
    return np.flatnonzero(words.doc[:last] == words.doc[window - 1 :])


def _opened(held: list[tuple], window: int) -> Iterator[tuple]:
    """Every window of the strings with the digest of its bytes."""
    body, words, doc, text, start = _joined(held)
    at = _windows(words, window)
    for some in np.array_split(at, max(1, len(at) // 200_000)):
        digests = [hashlib.sha256(body[a:b]).digest()
                   for a, b in zip(words.start[some].tolist(), words.end[some + window - 1].tolist())]
        own = words.doc[some]
        yield (doc[own], text[own], start[own] + some - words.first[own], np.ones(len(some), np.int32), digests)


def _resolved(held: list[tuple], window: int) -> Iterator[tuple]:
    """Runs of windows that a smaller document of the bucket holds too."""
    body, words, doc, text, start = _joined(held)
    at = _windows(words, window)
    if not len(at):
        return
    own = words.doc[at]
    hashes = window_hashes(word_hashes(words), window)[at]
    order = np.lexsort((doc[own], hashes))
    ordered = hashes[order]
    heads = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    partner = np.empty(len(at), np.int64)
    partner[order] = order[heads][np.cumsum(heads) - 1]
    late = np.flatnonzero(doc[own] > doc[own[partner]])
    if not len(late):
        return
    to = partner[late]
    follows = ((np.diff(late) == 1) & (np.diff(to) == 1) & (np.diff(at[late]) == 1) & (np.diff(at[to]) == 1)
               & (own[late][1:] == own[late][:-1]) & (own[to][1:] == own[to][:-1]))
    begin = np.concatenate([[0], np.flatnonzero(~follows) + 1])
    end = np.concatenate([begin[1:], [len(late)]])
    a, b = at[late[begin]], at[late[end - 1]] + window - 1
    c, d = at[to[begin]], at[to[end - 1]] + window - 1
    places = zip(words.start[a].tolist(), words.end[b].tolist(), words.start[c].tolist(), words.end[d].tolist())
    same = np.fromiter((body[p:q] == body[r:s] for p, q, r, s in places), bool, len(begin))
    yield (doc[own[late[begin[same]]]], text[own[late[begin[same]]]],
           (start[own] + at - words.first[own])[late[begin[same]]], (end - begin)[same])
    for clash in np.unique(hashes[np.concatenate([late[x:y] for x, y in zip(begin[~same], end[~same])])]
                           if not same.all() else []):
        yield from _exactly(np.flatnonzero(hashes == clash), body, words, at, own, doc, text, start, window)


def _exactly(those: np.ndarray, body: bytes, words, at, own, doc, text, start, window: int) -> Iterator[tuple]:
    """Windows of one hash but unlike words, by their bytes."""
    strings = [body[words.start[at[i]] : words.end[at[i] + window - 1]] for i in those]
    smallest: dict[bytes, int] = {}
    for i, s in zip(those, strings):
        smallest[s] = min(smallest.get(s, doc[own[i]]), doc[own[i]])
    late = np.array([i for i, s in zip(those, strings) if doc[own[i]] > smallest[s]], np.int64)
    if len(late):
        mine = own[late]
        yield doc[mine], text[mine], start[mine] + at[late] - words.first[mine], np.ones(len(late), np.int32)


def _cutter(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "body"):
                words = words_of(*buffer(piece.column("body")))
                joined, left, right = single_spaced(words)
                gone = np.zeros(len(words.start) + 1, np.int64)
                lists = piece.column("start")
                own = np.repeat(np.arange(piece.num_rows), lists.value_lengths().fill_null(0).to_numpy())
                first = words.first[own] + lists.flatten().to_numpy()
                np.add.at(gone, first, 1)
                np.add.at(gone, first + piece.column("windows").flatten().to_numpy() + window - 1, -1)
                kept = np.cumsum(gone[:-1]) == 0
                texts = [_text(joined, left, right, kept, a, b)
                         for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())]
                removed = words.counts - np.diff(np.concatenate([[0], np.cumsum(kept)])[words.first])
                carried = ["row", "body"] if "row" in piece.schema.names else []
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc"), piece.column("text"), pa.array(words.counts, pa.int64()),
                     pa.array(removed, pa.int64()), pa.array(texts, pa.string()), *(piece.column(c) for c in carried)],
                    names=["doc", "text", "n_words", "n_removed", "kept_text", *carried])

    return cut


def _text(joined: bytes, left: np.ndarray, right: np.ndarray, kept: np.ndarray, a: int, b: int) -> str:
    """The kept words from a to b of the joined words."""
    edges = np.diff(np.concatenate([[0], kept[a:b].view(np.int8), [0]]))
    runs = zip(left[a + np.flatnonzero(edges == 1)].tolist(), right[a + np.flatnonzero(edges == -1) - 1].tolist())
    return b" ".join(joined[x:y] for x, y in runs).decode("utf-8", "replace")
