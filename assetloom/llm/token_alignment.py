"""Alignment of two tokenizers: a byte-level BPE (A, of ``tokenizers``) and a sentencepiece BPE (B) over the same text.

Both read a space and the text. Character offsets of A and the byte spans that sentencepiece returns with its pieces (those
of its immutable proto) are coarse cuts; where tokens share a character, or a span does not fit its token (parts of a
multibyte character, byte-fallback tokens), the decoded bytes of the token place the cut. Cuts where tokens of both end
form groups; tokens whose byte ranges overlap are linked.

Neither tokenizer joins a space with what lies before it, so texts are cut there and every distinct stretch of a piece
is encoded once; tokenizers of which that can't be shown from their settings get whole texts. A piece of ``PIECE_BYTES`` is
one stored row: its distinct id pairs, and which pairs its documents hold. Spark adds up the pairs of all pieces, finds
the most frequent partners of each B id, and joins the counts back to the pieces, so what is shuffled are the distinct
pairs of a piece, not tokens. A pair that every piece holds is one row a piece, which adaptive execution splits; the
window over a B id holds at most A's vocabulary.

Texts that are null or empty, or whose joined token bytes differ from a space and the text, have no tokens. Repeated rows
count each; null ids are kept; very long texts are pieces of their own; other columns are not read.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetloom.llm.words import pieces
from assetloom.session import scratch

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
PIECE_BYTES = 16 << 20
#: A pair is A's id times this and B's id.
PAIR = 1 << 31
#: A space that follows what no tokenizer takes for white space, and is not the last character.
_CUT = re.compile(r"(?<=[\w!-~])(?=\x20.)", re.S)
_AT_ONCE = 1 << 14


def aligned_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = BYTE_BPE,
                   piece_bpe: str = PIECE_BPE, digests: bool = True) -> DataFrame:
    """A row per document: ``id_col``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups``.

    ``groups`` are the ids of each group (``a1,a2|b1;a3|b2,b3``), or with ``digests`` their SHA-256 in hexadecimal
    digits, which keeps the stored pieces small. ``n_best`` are the links whose pair is a most frequent one of its B id.
    """
    kind = dict(docs.select(F.col(id_col).alias("doc")).dtypes)["doc"]
    stored = _stored(docs, id_col, text_col, byte_bpe, piece_bpe, digests)
    counts = _counted(stored)
    b = F.col("pair") % PAIR
    best = F.col("n") == F.max("n").over(Window.partitionBy("b"))
    marked = counts.withColumn("b", b).select("pair", (F.col("n") * 2 + best.cast("long")).alias("mark"))
    back = stored.select("piece", F.posexplode("pairs").alias("at", "pair")).join(marked, "pair").groupBy("piece").agg(
        F.collect_list("at").alias("at"), F.collect_list("mark").alias("mark"))
    whole = stored.select("piece", "docs", "numbers", "groups", "links").join(back, "piece", "left")
    schema = (f"doc {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
    return whole.mapInArrow(_summed, schema).withColumnRenamed("doc", id_col)


def pair_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_bpe: str = BYTE_BPE,
                piece_bpe: str = PIECE_BPE) -> DataFrame:
    """``a``, ``b`` and ``n``: how many links of all documents hold this pair of ids."""
    counts = _counted(_stored(docs, id_col, text_col, byte_bpe, piece_bpe, True))
    return counts.select(F.expr(f"pair div {PAIR}").alias("a"), (F.col("pair") % PAIR).alias("b"), "n")


def _counted(stored: DataFrame) -> DataFrame:
    pairs = stored.select(F.explode(F.arrays_zip("pairs", "held")).alias("p"))
    return pairs.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("n"))


def _stored(docs: DataFrame, id_col: str, text_col: str, byte_bpe: str, piece_bpe: str, digests: bool) -> DataFrame:
    """The pieces, written once: a retry or a second reader must meet the same piece numbers."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body"))
    kind = dict(rows.dtypes)["doc"]
    schema = (f"piece long, docs array<{kind}>, numbers binary, groups array<string>, pairs array<long>, "
              "held array<long>, links binary")
    path = scratch(spark, "aligned")
    rows.mapInArrow(_aligner(byte_bpe, piece_bpe, digests), schema).write.option(
        "compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def _aligner(byte_bpe: str, piece_bpe: str, digests: bool):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers_of(byte_bpe, piece_bpe)
        for batch in batches:
            for piece in pieces(batch, "body", PIECE_BYTES):
                numbers, groups, pairs, held, links = _aligned(piece.column("body").to_pylist(), both, digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().int >> 65], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, piece.num_rows], pa.int32()), piece.column("doc")),
                     pa.array([_packed(numbers)], pa.binary()), pa.array([groups], pa.list_(pa.string())),
                     pa.array([pairs], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.int64())),
                     pa.array([_packed(links)], pa.binary())],
                    names=["piece", "docs", "numbers", "groups", "pairs", "held", "links"])

    return align


def _packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays of whole numbers in as few bytes as they need, compressed."""
    parts = []
    for x in arrays:
        small = x.astype(np.min_scalar_type(int(x.max())) if len(x) else np.uint8)
        head = np.array([len(small), small.itemsize], np.int64).tobytes()
        parts.append(head + small.view(np.uint8).reshape(-1, small.itemsize).T.tobytes())
    body = b"".join(parts)
    return len(body).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(body, asbytes=True)


def _unpacked(packed: bytes) -> list[np.ndarray]:
    body = pa.Codec("zstd").decompress(packed[8:], int.from_bytes(packed[:8], "little"), asbytes=True)
    out, at = [], 0
    while at < len(body):
        n, size = np.frombuffer(body, np.int64, 2, at).tolist()
        planes = np.frombuffer(body, np.uint8, n * size, at + 16).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(f"u{size}").ravel().astype(np.int64))
        at += 16 + n * size
    return out


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and whether texts may be cut before spaces."""

    def __init__(self, byte_bpe: str, piece_bpe: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        chars = _byte_characters()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (1 + max(vocabulary.values()))
        for token, k in vocabulary.items():
            self.a_bytes[k] = bytes(chars[c] for c in token)
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(x[3:5], 16)]) if self.b.is_byte(k) else x.replace("▁", " ").encode()
                        for k, x in enumerate(names)]
        self.a_table, self.b_table = _table(self.a_bytes), _table(self.b_bytes)
        with open(byte_bpe, encoding="utf-8") as f:
            settings = json.load(f)
        before = settings.get("pre_tokenizer") or {}
        plain = settings.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex")
        apart = not any(re.search("[^▁]▁", x) for x in names)
        self.cut = bool(plain and apart and not before.get("add_prefix_space") and self._as_it_is())

    def _as_it_is(self) -> bool:
        """Whether B adds one space in front and changes nothing else."""
        probe = "  a \n\t b  ﬁ ½  "
        return b"".join(self.b_bytes[k] for k in self.b.encode(probe)) == b" " + probe.encode()


@lru_cache(maxsize=2)
def tokenizers_of(byte_bpe: str, piece_bpe: str) -> Tokenizers:
    return Tokenizers(byte_bpe, piece_bpe)


def _table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all tokens, their lengths, and where each begins."""
    length = np.array([len(x) for x in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), length, np.cumsum(length) - length


def _byte_characters() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def _aligned(texts: list[str | None], both: Tokenizers, digests: bool):
    """Of a piece: numbers and group texts of its documents, its pairs, how often it holds each, and its links."""
    number: dict[str, int] = {}
    stretches = []
    for text in texts:
        parts = (_CUT.split(" " + text) if both.cut else [" " + text]) if text else []
        stretches.append(np.array([number.setdefault(x, len(number)) for x in parts], np.int64))
    good, counts, groups, link_ends, links = _stretches(list(number), both)
    pairs, code = np.unique(links, return_inverse=True)
    held_by, sizes, times, rows, names = [], [], [], [], []
    used = np.zeros(len(number), np.int64)
    for own in stretches:
        own = own if good[own].all() else own[:0]
        distinct, n = np.unique(own, return_counts=True)
        used[distinct] += n
        held_by.append(distinct)
        times.append(n)
        sizes.append(len(distinct))
        rows.append(counts[:, own].sum(axis=1))
        body = b";".join([groups[k] for k in own.tolist()])
        names.append((hashlib.sha256(body).hexdigest() if digests else body.decode()) if len(own) else "")
    per_link = np.repeat(used, np.diff(np.concatenate([[0], link_ends])))
    held = np.bincount(code, per_link, len(pairs)).astype(np.int64)
    steps = [np.diff(x, prepend=0) for x in held_by]
    links_of = [np.array(sizes, np.int64), np.concatenate([np.zeros(0, np.int64), *steps]),
                np.concatenate([np.zeros(0, np.int64), *times]), np.diff(link_ends, prepend=0), code.astype(np.int64)]
    numbers = np.array(rows, np.int64).reshape(-1, 4).T
    return list(np.ascontiguousarray(numbers)), names, pairs[held > 0], held[held > 0], _without(links_of, held > 0)


def _without(links: list[np.ndarray], kept: np.ndarray) -> list[np.ndarray]:
    """Number the pairs that a document holds; links of stretches that none holds get the number after them."""
    number = np.where(kept, np.cumsum(kept) - 1, kept.sum())
    return [*links[:-1], number[links[-1]]]


def _stretches(texts: list[str], both: Tokenizers):
    """Of distinct stretches: whether the bytes agree, numbers of tokens, groups and links, group texts, and their pairs."""
    good, counts = np.zeros(len(texts), bool), np.zeros((4, len(texts)), np.int64)
    groups: list[bytes] = []
    sizes, pairs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    gc.disable()  # many small lists and no cycles
    for at in range(0, len(texts), _AT_ONCE):
        some = texts[at : at + _AT_ONCE]
        fine, a, b = _encoded(some, both)
        here = slice(at, at + len(some))
        good[here] = fine
        numbers, names, ids = _grouped(a, b, len(some))
        counts[:, here] = numbers
        groups += names
        sizes.append(numbers[3])
        pairs.append(ids)
    gc.enable()
    return good, counts, groups, np.cumsum(np.concatenate(sizes)), np.concatenate(pairs)


def _encoded(texts: list[str], both: Tokenizers):
    """Ids and byte cuts of both tokenizers over the joined stretches; those whose bytes differ have neither."""
    joined = "".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    place = np.concatenate([[0], np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF))])
    chars = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    raw, edges = np.frombuffer(joined.encode(), np.uint8), place[chars]
    a = both.a.encode_batch(texts, add_special_tokens=False)
    a = [_flat([x.ids for x in a]), _flat(chain.from_iterable(x.offsets for x in a))[1].reshape(-1, 2)]
    b = both.b.encode([x[1:] for x in texts], return_type="offset_mapping", return_bytes=True, num_threads=1)
    b = [_flat([x["ids"] for x in b]), _flat(chain.from_iterable(x["offsets"] for x in b))[1].reshape(-1, 2)]
    a[1] = place[chars[:-1][a[0][0]][:, None] + a[1]]
    b[1] = b[1] + (edges[:-1][b[0][0]] + 1)[:, None]
    b[1][np.flatnonzero(np.diff(b[0][0], prepend=-1)), 0] -= 1
    fine = np.ones(len(texts), bool)
    for (own, ids), table in ((a[0], both.a_table), (b[0], both.b_table)):
        fine &= _same_bytes(own, ids, table, raw, edges)
    size = np.where(fine, np.diff(edges), 0)
    shift = edges[:-1] - (np.cumsum(size) - size)
    return fine, *(_cuts(own, ids, spans, table[1], fine, shift)
                   for ((own, ids), spans), table in ((a, both.a_table), (b, both.b_table)))


def _flat(rows) -> tuple[np.ndarray, np.ndarray]:
    """The row of each number of all rows, and the numbers."""
    rows = list(rows)
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.repeat(np.arange(len(rows)), sizes), np.fromiter(chain.from_iterable(rows), np.int64, int(sizes.sum()))


def _same_bytes(own: np.ndarray, ids: np.ndarray, table, raw: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Whether the bytes of a stretch's tokens are the stretch."""
    data, length, first = table
    sizes = np.bincount(own, length[ids], len(edges) - 1).astype(np.int64)
    same = sizes == np.diff(edges)
    some = ids[same[own]]
    n = length[some]
    ends = np.cumsum(n)
    got = data[np.repeat(first[some] - (ends - n), n) + np.arange(int(n.sum()))]
    if same.all():
        unlike = np.flatnonzero(got != raw)
        same[np.searchsorted(edges, unlike, "right") - 1] = False
        return same
    kept = np.repeat(same, np.diff(edges))
    unlike = np.flatnonzero(kept)[got != raw[kept]]
    same[np.searchsorted(edges, unlike, "right") - 1] = False
    return same


def _cuts(own: np.ndarray, ids: np.ndarray, spans: np.ndarray, length: np.ndarray, fine: np.ndarray, shift: np.ndarray):
    """Stretch, id and end of the tokens: the end of the span where it fits the token, else by the tokens' bytes."""
    kept = fine[own]
    own, ids, spans = own[kept], ids[kept], spans[kept] - shift[own[kept]][:, None]
    ends = np.cumsum(length[ids])
    fits = (spans[:, 1] - spans[:, 0] == length[ids]) & (spans[:, 1] == ends)
    return own, ids, np.where(fits, spans[:, 1], ends)


def _grouped(a, b, n: int):
    """Numbers (A tokens, B tokens, groups, links) of n stretches, their group texts and the pairs of their links."""
    (a_own, a_ids, a_ends), (b_own, b_ids, b_ends) = a, b
    cuts = np.union1d(a_ends, b_ends)
    a_at, b_at = np.searchsorted(a_ends, cuts), np.searchsorted(b_ends, cuts)
    link_own = a_own[a_at]
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
    group_own = a_own[np.searchsorted(a_ends, common)]
    numbers = np.array([np.bincount(x, minlength=n) for x in (a_own, b_own, group_own, link_own)])
    size = len(a_ids) + len(b_ids)
    ids, mark = np.empty(size, np.int64), np.full(size, ord(","), np.uint8)
    a_last, b_last = np.searchsorted(a_ends, common) + 1, np.searchsorted(b_ends, common) + 1
    a_to = np.arange(len(a_ids)) + np.concatenate([[0], b_last])[a_group]
    b_to = np.arange(len(b_ids)) + a_last[b_group]
    ids[a_to], ids[b_to] = a_ids, b_ids
    mark[a_to[a_last - 1]], mark[b_to[b_last - 1]] = ord("|"), ord(";")
    body, ends = _decimal(ids, mark)
    last = np.concatenate([[0], ends])[np.cumsum(numbers[0] + numbers[1])]
    first = np.concatenate([[0], last[:-1]])
    names = [body[p : q - 1] if t else b"" for p, q, t in zip(first.tolist(), last.tolist(), numbers[0].tolist())]
    return numbers, names, a_ids[a_at] * PAIR + b_ids[b_at]


def _decimal(ids: np.ndarray, mark: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Decimal digits of the ids, each followed by its mark, and where each ends."""
    width = np.ones(len(ids), np.int64)
    for power in range(1, 10):
        width += ids >= 10**power
    ends = np.cumsum(width + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = mark
    rest = ids.copy()
    for k in range(int(width.max()) if len(width) else 0):
        some = width > k
        out[ends[some] - 2 - k] = 48 + rest[some] % 10
        rest //= 10
    return out.tobytes(), ends


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each piece with what their links' pairs count in all pieces."""
    for batch in batches:
        for i in range(batch.num_rows):
            at, mark = (np.asarray(batch.column(c)[i].as_py() or [], np.int64) for c in ("at", "mark"))
            docs = batch.column("docs")[i].values
            n_a, n_b, n_groups, n_links = _unpacked(batch.column("numbers")[i].as_py())
            sizes, steps, times, link_sizes, code = _unpacked(batch.column("links")[i].as_py())
            marks = np.zeros(len(at) + 1, np.int64)
            marks[at] = mark
            ends = np.concatenate([[0], np.cumsum(link_sizes)])
            sums = np.concatenate([[0], np.cumsum(marks[code] // 2)])
            bests = np.concatenate([[0], np.cumsum(marks[code] % 2)])
            edges = np.concatenate([[0], np.cumsum(sizes)])
            held = _undone(steps, edges)
            count, best = np.diff(sums[ends])[held] * times, np.diff(bests[ends])[held] * times
            whole = [np.diff(np.concatenate([[0], np.cumsum(x)])[edges]) for x in (best, count)]
            yield pa.RecordBatch.from_arrays(
                [docs, *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links, *whole)),
                 batch.column("groups")[i].values],
                names=["doc", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])


def _undone(steps: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The numbers of which each document's steps are the differences."""
    total = np.cumsum(steps)
    before = np.concatenate([[0], total])[edges[:-1]]
    return total - np.repeat(before, np.diff(edges))
