"""Periodic runs of words: maximal pairs of a bottom-up LCP-interval tree with left-word class lists.

A run is a stretch of words with smallest period q and at least ``least`` words and ``times`` periods that no
neighbouring word extends. Suffixes of a text are sorted by their words. The intervals of suffixes that share a prefix
are walked bottom-up; each carries its places in order and one list of places for every left word. Where two children
of an interval meet, a place of the smaller child is paired with the places of another left word in the larger one: such
a pair can be extended neither to the left nor to the right. With a prefix of n words and a distance d of at most
n / (times - 1), both copies together are a stretch of period d that nothing extends, so no extension step is needed. A
stretch found at several distances has the least of them as its smallest period.

Work: within that distance all places of a prefix lie at multiples of its smallest period, and only the first of them
can have another left word, so the outermost place on each side names the one class to list. Intervals of less than
``times - 1`` parts in ``times`` of ``least`` words hold no run and are not built, nor are texts without such a repeat.

Every text is worked on where it lies, nothing is shuffled, and memory is bounded by the largest text. Nulls and empty
texts have no words and no runs. Repeated rows and rows with a null id are worked on alike. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetloom.llm.words import buffer, pieces, single_spaced, window_hashes, word_hashes, words_of

_RUNS = "array<struct<start: long, length: long, period: long>>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24,
                  times: int = 3) -> DataFrame:
    """Return ``id_col``, ``n_words``, ``runs`` (by start, then period) and ``collapsed_text``.

    The collapsed text are the words, joined by one space, that no run holds beyond its first period.
    """
    if least < 2 or times < 2:
        raise ValueError("a run has two words and two periods at least")
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body"))
    kind = dict(rows.dtypes)["doc"]
    found = rows.mapInArrow(_finder(least, times), f"doc {kind}, n_words long, runs {_RUNS}, collapsed_text string")
    return found.withColumnRenamed("doc", id_col)


def _finder(least: int, times: int):
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "body"):
                words = words_of(*buffer(piece.column("body")))
                found = _runs_of_texts(words, least, times)
                joined, left, right = single_spaced(words)
                runs, texts = [], []
                for i in range(piece.num_rows):
                    a, b = int(words.first[i]), int(words.first[i + 1])
                    own = found.get(i, [])
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                    texts.append(_collapsed(joined, left[a:b], right[a:b], own))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc"), pa.array(words.counts, pa.int64()), pa.array(runs, pa.list_(run)),
                     pa.array(texts, pa.string())], names=["doc", "n_words", "runs", "collapsed_text"])

    return find


def _collapsed(joined: bytes, left: np.ndarray, right: np.ndarray, runs: list[tuple[int, int, int]]) -> str:
    if not len(left):
        return ""
    if not runs:
        return joined[left[0] : right[-1]].decode("utf-8", "replace")
    gone = np.zeros(len(left) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.cumsum(gone[:-1]) == 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], kept.view(np.int8), [0]])))
    spans = zip(left[edges[::2]].tolist(), right[edges[1::2] - 1].tolist())
    return b" ".join(joined[a:b] for a, b in spans).decode("utf-8", "replace")


def _runs_of_texts(words, least: int, times: int) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, length, period) of the texts that have any."""
    depth = -(-least * (times - 1) // times)
    own = _with_repeats(words, depth)
    if not len(own):
        return {}
    at, ids, doc = _numbered(words, own)
    suffixes, shared = _suffixes(ids, depth)
    left_word = np.concatenate([[-1], ids[:-1]])
    left_word[np.concatenate([[True], doc[1:] != doc[:-1]])] = -1
    pairs = _maximal_pairs(suffixes, shared, left_word.tolist(), depth, least, times)
    best: dict[tuple[int, int], int] = {}
    for i, d, n in pairs:
        key = (i, i + d + n)
        if d < best.get(key, d + 1):
            best[key] = d
    first = dict(zip(own.tolist(), at))
    out: dict[int, list[tuple[int, int, int]]] = {}
    for (begin, end), d in sorted(best.items()):
        k = int(doc[begin])
        out.setdefault(k, []).append((begin - first[k], end - begin, d))
    return {k: sorted(v, key=lambda r: (r[0], r[2])) for k, v in out.items()}


def _with_repeats(words, depth: int) -> np.ndarray:
    """Texts that hold ``depth`` words in a row twice; equal hashes may add a text, never lose one."""
    windows = window_hashes(word_hashes(words), depth)
    doc = words.doc[: len(windows)]
    inside = np.flatnonzero(doc == words.doc[depth - 1 :][: len(windows)]) if len(windows) else np.zeros(0, np.int64)
    keys = np.sort(windows[inside] ^ (doc[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    again = keys[1:][keys[1:] == keys[:-1]]
    if not len(again):
        return np.zeros(0, np.int64)
    whole = windows ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    place = np.minimum(np.searchsorted(again, whole[inside]), len(again) - 1)
    return np.unique(doc[inside[again[place] == whole[inside]]])


def _numbered(words, own: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The words of the chosen texts as numbers, by their bytes and text; each text ends with a number of its own."""
    at, ids, doc, size, seen = [], [], [], 0, 0
    raw = words.data.tobytes()
    for k in own.tolist():
        a, b = int(words.first[k]), int(words.first[k + 1])
        number: dict[bytes, int] = {}
        spans = zip(words.start[a:b].tolist(), words.end[a:b].tolist())
        some = [number.setdefault(raw[p:q], len(number)) for p, q in spans]
        some.append(len(number))
        at.append(size)
        ids.append(np.array(some, np.int64) + seen)
        doc.append(np.full(len(some), k))
        size, seen = size + len(some), seen + len(number) + 1
    return at, np.concatenate(ids), np.concatenate(doc)


def _suffixes(ids: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, as far as they share ``depth`` words with a neighbour, and the words shared with the one before.

    Ranks by 1, 2, 4, ... words; a step sorts again only the suffixes whose rank others have too. A last number is
    unique, so no comparison passes the end of a text.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = _ranks(ids[order], order, np.zeros(n, np.int64))
    levels, step = [rank.astype(np.int32 if n < 1 << 31 else np.int64)], 1
    tied = _tied(rank, order, np.arange(n))
    while len(tied):
        some = order[tied]
        after = rank[np.minimum(some + step, n - 1)]
        by = np.lexsort((after, rank[some]))
        order[tied] = some[by]
        changed = np.concatenate([[True], (np.diff(rank[some[by]]) != 0) | (np.diff(after[by]) != 0)])
        heads = tied[changed]
        rank = rank.copy()
        rank[order[tied]] = heads[np.cumsum(changed) - 1]
        levels.append(rank.astype(levels[0].dtype))
        step *= 2
        tied = _tied(rank, order, tied)
    shared = np.zeros(n, np.int64)
    left, right = order[:-1].copy(), order[1:].copy()
    for k in range(len(levels) - 1, -1, -1):
        inside = np.maximum(left, right) < n
        same = np.zeros(n - 1, bool)
        same[inside] = levels[k][left[inside]] == levels[k][right[inside]]
        shared[1:][same] += 1 << k
        left[same] += 1 << k
        right[same] += 1 << k
    near = shared >= depth
    near[:-1] |= shared[1:] >= depth
    return order[near], shared[near]


def _ranks(keys: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    heads = np.concatenate([[True], keys[1:] != keys[:-1]])
    rank[order] = np.flatnonzero(heads)[np.cumsum(heads) - 1]
    return rank


def _tied(rank: np.ndarray, order: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Places in the order whose suffix shares its rank with a neighbour."""
    own = rank[order[places]]
    twice = np.zeros(len(places), bool)
    same = own[1:] == own[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    return places[twice]


class _Interval:
    """Places of the suffixes of an interval, in order, and the same by left word."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, left: int) -> None:
        self.places = [place]
        self.classes = {left: [place]}


def _maximal_pairs(suffixes: np.ndarray, shared: np.ndarray, left_word: list[int], depth: int, least: int,
                   times: int) -> Iterator[tuple[int, int, int]]:
    """(first place, distance, shared words) of the pairs that make up a run."""
    stack: list[tuple[int, _Interval]] = []
    current = None
    for place, common in zip(suffixes.tolist(), shared.tolist()):
        if current is not None:
            while stack and stack[-1][0] > common:
                words, before = stack.pop()
                current = yield from _merged(before, current, words, left_word, least, times)
            if common < depth:
                current = None
            elif stack and stack[-1][0] == common:
                merged = yield from _merged(stack[-1][1], current, common, left_word, least, times)
                stack[-1] = (common, merged)
            else:
                stack.append((common, current))
        current = _Interval(place, left_word[place])
    while stack:
        words, before = stack.pop()
        current = yield from _merged(before, current, words, left_word, least, times)


def _merged(one: _Interval, two: _Interval, words: int, left_word: list[int], least: int, times: int):
    """Pair the places of two children of an interval, and join their lists."""
    if len(one.places) < len(two.places):
        one, two = two, one
    far = words // (times - 1)
    near = max(1, least - words)
    places, classes = one.places, one.classes
    for own, some in two.classes.items():
        for i in some:
            low, high = bisect_left(places, i - far), bisect_right(places, i + far)
            if low == high:
                continue
            middle = bisect_left(places, i, low, high)
            if low < middle and (c := left_word[places[low]]) != own:
                listed = classes[c]
                for j in listed[bisect_left(listed, i - far) : bisect_left(listed, i)]:
                    if i - j >= near:
                        yield j, i - j, words
            if middle < high and (c := left_word[places[high - 1]]) != own:
                listed = classes[c]
                for j in listed[bisect_right(listed, i) : bisect_right(listed, i + far)]:
                    if j - i >= near:
                        yield i, j - i, words
    for own, some in two.classes.items():
        listed = classes.setdefault(own, [])
        for i in some:
            insort(places, i)
            insort(listed, i)
    return one
