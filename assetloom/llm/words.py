"""Words of whole texts as numpy arrays over one UTF-8 buffer.

A word is a run of bytes other than space and tab to carriage return. Those are single bytes in UTF-8, so texts are
cut without being decoded. Tasks take an Arrow batch in pieces of a few megabytes, which bounds their memory by the
largest single text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

WORD = r"[^\x20\x09-\x0D]+"
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
PIECE_BYTES = 4 << 20
#: Rows of whole texts that travel to a task at a time, unless the session says otherwise.
BATCH_ROWS = 2500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Words that are worked on at a time, which keeps the work space of a task small.
_AT_ONCE = 1 << 16


def small_batches(spark: SparkSession) -> None:
    """Let whole texts travel in batches of ``BATCH_ROWS``, where the session has Spark's own 10,000 rows."""
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def _return_large_arrays() -> None:
    """Let arrays of a megabyte and more go back to the system when they are freed, where the C library can."""
    try:
        ctypes.CDLL(None).mallopt(-3, 1 << 20)
    except (OSError, AttributeError):
        pass


_return_large_arrays()


def thrifty(task: Callable) -> Callable:
    """The task, with unused memory of its Arrow arrays given back after each batch and at its end.

    Arrow's pool keeps freed memory otherwise, and a worker that waits for its next task holds it beside what other stages
    need: 225 MB after a task on passages, 87 MB when given back.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(_given_back(batches))
        pa.default_memory_pool().release_unused()

    return run


def _given_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = np.array(x, np.uint64, ndmin=1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def streams(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    steps = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(steps) | np.uint64(1)


_AT = streams(4096, 1)


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about ``limit`` bytes; a longer text is a slice of its own."""
    _, offsets = buffer(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of texts and where each begins; null is empty."""
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, content = texts.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets.astype(np.int64) - offsets[0]


@dataclass
class Words:
    """start, end: byte places of the words; doc: the text of each word; first: the first word of each text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~SPACES[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    heads = edges[edges < len(data)]
    begins[heads] = inside[heads]
    tails = edges[edges > 0] - 1
    ends[tails] = inside[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, start, end, doc, first)


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.empty(len(words.start), np.uint64)
    for at in range(0, len(out), _AT_ONCE):
        some = slice(at, at + _AT_ONCE)
        out[some] = _hashed(words.data, words.start[some], words.end[some])
    return out


def _hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    length = end - start
    begins = np.cumsum(length) - length
    place = np.repeat(start - begins, length) + np.arange(int(length.sum()))
    within = place - np.repeat(start, length)
    factor = _AT[within & 4095]
    far = within > 4095
    if far.any():
        factor[far] = mixed(within[far]) | np.uint64(1)
    parts = (data[place].astype(np.uint64) + np.uint64(1)) * factor
    return mixed(np.add.reduceat(parts, begins) + length.astype(np.uint64))


def gram_hashes(hashes: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """Hash of each n consecutive words, across text ends too; the caller leaves those out."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, np.uint64)
    for j, factor in enumerate(streams(n, seed)):
        total += hashes[j : j + count] * factor
    return mixed(total)


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """As gram_hashes for long windows, in one pass whatever n is."""
    count = max(0, len(hashes) - n + 1)
    if not count:
        return np.zeros(0, np.uint64)
    base = np.uint64(0x5851F42D4C957F2D)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    powers = np.cumprod(np.full(len(hashes), base))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers)])
    back = np.cumprod(np.full(count, inverse))
    return mixed((sums[n : n + count] - sums[:count]) * back)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def single_spaced(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by one space, and where each begins and ends there."""
    length = words.end - words.start
    start = np.cumsum(length + 1) - (length + 1)
    out = np.full(int((length + 1).sum()), 0x20, np.uint8)
    for at in range(0, len(length), _AT_ONCE):
        size, to = length[at : at + _AT_ONCE], start[at : at + _AT_ONCE]
        target = np.repeat(to - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        out[target] = words.data[target + np.repeat(words.start[at : at + _AT_ONCE] - to, size)]
    return out.tobytes(), start, start + length
