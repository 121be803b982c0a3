"""Benchmark decontamination: every training passage is a BM25 query against an inverted index of the test items.

An item is indexed in parts of at most ``PART_WORDS`` words. A posting is the BM25 weight of a term in a part over the
score that the part has against itself, so one threshold serves short and long items. Documents are read in passages of
``PASSAGE_WORDS`` words that overlap by half. The most frequent terms add at most ``FREQUENT_SHARE`` of the threshold to
any part; a batch of passages first adds up the postings of the other terms, and a passage that stays too low for every
part even with those terms has no pivot. The others run block-max WAND and retrieve every part above the threshold. A
retrieved item counts as found where the document also holds enough of the word runs of its question and of its answer;
without such columns, of a retrieved part, which for items of at most ``PART_WORDS`` words is the whole item.

Words are runs of letters and digits, A-Z in lower case. The index is cut into shards of ``SHARD_POSTINGS`` postings, one
pass each, so what the driver and a task hold does not grow with the benchmark: of several shards the hits of one are
written before the next is read; a shard's postings are broadcast as arrays. No row of the documents is shuffled.

Repeated items are indexed once, and ids of any type are kept as they are; items that share an id are reported together,
those with a null id each for itself. Nulls and empty texts hold no passage; items without words are never found. Repeated
documents are reported again. Columns other than the ids and texts are not read.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetloom.llm.words import buffer, gram_hashes, pieces, small_batches, thrifty, word_hashes, words_of
from assetloom.session import checkpointed

PART_WORDS, PASSAGE_WORDS = 48, 64
SHARD_POSTINGS = 2_000_000
BLOCK = 32
FREQUENT_SHARE = 0.8
RUN = 3

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
for _c in range(128):
    if not chr(_c).isalnum():
        _PLAIN[_c] = 0x20


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", question_col: str | None = None,
                 answer_col: str | None = None, threshold: float = 0.5, overlap: float = 0.7) -> DataFrame:
    """A row for each document and item found in it: ids, ``score`` of the best passage, ``n_passages``,
    ``question_overlap`` and ``answer_overlap`` (shares of word runs in the document).

    With an answer column alone the question is the text without as many last characters. Without both columns
    ``question_overlap`` is that of the retrieved part which the document holds best, and ``answer_overlap`` is 1.
    """
    small_batches(docs.sparkSession)
    body = F.coalesce(item_text_col, F.lit(""))
    answer = F.coalesce(answer_col, F.lit("")) if answer_col else F.lit("")
    question = F.coalesce(question_col, F.lit("")) if question_col else F.left(
        body, F.length(body) - F.length(answer)) if answer_col else F.lit(None).cast("string")
    entries = items.select(F.col(item_col).alias("item"), body.alias("body"), question.alias("question"),
                           answer.alias("answer")).distinct()
    number = F.sha2(F.to_json(F.struct("item", "body", "question", "answer")), 256)
    postings = _postings(entries.withColumn("number", number))
    item_kind = dict(entries.dtypes)["item"]
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body"))
    kind = dict(rows.dtypes)["doc"]
    found = None
    shards = 1 + int(postings.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0])
    for shard in range(shards):
        held = postings.where(F.col("shard") == shard).drop("shard").toArrow()
        shared = docs.sparkSession.sparkContext.broadcast(_written(held))
        part = rows.mapInArrow(
            thrifty(_searcher(shared, uuid.uuid4().hex, threshold, overlap)), f"doc {kind}, item {item_kind}, "
            "score double, n_passages int, question_overlap double, answer_overlap double")
        part = checkpointed(part) if shards > 1 else part
        found = part if found is None else found.unionByName(part)
    return found.withColumnsRenamed({"doc": id_col, "item": item_col})


def _postings(entries: DataFrame, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """``item, part, shard`` with the term hashes and weights of the part and the runs of question and answer."""
    kind = dict(entries.dtypes)["item"]
    parts = checkpointed(entries.mapInArrow(
        thrifty(_parts), f"number string, item {kind}, part int, terms array<long>, counts array<int>, length int, "
        "question array<long>, answer array<long>"))
    whole = parts.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"), F.sum(F.size("terms")).alias("p"))
    n, mean, total = whole.first()
    exploded = parts.select("number", "part", "length", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select(
        "number", "part", "length", F.col("t.terms").alias("term"), F.col("t.counts").alias("tf"))
    rarity = exploded.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        "term", F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    weight = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.lit(mean)))
    scored = exploded.join(rarity, "term").withColumn("weight", weight).groupBy("number", "part").agg(
        F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("w"))
    self_score = F.aggregate("w.weight", F.lit(0.0), lambda a, x: a + x)
    shards = max(1, -(-int(total or 0) // SHARD_POSTINGS))
    whole = scored.join(parts.select("number", "item", "part", "question", "answer"), ["number", "part"])
    return checkpointed(whole.select(
        "number", "item", "part", F.pmod(F.xxhash64("number"), F.lit(shards)).alias("shard"), F.col("w.term").alias("terms"),
        F.transform("w.weight", lambda x: x / self_score).alias("weights"), "question", "answer"))


def _plain_words(texts: pa.Array):
    data, offsets = buffer(texts)
    return words_of(_PLAIN[data], offsets)


def _runs(texts: pa.Array) -> list[np.ndarray]:
    """The word runs of each text."""
    words = _plain_words(texts)
    hashes = word_hashes(words)
    return [_runs_of(hashes[a:b]) for a, b in zip(words.first[:-1], words.first[1:])]


def _runs_of(hashes: np.ndarray) -> np.ndarray:
    """The word runs; all words as one run where there are fewer."""
    size = min(RUN, len(hashes))
    return np.unique(gram_hashes(hashes, size)).view(np.int64) if size else np.zeros(0, np.int64)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = _plain_words(batch.column("body"))
        hashes = word_hashes(words)
        questions, answers = _runs(batch.column("question")), _runs(batch.column("answer"))
        whole = batch.column("question").is_null().to_pylist()
        rows, at = [], []
        for i, number in enumerate(batch.column("number").to_pylist()):
            own = hashes[words.first[i] : words.first[i + 1]]
            if not len(own):
                continue
            for k, some in enumerate(np.array_split(own, -(-len(own) // PART_WORDS))):
                terms, counts = np.unique(some, return_counts=True)
                question = _runs_of(some) if whole[i] else questions[i]
                rows.append((number, k, terms.view(np.int64), counts, len(some), question, answers[i]))
                at.append(i)
        if rows:
            kinds = (pa.string(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(),
                     pa.list_(pa.int64()), pa.list_(pa.int64()))
            number, *others = (pa.array(c, t) for c, t in zip(zip(*rows), kinds))
            yield pa.RecordBatch.from_arrays([number, batch.column("item").take(pa.array(at)), *others], names=[
                "number", "item", "part", "terms", "counts", "length", "question", "answer"])


def _written(held: pa.Table) -> bytes:
    """A table as one buffer."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, held.schema) as stream:
        stream.write_table(held)
    return out.getvalue().to_pybytes()


@lru_cache(maxsize=2)
def _read(shared, mark: str, threshold: float) -> _Index:
    """The index of a shard, built once in each worker."""
    return _Index(pa.ipc.open_stream(shared.value).read_all(), threshold)


class _Index:
    """Postings by term in order of the part, with the largest weight of each block and term."""

    def __init__(self, held: pa.Table, threshold: float = 0.5) -> None:
        self.item = held["item"].combine_chunks()
        #: Parts of one id, or of one item where the id is null, are one owner.
        owners: dict[tuple, int] = {}
        names = zip(self.item.to_pylist(), held["number"].to_pylist())
        self.owner = [owners.setdefault((number if item is None else "", item), len(owners)) for item, number in names]
        self.question, self.answer = ([np.array(x.as_py(), np.int64).view(np.uint64) for x in held[c]]
                                      for c in ("question", "answer"))
        lengths = [len(x) for x in held["terms"]]
        terms = held["terms"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        weights = held["weights"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        parts = np.repeat(np.arange(len(lengths)), lengths)
        order = np.lexsort((parts, terms))
        self.vocabulary, first = np.unique(terms[order], return_index=True)
        self.parts = [x.tolist() for x in np.split(parts[order], first[1:])] if len(first) else []
        self.weights = [x.tolist() for x in np.split(weights[order], first[1:])] if len(first) else []
        self.largest = np.array([max(x) for x in self.weights])
        self.block_largest = [[max(x[i : i + BLOCK]) for i in range(0, len(x), BLOCK)] for x in self.weights]

        self._split_by_frequency(FREQUENT_SHARE * threshold)

    def _split_by_frequency(self, most: float) -> None:
        """Lay out the postings of the infrequent terms; ``common`` is what the frequent ones add to a part, ``most`` at most."""
        self.common = np.zeros(len(self.item))
        held = np.array([len(x) for x in self.parts], np.int64)
        for t in np.argsort(-held, kind="stable"):
            more = self.common.copy()
            more[self.parts[t]] += self.weights[t]
            if more.max() > most:
                break
            self.common, held[t] = more, 0
        kept = [t for t in range(len(held)) if held[t]]
        self.held, self.first = held, np.cumsum(held) - held
        self.held_part = np.array([x for t in kept for x in self.parts[t]], np.int64)
        self.held_weight = np.array([x for t in kept for x in self.weights[t]])

    def terms_of(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each word in the vocabulary; -1 for others."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: every part whose score reaches the threshold."""
        end, out = len(self.item), []
        cursors = [[self.parts[t][0], 0, t, float(self.largest[t])] for t in terms]
        while True:
            cursors.sort()
            total, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                if c[0] == end:
                    break
                total += c[3]
                if total >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                return out
            part = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == part:
                pivot += 1
            bound, skip = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else end
            for c in cursors[: pivot + 1]:
                own = self.parts[c[2]]
                block = bisect_left(own, part, c[1]) // BLOCK
                if block < len(self.block_largest[c[2]]):
                    bound += self.block_largest[c[2]][block]
                    last = min((block + 1) * BLOCK, len(own)) - 1
                    skip = min(skip, own[last] + 1)
            if bound < threshold:
                self._forward(cursors[: pivot + 1], max(skip, part + 1))
            elif cursors[0][0] == part:
                score = sum(self.weights[c[2]][c[1]] for c in cursors[: pivot + 1])
                if score >= threshold:
                    out.append((part, score))
                self._forward(cursors[: pivot + 1], part + 1)
            else:
                self._forward(cursors[:pivot], part)

    def _forward(self, cursors: list[list], part: int) -> None:
        for c in cursors:
            own = self.parts[c[2]]
            c[1] = bisect_left(own, part, c[1])
            c[0] = own[c[1]] if c[1] < len(own) else len(self.item)


def _searcher(shared, mark: str, threshold: float, overlap: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index = _read(shared, mark, threshold)
            for piece in pieces(batch, "body", 1 << 20):
                found = list(_found(piece, index, threshold, overlap))
                if found:
                    at, part, *columns = zip(*found)
                    kinds = (pa.float64(), pa.int32(), pa.float64(), pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [piece.column("doc").take(pa.array(at)), index.item.take(pa.array(part)), *(pa.array(c, t) for c, t in zip(columns, kinds))],
                        names=["doc", "item", "score", "n_passages", "question_overlap", "answer_overlap"])

    return search


def _found(piece: pa.RecordBatch, index: _Index, threshold: float, overlap: float) -> Iterator[tuple]:
    words = _plain_words(piece.column("body"))
    hashes = word_hashes(words)
    terms = index.terms_of(hashes)
    if not len(terms) or not len(index.largest):
        return
    half = PASSAGE_WORDS // 2
    steps = np.maximum(1, -(-words.counts // half) - 1) * (words.counts > 0)
    before = np.cumsum(steps) - steps
    best: dict[tuple[int, int], list] = {}
    for i in _promising(words, terms, index, threshold, steps, before):
        d = int(np.searchsorted(before, i, "right")) - 1
        start = words.first[d] + half * (i - before[d])
        own = np.unique(terms[start : min(start + PASSAGE_WORDS, words.first[d + 1])])
        own = own[own >= 0]
        for part, score in index.search(own.tolist(), threshold):
            entry = best.setdefault((d, index.owner[part]), [0.0, 0, set()])
            entry[0], entry[1] = max(entry[0], score), entry[1] + 1
            entry[2].add(part)
    for (d, _), (score, passages, parts) in best.items():
        own = hashes[words.first[d] : words.first[d + 1]]
        shares = max(([_share(wanted, own) for wanted in (index.question[part], index.answer[part])]
                      for part in sorted(parts)), key=min)
        if min(shares) >= overlap:
            yield d, min(parts), score, passages, *shares


def _promising(words, terms: np.ndarray, index: _Index, threshold: float, steps: np.ndarray,
               before: np.ndarray) -> np.ndarray:
    """Passages that could reach the threshold for some part."""
    at = np.flatnonzero(terms >= 0)
    at = at[index.held[terms[at]] > 0]
    count = index.held[terms[at]]
    place = np.repeat(index.first[terms[at]] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    at = np.repeat(at, count)
    doc = words.doc[at]
    late = np.minimum((at - words.first[doc]) // (PASSAGE_WORDS // 2), steps[doc] - 1)
    early = np.maximum((at - words.first[doc]) // (PASSAGE_WORDS // 2) - 1, 0)
    both = np.flatnonzero(early < late)
    entry = np.concatenate([np.arange(len(at)), both])
    passage = before[doc[entry]] + np.concatenate([late, early[both]])
    key = passage * len(index.item) + index.held_part[place[entry]]
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    if not len(heads):
        return heads
    total = np.add.reduceat(index.held_weight[place[entry]][order], heads)
    passage, part = np.divmod(key[heads], len(index.item))
    return np.unique(passage[total + index.common[part] >= threshold - 1e-9])


def _share(wanted: np.ndarray, hashes: np.ndarray) -> float:
    """Share of the runs that occur among the words; 1 where there is nothing to find."""
    if not len(wanted):
        return 1.0
    share = 0.0
    for size in range(1, RUN + 1):
        share = max(share, float(np.isin(wanted, gram_hashes(hashes, size)).mean()))
    return share
