"""Language model scoring with a probabilistic suffix tree.

Texts are lower-cased (A-Z) and read as words, each followed by a space, then one end. The tree's symbols are bytes (the
62 most frequent ones, the end and one class for the others). A context of up to ``DEPTH`` symbols is a candidate if at
least a ``LEAST_SHARE`` of all symbols follow it, and stays if its next-symbol distribution diverges from the one of its
longest suffix by more than the cost of storing it (count x divergence against half of log count for each next symbol),
or if a longer context needs it. Distributions are smoothed with the suffix's. Each symbol is scored in the state of the
longest suffix that the tree holds.

With p for the chance that the tree gives the spelling of a word after the bytes before it, a word's probability is
``SPELLED`` p + (1 - ``SPELLED``) (max(c - d, 0) + d V p) / N, its discounted count in the N training words where the mass
of the V discounts d goes by spelling too. So the score is a probability over all words, seen or not.

Counts cover all training texts: words and byte runs are summed in tasks and then by Spark. Words with at least
``N / FREQUENT`` occurrences, of which there are at most ``FREQUENT``, travel to the tasks; every other token is joined
with its count by the word's 64-bit hash. The candidates of the tree are at most ``1 / LEAST_SHARE`` a depth.

Nulls and empty texts are one end. Repeated rows are scored alike and each come back; a null id is held out or not as
given. Without training texts every count is 0 and the tree is uniform. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetloom.llm.words import Words, buffer, pieces, single_spaced, word_hashes, words_of
from assetloom.session import checkpointed

DEPTH = 5
LEAST_SHARE = 2.0**-18
FREQUENT = 1 << 21
DISCOUNT = 0.75
SPELLED = 0.5
PRIOR = 10.0
_BITS, _SYMBOLS, _END = 6, 64, 0x0A
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def suffix_tree_scores(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col, n_tokens, n_known, train_tokens, base_score, score``; ``training`` marks what to learn from."""
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("row"), training.alias("learn"))
    counted = checkpointed(rows.where("learn").mapInArrow(_count, "kind int, key long, n long").groupBy(
        "kind", "key").agg(F.sum("n").alias("n")))
    totals = {r["kind"]: r for r in counted.groupBy("kind").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    n, v = (totals[0]["n"], totals[0]["v"]) if 0 in totals else (0, 0)
    counts = counted.where("kind = 0").select("key", F.col("n").alias("c"))
    often = counts.where(F.col("c") * FREQUENT >= n).toArrow()
    order = np.argsort(often["key"].to_numpy())
    model = (often["key"].to_numpy()[order], often["c"].to_numpy()[order].astype(np.float64), n, v,
             *_tree(counted.where("kind = 1")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(rows.dtypes)["doc"]
    parts = rows.mapInArrow(_scorer(shared), f"doc {kind}, row long, heads long, key long, spelled double, "
                            "n_tokens long, n_known long, base double, score double")
    looked_up = parts.join(counts.withColumn("heads", F.lit(0).cast("long")), ["heads", "key"], "left")
    c = F.coalesce(F.col("c"), F.lit(0))
    rare = F.col("heads") == 0
    base = F.log10((c + 0.5) / F.lit(n + 0.5 * (v + 1)))
    by_count, by_spelling = _shares(n, v)
    counted_share = F.greatest(c - DISCOUNT, F.lit(0.0)) * by_count
    word = F.when(counted_share > 0, F.log10(counted_share + F.lit(by_spelling) * F.pow(F.lit(10.0), "spelled"))
                  ).otherwise(F.col("spelled") + float(np.log10(by_spelling)))
    summed = looked_up.groupBy("doc", "row").agg(
        F.sum("heads").alias("copies"), F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.when(rare, (c > 0).cast("long")).otherwise(F.col("n_known"))).alias("n_known"),
        F.sum(F.when(rare, base).otherwise(F.col("base"))).alias("base"),
        F.sum(F.when(rare, word).otherwise(F.col("score"))).alias("score"))
    each = summed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select(
        F.col("doc").alias(id_col), (F.col("n_tokens") / F.col("copies")).cast("long").alias("n_tokens"),
        (F.col("n_known") / F.col("copies")).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"), (F.col("score") / F.col("copies")).alias("score"))


def _shares(n: int, v: int) -> tuple[float, float]:
    """What a discounted count and the spelling are multiplied with."""
    if not n:
        return 0.0, 1.0
    return (1 - SPELLED) / n, SPELLED + (1 - SPELLED) * DISCOUNT * v / n


def _lower_words(texts: pa.Array) -> Words:
    data, offsets = buffer(texts)
    return words_of(_LOWER[data], offsets)


def _end_hash() -> np.int64:
    return word_hashes(words_of(np.array([_END + 128], np.uint8), np.array([0, 1]))).view(np.int64)[0]


def spelled(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as bytes: DEPTH ends, the words with a space after each, an end. Also which bytes are not the ends
    before a text, where each token begins (an end is the last token of its text) and the text of each token."""
    joined, left, _ = single_spaced(words)
    texts = len(words.first) - 1
    edge = np.concatenate([left, [len(joined)]])[words.first]
    length = np.diff(edge)
    begin = np.cumsum(length + DEPTH + 1) - length - 1
    out = np.full(int((length + DEPTH + 1).sum()), _END, np.uint8)
    place = np.repeat(begin - edge[:-1], length) + np.arange(len(joined))
    out[place] = np.frombuffer(joined, np.uint8)
    symbols = np.ones(len(out), bool)
    symbols[(begin[:, None] - np.arange(1, DEPTH + 1)).ravel()] = False
    starts = np.concatenate([left + (begin - edge[:-1])[words.doc], begin + length])
    owner = np.concatenate([words.doc, np.arange(texts)])
    order = np.argsort(starts, kind="stable")
    return out, symbols, starts[order], owner[order]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (kind 0) and runs of DEPTH + 1 bytes (kind 1) of a batch with their counts."""
    end = _end_hash()
    for batch in batches:
        found: tuple[list, list] = ([], [])
        for piece in pieces(batch, "body"):
            words = _lower_words(piece.column("body"))
            text, symbols, _, _ = spelled(words)
            runs = np.zeros(len(text) - DEPTH, np.uint64)
            for j in range(DEPTH + 1):
                runs = (runs << np.uint64(8)) | text[j : j + len(runs)]
            tokens = np.concatenate([word_hashes(words).view(np.int64), np.full(piece.num_rows, end)])
            for kind, keys in enumerate((tokens, runs[symbols[DEPTH:]].view(np.int64))):
                found[kind].append(np.unique(keys, return_counts=True))
        for kind, some in enumerate(found):
            if some:
                keys, n = _summed(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(n)],
                    names=["kind", "key", "n"])


def _summed(some: list) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate([x[k] for x in some]) for k in (0, 1))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[heads], np.add.reduceat(n, heads).astype(np.int64)


def _tree(runs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Class and extra cost of each byte, the states before each symbol, and the log10 of the next symbols."""
    by_byte = {int(r["b"]): int(r["n"]) for r in runs.groupBy((F.col("key").bitwiseAND(255)).alias("b")).agg(
        F.sum("n").alias("n")).collect()}
    common = [_END] + sorted((b for b in by_byte if b != _END), key=lambda b: (-by_byte[b], b))[: _SYMBOLS - 2]
    symbol = np.full(256, _SYMBOLS - 1)
    symbol[common] = np.arange(len(common))
    cost = np.where(symbol == _SYMBOLS - 1, -np.log10(max(1, 256 - len(common))), 0.0)
    table = F.array(*[F.lit(int(x)) for x in symbol])
    code = F.lit(0).cast("long")
    for j in range(DEPTH, 0, -1):  # the oldest symbol in the highest bits
        byte = F.shiftright("key", 8 * j).bitwiseAND(255).cast("int")
        code = F.shiftleft(code, _BITS).bitwiseOR(F.get(table, byte).cast("long"))
    coded = runs.select(code.alias("context"), F.get(table, F.col("key").bitwiseAND(255).cast("int")).alias("next"),
                        "n").groupBy("context", "next").agg(F.sum("n").alias("n"))
    depths = F.explode(F.sequence(F.lit(0), F.lit(DEPTH)))
    suffix = F.expr(f"context & (shiftleft(1L, {_BITS} * depth) - 1)")
    spread = coded.withColumn("depth", depths).withColumn("context", suffix).groupBy("depth", "context", "next").agg(
        F.sum("n").alias("n"))
    total = sum(by_byte.values())
    large = spread.groupBy("depth", "context").agg(F.sum("n").alias("of"), F.collect_list(
        F.struct("next", "n")).alias("nexts")).where(F.col("of") >= F.lit(total * LEAST_SHARE))
    candidates = large.select("depth", "context", F.inline("nexts")).toArrow()
    return symbol, cost, *_grown(*(candidates[c].to_numpy() for c in ("depth", "context", "next", "n")))


def _grown(depths: np.ndarray, contexts: np.ndarray, nexts: np.ndarray, n: np.ndarray) -> tuple:
    """Keep the contexts that diverge from their suffix, and those on the way to one; number them, smooth them."""
    keys, row_of = np.unique(np.stack([depths.astype(np.int64), contexts]), axis=1, return_inverse=True)
    rows = np.zeros((keys.shape[1], _SYMBOLS))
    np.add.at(rows, (row_of.ravel(), nexts), n)
    counts = {(int(d), int(c)): row for d, c, row in zip(*keys, rows)}
    if not counts:
        return np.full((1, _SYMBOLS), -1, np.int32), np.full((1, _SYMBOLS), -np.log10(_SYMBOLS), np.float32)
    wanted = {(0, 0)}
    for depth, context in sorted(counts, reverse=True):
        row = counts[depth, context]
        up = depth - 1, context & ((1 << _BITS * (depth - 1)) - 1) if depth else 0
        if depth and ((depth, context) in wanted or _diverges(row, counts[up])):
            wanted |= {(depth, context), up}
    states = sorted(wanted)
    number = {s: i for i, s in enumerate(states)}
    before = np.full((len(states), _SYMBOLS), -1, np.int32)
    chance = np.zeros((len(states), _SYMBOLS))
    for i, (depth, context) in enumerate(states):
        row = counts[depth, context]
        if not depth:
            chance[i] = (row + 0.5) / (row.sum() + 0.5 * _SYMBOLS)
            continue
        up = number[depth - 1, context & ((1 << _BITS * (depth - 1)) - 1)]
        chance[i] = (row + PRIOR * chance[up]) / (row.sum() + PRIOR)
        before[up, context >> _BITS * (depth - 1)] = i
    return before, np.log10(chance).astype(np.float32)


def _diverges(row: np.ndarray, up: np.ndarray) -> bool:
    here = row > 0
    p, q = row[here] / row.sum(), up[here] / up.sum()
    return row.sum() * float(np.sum(p * np.log(p / q))) > here.sum()


def symbol_scores(text: np.ndarray, symbol: np.ndarray, cost: np.ndarray, before: np.ndarray,
                  chance: np.ndarray) -> np.ndarray:
    """log10 probability of each byte in the state of the longest suffix that the tree holds."""
    classes = symbol[text].astype(np.int32)
    state = np.zeros(len(text), np.int32)
    active = np.arange(len(text))
    flat = before.ravel()
    for back in range(1, DEPTH + 1):
        active = active[active >= back]
        longer = flat[state[active] * _SYMBOLS + classes[active - back]]
        held = longer >= 0
        active = active[held]
        state[active] = longer[held]
    return chance.ravel()[state * _SYMBOLS + classes] + cost[text]


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, n, v, symbol, cost, before, chance = shared.value
        end = _end_hash()
        scale = n + 0.5 * (v + 1)
        by_count, by_spelling = _shares(n, v)
        for batch in batches:
            for piece in pieces(batch, "body", 2 << 20):
                words = _lower_words(piece.column("body"))
                text, _, starts, owner = spelled(words)
                cumulated = np.concatenate([[0.0], np.cumsum(symbol_scores(text, symbol, cost, before, chance),
                                                             dtype=np.float64)])
                last = np.zeros(len(starts), bool)
                last[np.cumsum(words.counts + 1) - 1] = True
                stops = np.concatenate([starts[1:], [len(text)]])
                stops[last] = starts[last] + 1
                spelling = cumulated[stops] - cumulated[starts]
                token = np.empty(len(starts), np.int64)
                token[last], token[~last] = end, word_hashes(words).view(np.int64)
                at = np.minimum(np.searchsorted(keys, token), max(len(keys) - 1, 0))
                often = (keys[at] == token) if len(keys) else np.zeros(len(token), bool)
                done = often | (n == 0)
                c = np.where(often, counts[at], 0.0) if len(keys) else np.zeros(len(token))
                base = np.log10((c + 0.5) / scale)
                share = np.maximum(c - DISCOUNT, 0) * by_count
                own = np.where(share > 0, np.log10(np.maximum(share + by_spelling * 10.0**spelling, 1e-300)),
                               spelling + np.log10(by_spelling))
                texts = piece.num_rows
                add = lambda x: np.bincount(owner, np.where(done, x, 0), minlength=texts)
                heads = [piece.column("doc"), piece.column("row"), pa.array(np.ones(texts, np.int64)),
                         piece.column("row"), pa.nulls(texts, pa.float64()), pa.array(words.counts + 1),
                         pa.array(add(often).astype(np.int64)), pa.array(add(base)), pa.array(add(own))]
                rare = np.flatnonzero(~done)
                mine = pa.array(owner[rare])
                none = pa.array(np.zeros(len(rare)))
                rest = [piece.column("doc").take(mine), piece.column("row").take(mine),
                        pa.array(np.zeros(len(rare), np.int64)), pa.array(token[rare]), pa.array(spelling[rare]),
                        *[pa.array(np.zeros(len(rare), np.int64))] * 2, none, none]
                names = ["doc", "row", "heads", "key", "spelled", "n_tokens", "n_known", "base", "score"]
                yield pa.RecordBatch.from_arrays(heads, names=names)
                yield pa.RecordBatch.from_arrays(rest, names=names)

    return score
