"""Hierarchical language identification.

The family is predicted first, then one-versus-one linear support vector machines separate the languages within it.
Features are the relative counts of runs of 2 to 4 letters (bytes in lower case; whatever is not a letter counts as one
space), hashed into ``BINS`` bins. The machines are fitted from at most ``SAMPLE`` labelled documents a language, each
machine as one group of bounded size; every document is then scored where it lies. The sample is chosen by language and
hash alone: each of ``SALTS`` shares of a language keeps its smallest hashes, then the language does, and only the texts
up to the last of these hashes are read. The next ``CALIBRATION`` hashes of each language are not fitted but scored; half
of the least score of a right prediction among them is the score below which a text is in no known language.

Nulls and texts without a letter are ``und`` with score 0. Without labelled rows every text is ``und``, and those with a
letter are accepted. With one language all texts are that one. Null ids count as not held out; repeated rows are scored
alike, and count once in the sample; other columns are not read, only handed on where asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetloom.llm.words import buffer, pieces, small_batches, thrifty
from assetloom.session import checkpointed

SAMPLE = 500
CALIBRATION = 200
SALTS = 64
BINS = 1 << 16
RUNS = (2, 3, 4)
#: Bytes whose runs are held at a time, also of one long text.
_BYTES_AT_ONCE = 1 << 18
#: Languages and the families they belong to. Any other language is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
}
_FAMILY = {language: family for family, members in FAMILIES.items() for language in members}
_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[65:91] += 32
for _c in range(128):
    if not chr(_c).isalpha():
        _LETTERS[_c] = 0x20


def predict_language(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", keep_columns: bool = False) -> DataFrame:
    """Every row of ``docs`` (``id_col``, or with ``keep_columns`` all columns) with ``lang_pred``, ``score`` and
    ``accepted``: whether the text has a letter and scores as texts of the known languages do."""
    small_batches(docs.sparkSession)
    languages, machines, floor = _fitted(labelled, id_col, text_col, lang_col)
    kept = docs.columns if keep_columns else [id_col]
    place = {c: f"row.c{k}" for k, c in enumerate(kept) if c != text_col or not keep_columns} | (
        {text_col: "body"} if keep_columns else {})
    rows = docs.select(F.struct(*[F.col(c).alias(p[4:]) for c, p in place.items() if p != "body"]).alias("row"),
                       F.col(text_col).alias("body"), _written(text_col).alias("written"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    scored = rows.mapInArrow(thrifty(_scorer(languages, machines, keep_columns)), schema + ", body string" * keep_columns)
    accepted = (F.col("score") >= floor) & (F.col("lang_pred") != "und") if languages else _written(text_col)
    if not languages:
        return docs.select(*kept, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), accepted.alias("accepted"))
    return scored.select(*[F.col(place[c]).alias(c) for c in kept], "lang_pred", "score",
                         accepted.alias("accepted"))


def _written(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def _sampled(labelled: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``lang, rank, body`` and ``fitted`` of the texts with the smallest hashes of each language."""
    rows = labelled.where(F.col(lang_col).isNotNull() & _written(text_col)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("body"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("rank"))
    size = SAMPLE + CALIBRATION
    narrow = rows.select("lang", "rank", F.pmod("rank", F.lit(SALTS)).alias("salt"))
    for keys in (("lang", "salt"), ("lang",)):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("rank"))
        narrow = narrow.withColumn("n", place).where(F.col("n") <= size)
    fitted = F.when(F.col("n") <= SAMPLE, F.col("rank"))
    last = narrow.groupBy("lang").agg(F.max("rank").alias("last"), F.max(fitted).alias("fitted")).collect()
    if not last:
        return rows.where("false").withColumn("fitted", F.lit(True))
    up_to, of_fitted = (F.create_map(*[F.lit(x) for r in last for x in (r["lang"], r[c])]) for c in ("last", "fitted"))
    some = rows.where(F.col("rank") <= up_to[F.col("lang")])
    return checkpointed(some.groupBy("lang", "rank").agg(F.min("body").alias("body")).withColumn(
        "fitted", F.col("rank") <= of_fitted[F.col("lang")]))


def _fitted(labelled: DataFrame, id_col: str, text_col: str, lang_col: str):
    """Languages, machines and the least score of a known language."""
    sample = _sampled(labelled, id_col, text_col, lang_col)
    chosen, others = sample.where("fitted"), sample.where("NOT fitted")
    languages = sorted(r["lang"] for r in chosen.select("lang").distinct().collect())
    family = {x: _FAMILY.get(x, x) for x in languages}
    machines = [("family", a, b) for a, b in combinations(sorted(set(family.values())), 2)]
    machines += [("language", a, b) for a, b in combinations(languages, 2) if family[a] == family[b]]
    if not machines:
        return languages, [], 0.0
    wanted = []
    for k, (level, a, b) in enumerate(machines):
        side = family if level == "family" else {x: x for x in languages}
        wanted += [(k, x, 1 if side[x] == a else -1) for x in languages if side[x] in (a, b)]
    plan = chosen.sparkSession.createDataFrame(pd.DataFrame(wanted, columns=["machine", "lang", "side"]))
    fitted = chosen.join(plan, "lang").groupBy("machine").applyInPandas(
        _fit, "machine long, weights binary, bias double").collect()
    models = {r["machine"]: (np.frombuffer(r["weights"], np.float32), r["bias"]) for r in fitted}
    whole = [(*machines[k], *models[k]) for k in range(len(machines))]
    rows = others.select(F.struct("lang").alias("row"), "body", F.lit(True).alias("written"))
    right = rows.mapInArrow(thrifty(_scorer(languages, whole)), "row struct<lang: string>, lang_pred string, score double").where(
        "row.lang = lang_pred")
    least = right.agg(F.min("score")).first()[0]
    return languages, whole, (least or 0.0) / 2


def _bins(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bins of all letter runs, and the text of each, some bytes and one length of runs at a time."""
    data, offsets = buffer(texts)
    for begin in range(0, len(data), _BYTES_AT_ONCE):
        end = min(begin + _BYTES_AT_ONCE, len(data))
        known = max(begin - 1, 0)
        text = _LETTERS[data[known : end + max(RUNS) - 1]]
        after = np.concatenate([[0], text[:-1]])
        text[(after == 0xC3) & (text >= 0x80) & (text <= 0x9E) & (text != 0x97)] += 0x20
        text = text[begin - known :]
        doc = np.searchsorted(offsets, np.arange(begin, begin + len(text)), "right") - 1
        wide = text.astype(np.uint32)
        blank = text == 0x20
        for n in RUNS:
            size = max(0, min(end - begin, len(text) - n + 1))
            gram = np.zeros(size, np.uint32)
            for j in range(n):
                gram = (gram << np.uint32(8)) | wide[j : j + size]
            good = (doc[:size] == doc[n - 1 : n - 1 + size]) & ~(blank[:size] & blank[1 : size + 1])
            gram = gram[good] * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
            gram = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x85EBCA77)
            yield (gram >> np.uint32(16)).astype(np.int32), doc[:size][good]


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    """A linear support vector machine by dual coordinate descent over sparse rows."""
    group = group.sort_values(["lang", "rank", "body"], kind="stable")
    rows, norms = [], []
    for body in group["body"]:
        places, counts = np.unique(np.concatenate(
            [np.zeros(0, np.int32), *(bins for bins, _ in _bins(pa.array([body])))]), return_counts=True)
        values = counts / max(1, counts.sum())
        rows.append((places, values))
        norms.append(float(values @ values) + 1e-4)
    sides = group["side"].to_numpy(np.float64)
    share = np.where(sides > 0, (sides > 0).mean(), (sides < 0).mean())
    limit = 10.0 / (np.mean(norms) * share)
    weights, bias, alpha = np.zeros(BINS), 0.0, np.zeros(len(rows))
    shuffle = np.random.default_rng(20)
    for _ in range(30):
        moved = 0.0
        for i in shuffle.permutation(len(rows)):
            places, values = rows[i]
            slack = sides[i] * (weights[places] @ values + bias * 1e-2) - 1
            new = min(max(alpha[i] - slack / norms[i], 0.0), limit[i])
            step = (new - alpha[i]) * sides[i]
            if step:
                weights[places] += step * values
                bias += step * 1e-2
                moved = max(moved, abs(new - alpha[i]) * norms[i])
                alpha[i] = new
        if moved < 1e-3:
            break
    return pd.DataFrame({"machine": [group["machine"].iloc[0]], "weights": [weights.astype(np.float32).tobytes()],
                         "bias": [bias * 1e-2]})


def _scorer(languages: list[str], machines: list[tuple], keep_body: bool = False):
    family = {x: _FAMILY.get(x, x) for x in languages}

    def decide(margins: dict, choices: list[str], level: str) -> tuple[np.ndarray, np.ndarray]:
        """Votes of the machines of a level; ties go to the larger sum of margins, then to the first."""
        size = next(iter(margins.values())).shape if margins else (0,)
        votes, sums = np.zeros((len(choices), *size)), np.zeros((len(choices), *size))
        sure = np.ones((len(choices), *size))
        for (kind, a, b), margin in margins.items():
            if kind != level or a not in choices or b not in choices:
                continue
            for name, m in ((a, margin), (b, -margin)):
                k = choices.index(name)
                votes[k] += m > 0
                sums[k] += np.tanh(m)
                sure[k] = np.minimum(sure[k], 1 / (1 + np.exp(-2 * np.clip(m, -30, 30))))
        best = (votes + sums / (4 * len(choices))).argmax(axis=0)
        return best, np.take_along_axis(sure, best[None], 0)[0]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "body", 1 << 20):
                n = piece.num_rows
                written = piece.column("written").to_numpy(zero_copy_only=False)
                picked, sure = np.zeros(n, np.int64), np.ones(n)
                if machines:
                    total, sums = np.zeros(n), np.zeros((len(machines), n))
                    for bins, owners in _bins(piece.column("body")):
                        total += np.bincount(owners, minlength=n)
                        for k, m in enumerate(machines):
                            sums[k] += np.bincount(owners, m[3][bins], minlength=n)
                    margins = {m[:3]: sums[k] / np.maximum(1, total) + m[4] for k, m in enumerate(machines)}
                    families = sorted(set(family.values()))
                    top, sure = decide(margins, families, "family")
                    for k, name in enumerate(families):
                        members = [x for x in languages if family[x] == name]
                        low, inner = decide(margins, members, "language")
                        here = top == k
                        picked[here] = np.array([languages.index(x) for x in members])[low[here]]
                        sure = np.where(here, sure * inner, sure)
                known = written & (len(languages) > 0)
                names = np.array([*languages, "und"], object)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("row"), pa.array(names[np.where(known, picked, len(languages))], pa.string()),
                     pa.array(np.where(known, np.clip(sure, 0, 1), 0.0)), *[piece.column("body")] * keep_body],
                    names=["row", "lang_pred", "score", *["body"] * keep_body])

    return score


def held_out(id_col: str, folds: int) -> Column:
    """Whether the checksum of the id leaves 1 over ``folds``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 1, F.lit(False))
