"""The operators against brute force on small fixtures: nulls, empty and very long texts, ties, repeated rows, empty
tables, and extra columns whose names clash with those the operators use inside."""

import collections
import datetime as dt
import hashlib
import html
import json
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assetloom.llm import (
    components,
    decontamination,
    languages,
    mixing,
    near_duplicates,
    outliers,
    page_text,
    repeats,
    suffix_tree,
    tool_calls,
    url_lists,
)
from assetloom.llm.words import buffer, pieces, single_spaced, word_hashes, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, row long, body string, word string"


def words(text):
    return WORD.findall(text or "")


def sentence(rng, n, vocabulary=2000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, rows):
    """Documents with further columns named like inner ones."""
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], DOCS)


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, odd spaces, nulls, empty and very long texts, a repeated row."""
    rng = random.Random(5)
    passage = sentence(rng, 70)
    rows = []
    for i in range(120):
        text = sentence(rng, rng.randrange(1, 160))
        if i % 4 == 0:
            text += " " + passage + "\t\n" + sentence(rng, 20)
        rows.append([i, text, "en" if i % 3 else "de", f"s{i % 4}"])
    base = sentence(rng, 200)
    for k in range(30):  # near copies of one text, more and more unlike
        own = base.split(" ")
        for j in range(k // 3):
            own[(17 * j + k) % 200] = f"edit{k}x{j}"
        rows.append([200 + k, " ".join(own), "en", "s0"])
    rows += [[300 + k, rows[3][1], "en", "s0"] for k in range(25)]
    rows += [[400, None, None, None], [401, "", "en", "s1"], [402, " \t\n", "en", "s1"], [403, "one", "fr", "s2"],
             [404, sentence(rng, 30000, 500), "en", "s3"], [405, "same same same " * 60, "en", "s3"],
             [406, "é ü x\x0b\x0c\x1c b", "de", None]]
    rows += [rows[8]]
    return rows


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return frame(spark, corpus).repartition(4)


@pytest.fixture(scope="module")
def none(spark):
    return frame(spark, [])


def test_words_are_cut_as_the_pattern_does():
    texts = ["a  b\tc", "", None, " lead", "trail \n", "\x0b\x0c", "é x \x1c y", "x", "y"]
    found = words_of(*buffer(pa.array(texts)))
    cut = [[found.data[a:b].tobytes().decode() for a, b in zip(found.start[i:j], found.end[i:j])]
           for i, j in zip(found.first[:-1], found.first[1:])]
    assert cut == [words(t) for t in texts]
    joined, left, right = single_spaced(found)
    assert [joined[a:b].decode() for a, b in zip(left, right)] == [w for t in texts for w in words(t)]
    sliced = pa.record_batch({"body": pa.array(texts)}).slice(3, 5)
    assert [p.num_rows for p in pieces(sliced, "body", 6)] and sum(p.num_rows for p in pieces(sliced, "body", 6)) == 5


def test_word_hashes_follow_the_bytes():
    long = "ab" * 5000
    found = words_of(*buffer(pa.array([f"x y {long} x {long} {long}b y"])))
    h = word_hashes(found).tolist()
    assert h[0] == h[3] and h[1] == h[6] and h[2] == h[4] and len(set(h)) == 4


def brute_repeats(rows, window):
    first = {}
    for i, text, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = words(text)
        for j in range(len(w) - window + 1):
            first.setdefault(tuple(w[j : j + window]), i)
    out = []
    for i, text, *_ in rows:
        w = words(text)
        kept = [True] * len(w)
        for j in range(len(w) - window + 1):
            if i is not None and first[tuple(w[j : j + window])] < i:
                kept[j : j + window] = [False] * window
        out.append((i, len(w), len(w) - sum(kept), " ".join(x for x, k in zip(w, kept) if k)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [12, 50])
def test_repeats(docs, corpus, window):
    got = repeats.remove_repeated_passages(docs, window=window).drop("text_hash").collect()
    assert sorted(map(tuple, got), key=repr) == brute_repeats(corpus, window)


def test_repeats_in_many_small_and_in_open_buckets(docs, corpus, monkeypatch):
    for size, limit in ((2000, 1 << 20), (1 << 20, 3000)):
        monkeypatch.setattr(repeats, "BUCKET_BYTES", size)
        monkeypatch.setattr(repeats, "BUCKET_LIMIT", limit)
        held = [(b"a b c d e\na b c d e f", np.array([1, 2]), np.array([0, 0]), np.array([0, 0]))]
        assert sum(len(x[0]) for x in repeats._opened(held, 5)) == 3
        got = repeats.remove_repeated_passages(docs).drop("text_hash").collect()
        assert sorted(map(tuple, got), key=repr) == brute_repeats(corpus, 50)


def test_repeats_compare_bytes_where_hashes_agree(monkeypatch):
    held = [(b"a b c\nd e f\na b c", np.array([1, 2, 3]), np.zeros(3, int), np.zeros(3, int))]
    monkeypatch.setattr(repeats, "window_hashes", lambda h, n: np.zeros(len(h) - n + 1, np.uint64))
    found = {(int(d), int(s), int(c)) for x in repeats._resolved(held, 3) for d, _, s, c in zip(*x)}
    assert found == {(3, 0, 1)}


def test_repeats_of_nothing(none, spark):
    assert repeats.remove_repeated_passages(none).count() == 0
    rows = [[None, "a b c d e f", "en", "s"], [None, "a b c d e f", "en", "s"], [1, "a b c d e f", "en", "s"]]
    got = repeats.remove_repeated_passages(frame(spark, rows), window=5, minimiser=2)
    assert sorted(r["n_removed"] for r in got.collect()) == [0, 0, 0]


def shingles(text):
    w = words(text)
    return collections.Counter(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else {}


def probability_jaccard(a, b):
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in {*a, *b}) for d in a if d in b)


def brute_classes(rows):
    sets = {i: shingles(t) for i, t, *_ in rows}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and sum((sets[a] & sets[b]).values()) and len(sets[a]) < 2000:
                if probability_jaccard(sets[a], sets[b]) >= 0.8 - 1e-9:
                    x, y = top(a), top(b)
                    parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def test_near_duplicates(docs, corpus):
    got = near_duplicates.near_duplicate_classes(docs).collect()
    assert len(got) == len(corpus)
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(corpus)


def test_near_duplicates_in_blocks(docs, corpus, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    got = near_duplicates.near_duplicate_classes(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(corpus)


def test_near_duplicates_of_nothing(none, spark):
    assert near_duplicates.near_duplicate_classes(none).count() == 0
    rows = [[None, "a b c d e f", "en", "s"], [1, "a b c d e f", "en", "s"], [2, "", "en", "s"], [3, None, "en", "s"]]
    got = near_duplicates.near_duplicate_classes(frame(spark, rows)).collect()
    assert {tuple(r) for r in got} == {(None, None), (1, 1), (2, 2), (3, 3)}


def test_registers_estimate_the_similarity():
    rng = np.random.default_rng(3)
    a, b = rng.integers(1, 6, 300).astype(float), rng.integers(1, 6, 300).astype(float)
    b[:60] = 0
    runs = rng.integers(0, 2**63, 300).astype(np.uint64)
    exact = near_duplicates.probability_jaccard(np.zeros(300, int), a, b, 1)[0]
    shares = []
    for _ in range(40):
        runs = near_duplicates.mixed(runs)
        doc = np.concatenate([np.zeros(300, int), np.ones(240, int)])
        kept = near_duplicates.signatures(doc, np.concatenate([runs, runs[60:]]), np.concatenate([a, b[60:]]), 2)
        shares.append((kept[0] == kept[1]).mean())
    assert abs(np.mean(shares) - exact) < 0.02
    x, y = {i: v for i, v in enumerate(a)}, {i: v for i, v in enumerate(b) if v}
    assert abs(exact - sum(1 / sum(max(x[e] / x[d], y.get(e, 0) / y[d]) for e in x) for d in y)) < 1e-9


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 200)] + [(300, 300)]
    rng = random.Random(1)
    rng.shuffle(chain)
    got = {tuple(r) for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {(i, 1) for i in range(1, 41)} | {(100 + k, 100) for k in range(100)}


ITEMS = "item_id long, text string, doc string, score double"


def test_decontamination(spark):
    rng = random.Random(9)
    items = [(i, ". ".join(sentence(rng, n, 5000) for n in (rng.randrange(8, 60), 6)) + ".") for i in range(40)]
    items += [(90, None), (91, ""), (92, "..."), (93, "alone")]
    rows, expected = [], set()
    for d in range(150):
        text = sentence(rng, rng.randrange(0, 300), 5000)
        if d % 5 == 0:
            i, own = items[d % 40]
            text = f"{text} {own.upper() if d % 10 else own} {sentence(rng, 40, 5000)}"
            expected.add((d, i))
        if d % 7 == 0:
            own = words(items[(d + 1) % 40][1])
            text += " " + " ".join(own[: len(own) // 4])  # too little of an item
        rows.append([d, text, "en", "s"])
    rows += [[500, None, "en", "s"], [501, "", "en", "s"], [502, sentence(rng, 20000) + " " + items[3][1], "en", "s"]]
    rows += [rows[5]]
    expected.add((502, 3))
    bench = spark.createDataFrame([(*x, "d", 1.0) for x in items], ITEMS)
    got = decontamination.contaminated(frame(spark, rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected
    assert len(got) == len(expected) + 1


@pytest.mark.parametrize("postings", [2_000_000, 300])
def test_decontamination_finds_truncated_and_edited_items(spark, monkeypatch, postings):
    monkeypatch.setattr(decontamination, "SHARD_POSTINGS", postings)
    rng = random.Random(12)
    items = [(i, sentence(rng, 20 + i, 5000) + ". " + sentence(rng, 2, 5000) + ".") for i in range(20)]
    items.append((20, sentence(rng, 94, 5000) + ". " + sentence(rng, 2, 5000) + "."))
    rows, expected = [], set()
    for i, text in items:
        own = text.split()
        forms = [own[: len(own) * 9 // 10], own[:-1] + ["edited"], own[:5] + ["edited"] + own[6:]]
        forms += [own[:48]] if i == 20 else []  # one part of a long item
        for k, form in enumerate(forms):
            rows.append([10 * i + k, f"{sentence(rng, 50, 5000)} {' '.join(form)} {sentence(rng, 50, 5000)}", "en", "s"])
            expected.add((10 * i + k, i))
        rows.append([10 * i + 9, f"{sentence(rng, 50, 5000)} {' '.join(own[: len(own) // 3])}", "en", "s"])
    bench = spark.createDataFrame([(*x, "d", 1.0) for x in items], ITEMS)
    got = decontamination.contaminated(frame(spark, rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected


@pytest.mark.parametrize("kind", ["long", "string", "null"])
@pytest.mark.parametrize("times", [1, 2, 3])
def test_decontamination_with_repeated_null_and_text_ids(spark, times, kind):
    rng = random.Random(times)
    items = [(i, sentence(rng, rng.randrange(15, 110), 5000)) for i in range(40)]
    ident = {"long": lambda i: i, "string": "item {}".format, "null": lambda i: None}[kind]
    rows = [[i, f"{sentence(rng, 30, 5000)} {text} {sentence(rng, 30, 5000)}", "en", "s"] for i, text in items]
    bench = spark.createDataFrame([(ident(i), text) for i, text in items] * times,
                                  f"item_id {'string' if kind == 'string' else 'long'}, text string")
    got = decontamination.contaminated(frame(spark, rows), bench)
    assert dict(got.dtypes)["item_id"] == dict(bench.dtypes)["item_id"]
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(i, ident(i)) for i, _ in items]


def test_decontamination_with_a_low_threshold(spark):
    items = [(i, " ".join(["the", "of", "and", "to", *(f"w{i}x{j}" for j in range(4))])) for i in range(30)]
    bench = spark.createDataFrame([(*x, "d", 1.0) for x in items], ITEMS)
    docs = frame(spark, [[1, "the of and to", "en", "s"]])
    got = decontamination.contaminated(docs, bench, threshold=0.005, overlap=0.1).collect()
    assert {r["item_id"] for r in got} == set(range(30))


def test_decontamination_in_shards_and_with_columns(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "SHARD_POSTINGS", 5)
    bench = spark.createDataFrame([(1, "alpha beta gamma delta", "epsilon zeta"), (2, "one two three four", "five six"),
                                   (3, "red green blue white", None)], "item_id long, text string, answer string")
    rows = [[1, "x alpha beta gamma delta y epsilon zeta", "en", "s"], [2, "alpha beta gamma delta", "en", "s"],
            [3, "five six one two three four red green blue white", "en", "s"]]
    got = decontamination.contaminated(frame(spark, rows), bench, question_col="text", answer_col="answer").collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 1), (3, 2), (3, 3)}


def test_decontamination_of_nothing(none, spark):
    empty = spark.createDataFrame([], ITEMS)
    bench = spark.createDataFrame([(1, "a b c d e f", "d", 1.0)], ITEMS)
    assert decontamination.contaminated(none, bench).count() == 0
    assert decontamination.contaminated(frame(spark, [[1, "a b", "en", "s"]]), empty).count() == 0


def test_wand_finds_what_a_full_scan_finds():
    rng = np.random.default_rng(2)
    terms = [np.unique(rng.zipf(1.3, 30) % 200).astype(np.int64) for _ in range(300)]
    weights = [w / w.sum() for w in (rng.random(len(t)) for t in terms)]
    nothing = [np.zeros(0, np.int64)] * 300
    index = decontamination._Index(pa.table({
        "number": [str(k) for k in range(300)], "item": range(300), "terms": terms, "weights": weights,
        "question": pa.array(nothing, pa.list_(pa.int64())), "answer": pa.array(nothing, pa.list_(pa.int64()))}))
    for _ in range(60):
        query = np.unique(rng.zipf(1.3, 40) % 200).astype(np.uint64)
        own = index.terms_of(query)
        for threshold in (0.2, 0.5, 0.8):
            found = {(p, round(s, 9)) for p, s in index.search(own[own >= 0].tolist(), threshold)}
            scores = [(p, float(w[np.isin(t, query.astype(np.int64))].sum())) for p, (t, w) in enumerate(zip(terms, weights))]
            assert found == {(p, round(s, 9)) for p, s in scores if s >= threshold}


def test_languages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    more = spark.createDataFrame([(9000, None, "en", "s", 0), (9001, "", "en", "s", 0), (9002, "123 !?", "en", "s", 0),
                                  (None, "the of and that", None, None, None)], docs.schema)
    whole = docs.unionByName(more).withColumn("body", F.lit("clash")).withColumn("rank", F.lit(1))
    got = languages.predict_language(whole, docs.where(~languages.held_out("doc_id", 3)))
    joined = got.join(docs.select("doc_id", "lang"), "doc_id", "left").collect()
    assert len(joined) == docs.count() + 4
    held = [r for r in joined if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1
            and r["lang"] is not None]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert {r["lang_pred"] for r in joined if r["doc_id"] in (9000, 9001, 9002)} == {"und"}
    assert all(0 <= r["score"] <= 1 for r in joined)
    assert [r["lang_pred"] for r in joined if r["doc_id"] is None] == ["en"]


def test_languages_learned_from_little(spark, none):
    rows = [[1, "abc def", "xx", "s"], [2, "abc", "xx", "s"], [3, "77", "yy", "s"]]
    one = languages.predict_language(frame(spark, rows), frame(spark, rows)).collect()
    assert {(r["doc_id"], r["lang_pred"]) for r in one} == {(1, "xx"), (2, "xx"), (3, "und")}
    nothing = languages.predict_language(frame(spark, rows), none).collect()
    assert {(r["lang_pred"], r["score"]) for r in nothing} == {("und", 0.0)}
    assert languages.predict_language(none, frame(spark, rows)).count() == 0


def brute_targets(totals, most=3):
    order = sorted((s for s in totals if s is not None)) + [s for s in totals if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    held, total = set(), sum(totals.values())
    while True:
        rest = total - sum(most * totals[s] for s in held)
        of = sum(weight[s] for s in order if s not in held)
        target = {s: most * totals[s] if s in held else rest * weight[s] / of for s in order}
        above = {s for s in order if s not in held and target[s] > most * totals[s]}
        if not above:
            return target
        held |= above


@pytest.mark.parametrize("block", [1, 8, 128])
def test_mixing(docs, corpus, block):
    mixed, slots = mixing.mix_sources(docs, block=block)
    got = mixed.collect()
    totals = collections.Counter()
    for _, text, _, source in corpus:
        totals[source] += len(words(text))
    target, taken = brute_targets(totals), collections.Counter()
    assert len(got) == len(corpus)
    for r in got:
        assert r["source_size"] == totals[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, wanted in target.items():
        assert abs(taken[source] - wanted) <= 0.5
    assert sorted(map(tuple, mixed.collect()), key=repr) == sorted(map(tuple, got), key=repr)
    used = collections.Counter((r["source_no"], r["block_no"], r["round"]) for r in slots.collect())
    assert set(used.values()) == {1}


def test_mixing_takes_what_the_slots_hold(docs):
    mixed, slots = mixing.mix_sources(docs, block=16)
    held = mixing.slot_pieces(docs, slots, block=16).groupBy("doc_id").agg(F.sum("words").alias("n")).collect()
    taken = mixed.groupBy("doc_id").agg(F.sum("taken").alias("n")).where("n > 0").collect()
    assert sorted(map(tuple, held)) == sorted(map(tuple, taken))


def test_mixing_in_chunks_spans_and_shards(docs, corpus, monkeypatch):
    for name, value in (("CHUNK_WORDS", 500), ("_SPAN", 64), ("SHARD_SLOTS", 100)):
        monkeypatch.setattr(mixing, name, value)
    mixed, slots = mixing.mix_sources(docs, block=8)
    assert sum(r["taken"] for r in mixed.collect()) > 0.95 * sum(len(words(r[1])) for r in corpus)
    shards = slots.groupBy("shard", "source_no").count().collect()
    assert len({r["shard"] for r in shards}) > 10


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 17, 100, 1023, 4097])
def test_permutations(spark, n):
    for key in range(2):
        at = mixing._permuted(F.col("id"), F.lit(n).cast("long"), F.lit(key).cast("long"))
        back = mixing._permuted(F.col("to"), F.lit(n).cast("long"), F.lit(key).cast("long"), back=True)
        got = spark.range(n).withColumn("to", at).withColumn("back", back).collect()
        assert sorted(r["to"] for r in got) == list(range(n)) and all(r["id"] == r["back"] for r in got)
        if n > 1000:  # neighbours keep no fixed distance
            to = [r["to"] for r in sorted(got)]
            assert len({(b - a) % n for a, b in zip(to, to[1:])}) > n / 2


@pytest.mark.parametrize("sizes", [(130, 9000, 9000), (400, 9000, 20000), (40, 9000, 900), (1, 3, 100000), (129, 128, 127)])
def test_small_sources_meet_their_targets(spark, sizes):
    rng = random.Random(1)
    rows = []
    for k, size in enumerate(sizes):
        while size:
            n = min(size, rng.randrange(1, 300))
            rows.append([len(rows), " ".join("w" * n), "en", f"s{k}"])
            size -= n
    mixed, slots = mixing.mix_sources(frame(spark, rows))
    taken, target, got = collections.Counter(), {}, mixed.collect()
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert {s: taken[s] for s in target} == {s: round(t) for s, t in target.items()}
    assert slots.groupBy("shard").count().agg(F.max("count")).first()[0] <= mixing.SHARD_SLOTS


def test_mixing_nothing(none, spark):
    assert mixing.mix_sources(none)[0].count() == 0
    got = mixing.mix_sources(frame(spark, [[1, None, "en", None], [2, "", "en", "s"]]))[0].collect()
    assert {(r["size"], r["target"], r["taken"]) for r in got} == {(0, 0.0, 0)}


def brute_statistics(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    runs = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if runs[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_outliers(spark, corpus):
    rng = random.Random(4)
    rows = corpus + [[600 + i, sentence(rng, 80 + i % 30), "en", "s0"] for i in range(150)]
    junk = [[900 + i, " ".join(x + "%%%" for x in sentence(rng, 60).split()), "en", "s0"] for i in range(8)]
    lines = [[950, "x y\n" * 6 + sentence(rng, 100) + "\n \nx y", "en", None], [951, "a b c d e f g " * 2 + "|", None, "s"]]
    got = outliers.quality_outliers(frame(spark, rows + junk + lines)).collect()
    assert len(got) == len(rows + junk + lines)
    texts = {r[0]: r[1] for r in rows + junk + lines}
    for r in got:
        n = brute_statistics(texts[r["doc_id"]])
        assert tuple(r)[1:6] == n, r
        assert r["base_failed"] == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r["kept"] and r["base_failed"])
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not any(kept[900 + i] for i in range(8)) and all(kept[600 + i] for i in range(150))


def test_outliers_are_menus_and_not_clean_rows(spark):
    rng = random.Random(6)
    rows = [[i, sentence(rng, rng.randrange(60, 400)), "en", "s0"] for i in range(200)]
    menus = [[300 + i, " | ".join(sentence(rng, rng.randrange(60, 200)).split()), "en", "s0"] for i in range(16)]
    rest = [[400, sentence(rng, 100), "fr", "s1"], [401, " | ".join(sentence(rng, 100).split()), "fr", None]]
    kept = {r["doc_id"]: r["kept"] for r in outliers.quality_outliers(frame(spark, rows + menus + rest)).collect()}
    assert {i for i, k in kept.items() if not k} == {*range(300, 316), 401}


def test_outlier_distances_are_those_of_the_estimate(spark):
    rng = np.random.default_rng(1)
    rows = [("p", *map(float, x)) for x in rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5))]
    vectors = spark.createDataFrame(rows, "part string, x0 double, x1 double, x2 double, x3 double, x4 double")
    model = outliers._moments(vectors, 1.0)
    got = sorted(r["distance"] for r in outliers._distances(vectors, model).collect())
    x = np.array([r[1:] for r in rows])
    cov = np.cov(x.T, bias=True) + np.diag(np.array(outliers.FLOORS) ** 2)
    gap = x - x.mean(axis=0)
    assert np.allclose(got, np.sort(np.einsum("ij,jk,ik->i", gap, np.linalg.inv(cov), gap)))


def test_outliers_of_nothing(none, spark):
    assert outliers.quality_outliers(none).count() == 0
    few = outliers.quality_outliers(frame(spark, [[1, " ".join("abcdefghijkl"), None, None], [2, None, "en", "s"]]))
    assert {(r["doc_id"], r["kept"], r["distance"]) for r in few.collect()} == {(1, True, None), (2, False, None)}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("frequent", [1 << 21, 50])
def test_suffix_tree_base(docs, corpus, monkeypatch, frequent):
    monkeypatch.setattr(suffix_tree, "FREQUENT", frequent)
    got = suffix_tree.suffix_tree_scores(docs, ~languages.held_out("doc_id", 5)).collect()
    counts = collections.Counter()
    for i, text, *_ in corpus:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update([*words(lower(text or "")), "\n"])
    n, v = sum(counts.values()), len(counts)
    texts = {r[0]: [*words(lower(r[1] or "")), "\n"] for r in corpus}
    assert len(got) == len(corpus)
    for r in got:
        tokens = texts[r["doc_id"]]
        base = sum(np.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert np.isfinite(r["score"]) and r["score"] < 0


def test_suffix_tree_scores_do_not_depend_on_how_counts_travel(docs, monkeypatch):
    def run():
        return sorted((r["doc_id"], round(r["score"], 6)) for r in suffix_tree.suffix_tree_scores(
            docs, F.lit(True)).collect())
    whole = run()
    monkeypatch.setattr(suffix_tree, "FREQUENT", 50)
    assert run() == whole


def test_suffix_tree_states_and_sums():
    text = "abracadabra abracadabra abra cad abra"
    runs = collections.Counter()
    padded = "\n" * suffix_tree.DEPTH + text.replace(" ", " ") + " \n"
    symbols = {c: i for i, c in enumerate(sorted(set(padded)))}
    rows = []
    for depth in range(suffix_tree.DEPTH + 1):
        seen = collections.Counter()
        for j in range(suffix_tree.DEPTH, len(padded)):
            context = 0
            for c in padded[j - depth : j]:
                context = context * suffix_tree._SYMBOLS + symbols[c]
            seen[context, symbols[padded[j]]] += 1
        rows += [(depth, c, s, n) for (c, s), n in seen.items()]
    before, chance = suffix_tree._grown(*(np.array(x) for x in zip(*rows)))
    assert np.allclose((10.0 ** chance.astype(float)).sum(axis=1), 1, atol=1e-4)
    assert len(before) > 3
    table = np.zeros(256, np.int64)
    for c, i in symbols.items():
        table[ord(c)] = i
    data = np.frombuffer(padded.encode(), np.uint8)
    got = suffix_tree.symbol_scores(data, table, np.zeros(256), before, chance)
    for j in range(suffix_tree.DEPTH, len(padded)):  # walk back one symbol at a time
        state = 0
        for back in range(1, suffix_tree.DEPTH + 1):
            longer = before[state, symbols[padded[j - back]]]
            if longer < 0:
                break
            state = longer
        assert got[j] == pytest.approx(chance[state, symbols[padded[j]]])
    assert not runs


def test_suffix_tree_without_training(docs, none):
    got = suffix_tree.suffix_tree_scores(docs.limit(20), F.lit(False)).collect()
    assert len(got) == 20 and {r["train_tokens"] for r in got} == {0} and {r["n_known"] for r in got} == {0}
    assert suffix_tree.suffix_tree_scores(none, F.lit(True)).count() == 0


ARTICLE = "<article><h1>A title here</h1><p>{}</p><p>Second, with <b>bo</b>ld &amp; more.<br>Next line.</p></article>"
LONG = "This is a long sentence, with commas, that a reader would read. And another one; quite long as well."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain words", "plain words"),
    ("<html><body><nav><a href='/'>Home</a></nav>" + ARTICLE.format(LONG) + "<footer>Copyright, us.</footer></body></html>",
     f"A title here {LONG} Second, with bold & more. Next line."),
    ("<body><div class='ad-banner'>Buy now, really, buy!</div><div id=main><h2>Head</h2><p>" + LONG + "<p>" + LONG
     + "</div><div class=comments><p>" + LONG + "</p></div><aside>" + LONG + "</aside><form>" + LONG + "</form></body>",
     f"Head {LONG} {LONG}"),
    ("<body><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul><div><p>" + LONG + "</p><p>" + LONG
     + "</p></div><script>var x = '<p>" + LONG + "</p>';</script><style>p{}</style><!-- " + LONG + " --></body>",
     f"{LONG} {LONG}"),
    ("<article><p><b>" + LONG + "<br><p>a &lt; b &#233; &nosuch; 3 < 4</article>", f"{LONG} a < b é &nosuch; 3 < 4"),
    ("<article><p>" + LONG + "<div role=navigation>Menu</div><p hidden>No</p><p style='display: none'>No</p>",
     LONG),
    ('<p title="a > b">' + LONG + '</p><p title="broken>' + LONG, None),
])
def test_page_text(page, text):
    got = page_text.extract(page or "")
    assert got.startswith(LONG) if text is None else got == text


_LONG = "A long sentence of the story, with commas, goes on and on. It has another one, too."


@pytest.mark.parametrize("page, text", [
    *((f"<body><div class='{c}'><p>{_LONG}</p><p>{_LONG}</p></div><div class='ad'>Buy now.</div></body>", f"{_LONG} {_LONG}")
      for c in ("content has-sidebar", "post social-share-enabled", "page no-comments")),
    (f"<div class='page no-comments'><article><p>{_LONG}</p></article></div><div class='comments'><p>So so, so.</p></div>",
     _LONG),
    (f"<div><p>{_LONG}</p><p>{_LONG}</p></div><article><a href='x'>Teaser</a></article><article><a href='y'>More</a></article>",
     f"{_LONG} {_LONG}"),
    (f"<p>{_LONG} <span class='ad'>Buy now.</span> {_LONG}</p>", f"{_LONG} {_LONG}"),
    (f"<article><p>{_LONG}</p></article><div class='comments'><p>{_LONG} No!</p><p>{_LONG} Yes!</p></div>", _LONG),
])
def test_page_text_is_not_lost_to_names_or_teasers(page, text):
    assert page_text.extract(page) == text


_COMMENTS = "".join(f"<li><p>Reader {i} says: I loved this, truly, and more of it please!</p></li>" for i in range(12))


@pytest.mark.parametrize("name", ["comments", "comment-list", "comment-thread", "commentlist", "responses", "post-body replies"])
def test_page_text_never_holds_reader_comments(name):
    story = f"<p>{_LONG}</p>" * 3
    for own in (_COMMENTS, _COMMENTS.replace("<p>", "<article class='comment-body'><p>").replace("</p>", "</p></article>")):
        block = f"<ol class='{name}'>{own}</ol>"
        for page in (f"<article>{story}</article>{block}", f"<div>{story}</div>{block}", f"<article>{story}{block}</article>",
                     f"<div class='comments-wrapper'><article><h1>{_LONG}</h1><p>{_LONG}</p><p>{_LONG}</p></article>{block}</div>"):
            assert page_text.extract(page) == " ".join([_LONG] * 3)
    assert page_text.extract(f"<ol class='{name}'>{_COMMENTS}</ol>") == ""


@pytest.mark.parametrize("page, text", [
    (f"<form><article><p>{_LONG}</p><p>{_LONG}</p></article><p>{_LONG} Tell us.</p></form>", f"{_LONG} {_LONG}"),
    (f"<form id=f><div><p>{_LONG}</p><p>{_LONG}</p></div><input></form>", f"{_LONG} {_LONG}"),
    (f"<article><p>{_LONG}</p><form><p>{_LONG} Tell us.</p></form></article>", _LONG),
    (f"<p>{_LONG}</p><form><p>{_LONG} Tell us.</p></form>", _LONG),
    (f"<p>{_LONG}</p><div class=cookiebar><p>We use them.</p></div>", _LONG),
])
def test_page_text_of_forms(page, text):
    assert page_text.extract(page) == text


@pytest.mark.parametrize("page", [
    "<div>x" * 100_000, "<div class=ad>x" * 50_000, '<a "' * 100_000, '<a "x>"' * 100_000, "<!" * 100_000, "<x" * 100_000,
    "<x>" * 50_000 + "<td>a</td>" * 50_000, "<div>x" * 50_000 + "</p>" * 50_000, "<a " + "b" * 300_000 + ">x", "<li>x" * 50_000])
def test_page_text_takes_linear_time(page):
    began = time.process_time()
    page_text.extract(page)
    assert time.process_time() - began < 5


def test_page_rows(spark):
    rows = [(1, "u", "<article><p>é " + LONG + "</p></article>", "x"), (2, None, None, "x"), (None, "u", "", "x")]
    pages = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string, body string")
    got = page_text.main_text(pages).collect()
    assert sorted(((r["page_id"], r["n_chars"]) for r in got), key=repr) == [
        (1, len(LONG) + 2)] * 2 + [(2, 0), (None, 0)]
    assert page_text.main_text(pages.limit(0)).count() == 0


def test_page_text_of_the_tables(spark, sf):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in page_text.main_text(spark.read.parquet(f"{sf}/pages.parquet")).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        plain = re.sub(r"<[^>]+>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", body)
        assert r["text"] == " ".join(html.unescape(plain).split())


ENTRIES = "list string, verdict string, kind string, pattern string, on_date date, action string, at string"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def brute_judged(captures, entries):
    open_since, stays = {}, []
    logged = {}
    for name, verdict, kind, pattern, on, action in {e for e in entries if e[3] and e[4] and e[5]}:
        key = (name, verdict, kind, pattern, on)
        logged[key] = max(action, logged.get(key, ""))
    for (*key, on), action in sorted(logged.items(), key=lambda x: x[0]):
        key = tuple(key)
        if key in open_since:
            stays.append((*key, open_since.pop(key), on))
        if action == "add":
            open_since[key] = on
    stays += [(*key, since, None) for key, since in open_since.items()]
    out = []
    for i, url, at in captures:
        m = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)[^/?#]*([^?#]*)", (url or "").lower())
        host, steps = (m[1], [s for s in m[2].split("/") if s]) if m else ("", [])
        labels = host.split(".")
        keys = {("host", host)} | {("domain", ".".join(labels[k:])) for k in range(len(labels))} | {
            ("prefix", "/".join([host, *steps[:k]])) for k in range(len(steps) + 1)}
        active = [s for s in stays if host and at and (s[2], s[3]) in keys and s[4] <= at and (not s[5] or at < s[5])]
        best = max(active, key=lambda s: (len(s[3]), s[1], s[4], s[0], s[2]), default=None)
        out.append((i, url, at, len(active), best and best[0], best and best[3], best and best[4],
                    not best or best[1] != "block"))
    return sorted(out, key=repr)


def test_url_lists(spark):
    rng = random.Random(8)
    hosts = ["a.com", "b.a.com", "x.y.b.a.com", "c.org", "hot.net"]
    captures = []
    for i in range(300):
        host = "hot.net" if i % 3 == 0 else rng.choice(hosts)
        path = rng.choice(["", "/", "/p", "/p/q?x=/z", "/P/q/r#f"])
        captures.append((i, f"https://{rng.choice(['', 'u@'])}{host}{rng.choice(['', ':80'])}{path}", day(rng.randrange(200))))
    captures += [(900, None, day(3)), (901, "no url", day(3)), (902, "https://a.com/", None), (None, "http://a.com", day(50))]
    captures += captures[:3]
    entries = []
    for _ in range(160):
        kind = rng.choice(["host", "domain", "prefix"])
        pattern = rng.choice(hosts) + (rng.choice(["", "/p", "/p/q"]) if kind == "prefix" else "")
        entries.append((f"l{rng.randrange(3)}", rng.choice(["block", "allow"]), kind, pattern, day(rng.randrange(220)),
                        rng.choice(["add", "remove"])))
    entries += [("l0", "block", "host", None, day(0), "add"), ("l0", "block", "host", "a.com", None, "add"),
                ("l0", "block", "host", "a.com", day(2), None)] + entries[:5]
    df = spark.createDataFrame([(*c, "k") for c in captures], "page_id long, url string, fetched_on date, period string")
    listed = spark.createDataFrame([(*e, "x") for e in entries], ENTRIES)
    got = url_lists.judged(df, listed).collect()
    assert sorted(map(tuple, got), key=repr) == brute_judged(captures, entries)
    assert url_lists.judged(df.limit(0), listed).count() == 0
    assert {r["allowed"] for r in url_lists.judged(df, listed.limit(0)).collect()} == {True}


CALLS = "conv_id long, call_id string, position long, name string, arguments string, level string"
RESULTS = "conv_id long, call_id string, position long, content string, name string"
SCHEMA = json.dumps({"type": "object", "required": ["q"], "additionalProperties": False, "properties": {
    "q": {"type": "string", "minLength": 1}, "n": {"type": ["integer", "null"], "minimum": 1, "maximum": 5},
    "tags": {"type": "array", "items": {"enum": ["a", "b"]}}, "after": {"type": "object"}, "f": {"type": "number"}}})


def test_tool_calls(spark):
    calls = [
        (1, "a", 0, "f", '{"q":"x"}'), (1, "b", 1, "f", '{"n":2.0,"q":"é","after":{"ref":"a"}}'),
        (1, "c", 2, "f", '{"q":"x","after":{"ref":"b"}}'), (1, "a", 5, "f", '{"q":"again"}'),
        (1, "d", 3, "f", '{"q":""}'), (1, "e", 4, "g", "{}"), (1, "h", 6, "f", "{bad"), (1, "i", 7, "f", '{"q":"1","q":"2"}'),
        (2, "a", 0, "f", '{"q":"x","after":{"ref":"b"}}'), (2, "b", 1, "f", '{"q":"x","after":{"ref":"a"}}'),
        (2, "c", 2, "f", '{"q":"x","after":{"ref":"b"}}'), (2, "z", 3, "f", '{"q":"x","after":{"ref":"nowhere"}}'),
        (None, "n", 0, "f", '{"q":"x"}'), (3, None, 0, "f", '{"q":"x"}'), (3, "m", 1, "f", None),
        (4, "t", 0, "f", '{"q":"x","n":9,"tags":["a","c"],"f":1e400}'), (4, "u", 1, "f", '{"q":5,"n":9,"tags":["c"],"zz":1}'),
    ]
    results = [(1, "a", 1, "ra"), (1, "a", 9, "late"), (1, "b", 2, "rb"), (1, "zz", 3, "lost"), (None, "n", 1, "rn"),
               (2, "z", 4, None), (3, None, 2, "for nobody")]
    df = spark.createDataFrame([(*c, "x") for c in calls + calls[:1]], CALLS)
    rs = spark.createDataFrame([(*r, "x") for r in results + results[:1]], RESULTS)
    schemas = spark.createDataFrame([("f", SCHEMA)], "name string, schema string")
    got = {(r["conv_id"], r["call_id"], r["position"]): r for r in tool_calls.link_tool_calls(df, rs, schemas).collect()}
    status = {k: (r["status"], r["level"]) for k, r in got.items()}
    assert status == {
        (1, "a", 0): ("ok", 0), (1, "b", 1): ("ok", 1), (1, "c", 2): ("missing_result", 2), (1, "a", 5): ("duplicate_id", 0),
        (1, "d", 3): ("invalid_arguments", 0), (1, "e", 4): ("unknown_tool", 0), (1, "h", 6): ("invalid_arguments", 0),
        (1, "i", 7): ("invalid_arguments", 0), (2, "a", 0): ("cyclic", None), (2, "b", 1): ("cyclic", None),
        (2, "c", 2): ("cyclic", None), (2, "z", 3): ("ok", 0), (None, "n", 0): ("ok", 0),
        (3, None, 0): ("missing_result", None), (3, "m", 1): ("invalid_arguments", 0),
        (4, "t", 0): ("invalid_arguments", 0), (4, "u", 1): ("invalid_arguments", 0),
        (1, "zz", 3): ("orphan_result", None), (3, None, 2): ("orphan_result", None)}
    assert got[1, "b", 1]["record"] == '{"arguments":{"after":{"ref":"a"},"n":2,"q":"é"},"call_id":"b","name":"f","result":"rb"}'
    assert got[1, "a", 0]["n_results"] == 2 and '"result":"ra"' in got[1, "a", 0]["record"]
    assert got[4, "u", 1]["problems"] == "$.n: range; $.q: not string; $.tags[0]: not one of the values; $.zz: unknown"
    assert tool_calls.link_tool_calls(df.limit(0), rs.limit(0), schemas).count() == 0


def test_tool_call_order_puts_every_call_after_what_it_needs(spark):
    rng = random.Random(6)
    calls, needs = [], {}
    for k in range(200):  # one conversation holds nearly all
        needs[k] = rng.sample(range(k), min(k, rng.randrange(3))) if k % 17 else []
        refs = ",".join(json.dumps({"ref": f"c{x}"}) for x in needs[k])
        calls.append((1, f"c{k}", rng.randrange(50), "f", f'{{"q":"x","tags":[{refs}]}}', "x"))
    schemas = spark.createDataFrame([("f", "{}")], "name string, schema string")
    results = spark.createDataFrame([], RESULTS)
    got = {r["call_id"]: r["level"] for r in tool_calls.link_tool_calls(
        spark.createDataFrame(calls, CALLS), results, schemas).collect()}
    for k, before in needs.items():
        assert got[f"c{k}"] == max((got[f"c{x}"] + 1 for x in before), default=0)


@pytest.mark.parametrize("group", [200_000, 5])
def test_tool_call_levels_of_random_graphs_and_chains(spark, monkeypatch, group):
    monkeypatch.setattr(tool_calls, "GROUP", group)
    rng = random.Random(group)
    needs = {}
    for conv in range(6):
        for k in range(60):
            near = range(max(0, k - 4), k) if conv < 4 else range(60)  # the last two hold cycles
            needs[conv, k] = set(rng.sample(near, min(len(near), rng.choice([0, 1, 1, 1, 2]))))
    for k in range(1000):
        needs[9, k] = {k - 1} if k else set()
    needs.update({(10, k): {(k + 1) % 40} for k in range(40)})
    level, open_ = {}, set(needs)
    while ready := {x for x in open_ if all((x[0], y) in level for y in needs[x])}:
        level.update({x: max((level[x[0], y] + 1 for y in needs[x]), default=0) for x in ready})
        open_ -= ready
    refs = lambda ids: json.dumps({"q": "x", "after": [{"ref": f"c{x}"} for x in sorted(ids)]})
    calls = spark.createDataFrame([(c, f"c{k}", 0, "f", refs(ids), "x") for (c, k), ids in needs.items()], CALLS)
    schemas = spark.createDataFrame([("f", "{}")], "name string, schema string")
    began = time.time()
    got = tool_calls.link_tool_calls(calls, spark.createDataFrame([], RESULTS), schemas).collect()
    assert time.time() - began < 60
    assert {(r["conv_id"], int(r["call_id"][1:])): r["level"] for r in got} == {x: level.get(x) for x in needs}
    assert {r["status"] for r in got if r["level"] is None} == {"cyclic"}


def test_tool_calls_survive_any_value(spark):
    values = {
        "surrogate": (r'{"q":"\ud800"}', "$: unpaired surrogate"), "pair": (r'{"q":"\ud83d\ude00"}', ""),
        "deep": ('{"q":' + "[" * 100_000, "$: nested deeper than 200"), "text": ('{"q":"' + "[" * 100_000 + '"}', ""),
        "digits": ('{"q":"x","f":' + "9" * 400 + "}", ""), "more": ('{"q":"x","f":' + "9" * 5000 + "}", "$: number too long"),
        "big": ('{"q":"x","f":1e400}', "$: number too large"), "long": ('{"q":"' + "é" * 3_000_000 + '"}', ""),
        "ref": ('{"q":"x","ref":"ref"}', "$.ref: unknown"), "empty": ("", "$: not JSON"), "top": ('{"ref":"top"}', None)}
    calls = spark.createDataFrame([(1, k, 0, "f", v[0], "x") for k, v in values.items()], CALLS)
    results = spark.createDataFrame([(1, k, 1, "r", "x") for k in values], RESULTS)
    schemas = spark.createDataFrame([("f", SCHEMA), (None, "{}")], "name string, schema string")
    for r in tool_calls.link_tool_calls(calls, results, schemas).collect():
        written, found = values[r["call_id"]]
        assert found is None or r["problems"] == found, r["call_id"]
        assert r["status"] == ("ok" if found == "" else "invalid_arguments") and r["level"] == 0
        record = json.loads(r["record"]) if r["call_id"] != "digits" else {"arguments": json.loads(written)}
        assert record["arguments"] == (json.loads(written) if found in ("", None, "$.ref: unknown") else written)


@pytest.mark.parametrize("schema, value, found", [
    (True, 5, []), (False, 5, ["$: not allowed"]), ({"items": False}, [1], ["$[0]: not allowed"]),
    ({"enum": [1]}, True, ["$: not one of the values"]), ({"enum": [1]}, 1.0, []), ({"const": {"a": 1}}, {"a": 1.0}, []),
    ({"anyOf": [{"type": "null"}, {"minimum": 3}]}, 2, ["$: anyOf"]), ({"oneOf": [{}, {"type": "string"}]}, "x", ["$: oneOf"]),
    ({"allOf": [{"minimum": 1}, {"maximum": 3}]}, 2, []), ({"not": {"type": "string"}}, "x", ["$: not"]),
    ({"exclusiveMaximum": 3, "type": "integer"}, 3.0, ["$: range"]), ({"maxItems": 1}, [1, 2], ["$: size"]),
    ({"additionalProperties": {"type": "string"}}, {"k": 1}, ["$.k: not string"]), ({"minProperties": 1}, {}, ["$: size"])])
def test_schema_keywords(schema, value, found):
    assert tool_calls.usable(schema) and list(tool_calls.problems(value, schema)) == found


def test_unusable_schemas(spark):
    bad = ["{bad", "5", '{"type":"text"}', '{"items":[]}', '{"pattern":"a"}', '{"$ref":"#"}', '{"anyOf":[]}', '{"enum":1}',
           '{"properties":{"a":{"zz":1}}}', '{"minLength":"1"}', '{"required":"a"}', "[" * 100_000, None]
    schemas = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(bad)] + [("two", "{}"), ("two", "true"), ("one", "{}"),
                                    ("one", "{}"), ("any", "true")], "name string, schema string")
    names = [f"s{i}" for i in range(len(bad))] + ["two", "one", "any"]
    calls = spark.createDataFrame([(1, n, 0, n, "{}", "x") for n in names], CALLS)
    got = tool_calls.link_tool_calls(calls, spark.createDataFrame([], RESULTS), schemas).collect()
    assert {r["call_id"]: r["status"] for r in got} == {
        n: "missing_result" if n in ("one", "any") else "unusable_schema" for n in names}


def test_canonical_json():
    assert tool_calls.canonical({"b": [1.0, 2.5, True, None], "a": {"z": "ü\n", "y": -0.0}}) == \
        '{"a":{"y":0,"z":"ü\\n"},"b":[1,2.5,true,null]}'
    value = {"x": [1, {"k": "v"}], "t": "é"}
    assert tool_calls.parsed(tool_calls.canonical(value)) == value
    with pytest.raises(ValueError):
        tool_calls.parsed('{"a":NaN}')


def test_digest_of_kept_words(spark, sf):
    from assetloom.llm.queries import QUERIES
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = {(i, n, cut, hashlib.sha256(kept.encode()).hexdigest()) for i, n, cut, kept in brute_repeats(docs, 50)}
    assert {tuple(r) for r in QUERIES["op3_super_kmer_repeats"](spark, sf).collect()} == expected
