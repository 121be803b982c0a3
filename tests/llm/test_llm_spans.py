"""Periodic runs, disguised identifiers and token alignment against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from assetloom.llm import disguised_identifiers as pii
from assetloom.llm import periodic_runs, token_alignment
from assetloom.llm.words import buffer, words_of

DOCS = "doc_id long, text string, doc string, body string, piece long, runs string, found int"


def frame(spark, rows):
    """Documents with further columns named like inner ones."""
    return spark.createDataFrame([(*r, "x", "y", 1, "z", 2) for r in rows], DOCS)


def plain_runs(w, least, times):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            begin = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            n = i - begin + q
            run = w[begin : begin + n]
            least_period = all(any(run[k] != run[k + p] for k in range(n - p)) for p in range(1, q))
            if n >= max(least, times * q) and least_period:
                out.append((begin, n, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least,times", [(24, 3), (6, 2), (10, 4)])
def test_runs_are_those_of_brute_force(least, times):
    rng = random.Random(least)
    for _ in range(60):
        texts = []
        for _ in range(4):
            w = []
            for _ in range(rng.randrange(1, 6)):
                w += [f"w{rng.randrange(rng.choice([1, 2, 3, 9]))}" for _ in range(rng.randrange(1, 14))] * rng.randrange(1, 9)
            texts.append(" ".join(w[: rng.randrange(1, len(w) + 1)]))
        found = periodic_runs._runs_of_texts(words_of(*buffer(pa.array(texts))), least, times)
        for k, text in enumerate(texts):
            assert found.get(k, []) == plain_runs(text.split(), least, times)


def test_one_word_many_times_and_one_phrase_with_many_left_words_end_soon():
    phrase = " ".join(f"x{k}" for k in range(20))
    for text, n in (("a " * 60_000, 1), (" ".join(f"{phrase} y{i}" for i in range(4000)), 0)):
        assert sum(map(len, periodic_runs._runs_of_texts(words_of(*buffer(pa.array([text]))), 24, 3).values())) == n


def test_runs_of_odd_rows(spark):
    line = "Click here\tto read on. " * 9
    rows = [(1, "begin " + line + "end"), (1, "begin " + line + "end"), (2, None), (3, ""), (None, line), (4, " \n"),
            (5, "é日 " * 30 + "x " * 24)]
    got = collections.Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed_text)
                              for r in periodic_runs.periodic_runs(frame(spark, rows)).collect())
    assert got == collections.Counter({
        (1, 47, ((1, 45, 5),), "begin Click here to read on. end"): 2, (2, 0, (), ""): 1, (3, 0, (), ""): 1,
        (None, 45, ((0, 45, 5),), "Click here to read on."): 1, (4, 0, (), ""): 1,
        (5, 54, ((0, 30, 1), (30, 24, 1)), "é日 x"): 1})
    assert periodic_runs.periodic_runs(frame(spark, [])).count() == 0


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        total += sum(divmod(int(c) * 2, 10)) if k % 2 else int(c)
    return total % 10 == 0


def plain_identifiers(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m)) <= 15]


def test_plain_identifiers_are_those_of_the_patterns():
    rng = random.Random(7)
    parts = ["a", "@", ".", "1", "+", " ", "-", "(", ")", "4", "255", "b.c", "a@b.c", "é", "０", "4111111111111111", "00"]
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        assert [x[:3] for x in pii.identifiers(t) if x[3]] == plain_identifiers(t), t


@pytest.mark.parametrize("text,kind,covered,value", [
    ("to joe.doe [at] example [dot] com now", "email", "joe.doe [at] example [dot] com", "joe.doe@example.com"),
    ("ask joe at mail dot example dot com", "email", "joe at mail dot example dot com", "joe@mail.example.com"),
    ("ask joe_at_example_dot_com", "email", "joe_at_example_dot_com", "joe@example.com"),
    ("jоe@exаmple.com", "email", "jоe@exаmple.com", "joe@example.com"),
    ("é jo​e@exa­mple.com é", "email", "jo​e@exa­mple.com", "joe@example.com"),
    ("ａ＠ｂ．ｃｏ", "email", "ａ＠ｂ．ｃｏ", "a@b.co"),
    ("joe@mail.co[dot]uk", "email", "joe@mail.co[dot]uk", "joe@mail.co.uk"),
    ("host 192[.]168[.]1[.]1", "ip", "192[.]168[.]1[.]1", "192.168.1.1"),
    ("host 10 dot 0 dot 0 dot 1", "ip", "10 dot 0 dot 0 dot 1", "10.0.0.1"),
    ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１", "4111 1111 1111 1111"),
    ("4111 1l11 11I1 1111", "card", "4111 1l11 11I1 1111", "4111 1111 1111 1111"),
    ("four" + " one" * 15, "card", "four" + " one" * 15, "4" + "1" * 15),
    ("call plus four nine one five one two three four five", "phone", "plus four nine one five one two three four five",
     "+491512345"),
    ("vier-" + "eins-" * 14 + "eins", "card", "vier-" + "eins-" * 14 + "eins", "4" + "1" * 15),
])
def test_disguises_are_mapped_to_their_characters(text, kind, covered, value):
    added = [x for x in pii.identifiers(text) if not x[3]]
    assert [(k, text[a:b], v) for k, a, b, _, v in added] == [(kind, covered, value)]


@pytest.mark.parametrize("text", [
    "Look at the dot on the map at noon.", "he was at home dot dot dot", "one two three, four five six", "x ½ cup (at) noon",
    "one or two at three", "the dot com years", "Ünïcödé naïve façade 12 ² ① Ⅷ"])
def test_plain_prose_holds_nothing(text):
    assert pii.identifiers(text) == []


def test_hostile_texts_end_soon():
    for text in ("@" * 50_000, "a" * 90_000, "1." * 40_000, "one " * 30_000, "a dot " * 20_000, "(at)" * 20_000,
                 "+1 " * 40_000, "０" * 60_000, "1O" * 30_000):
        pii.identifiers(text)


def test_identifiers_of_odd_rows(spark):
    mail = "a@b.co and c [at] d [dot] org"
    rows = [(1, mail), (1, mail), (2, None), (3, ""), (None, "+49 151 2345"), (4, "é" * 100_000 + " " + mail)]
    got = sorted(((r.doc_id or 0, [tuple(x) for x in r.found]) for r in
                  pii.disguised_identifiers(frame(spark, rows)).collect()), key=repr)
    spans = [("email", 0, 6, True, "a@b.co"), ("email", 11, 29, False, "c@d.org")]
    far = [(k, a + 100_001, b + 100_001, p, v) for k, a, b, p, v in spans]
    assert got == sorted([(0, [("phone", 0, 12, True, "+49 151 2345")]), (1, spans), (1, spans), (2, []), (3, []), (4, far)],
                         key=repr)
    assert pii.disguised_identifiers(frame(spark, [])).count() == 0


@pytest.fixture(scope="module")
def both():
    return token_alignment.tokenizers_of(token_alignment.BYTE_BPE, token_alignment.PIECE_BPE)


def plain_alignment(text, both):
    """Numbers, groups and links of a whole text, token by token."""
    full = (" " + text).encode()
    ids = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    tokens = [[table[i] for i in own] for table, own in zip((both.a_bytes, both.b_bytes), ids)]
    if not text or any(b"".join(x) != full for x in tokens):
        return (0, 0, 0, 0, ""), []
    ends = [np.cumsum([len(t) for t in x]).tolist() for x in tokens]
    links, i, j = [], 0, 0
    while i < len(ids[0]):
        links.append((ids[0][i], ids[1][j]))
        p, q = ends[0][i], ends[1][j]
        i, j = i + (p <= q), j + (q <= p)
    groups, before = [], 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        groups.append("|".join(",".join(str(t) for t, e in zip(own, some) if before < e <= cut)
                               for own, some in zip(ids, ends)))
        before = cut
    return (len(ids[0]), len(ids[1]), len(groups), len(links), ";".join(groups)), links


PARTS = ["a", "b", " ", "  ", "\n", " the", " word", "'s", "<0x41>", "▁", "é", "😀", "日本", "\t", " ", " ", "1", "23",
         "!", "\x1c", "\x85", "<|endoftext|>", "</s>", "ﷺ", "\r\n", "_", "x y z ", "\x00", "é", "ﬁ"]


def odd_texts(n):
    rng = random.Random(11)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(25))) for _ in range(n)]


@pytest.mark.parametrize("cut", [True, False])
def test_alignment_of_stretches_is_that_of_whole_texts(both, cut, monkeypatch):
    assert both.cut
    monkeypatch.setattr(both, "cut", cut)
    texts = [*odd_texts(600), None, "", "word " * 3000]
    numbers, groups, pairs, held, _ = token_alignment._aligned(texts, both, False)
    counts = collections.Counter()
    for k, text in enumerate(texts):
        row, links = plain_alignment(text or "", both)
        assert (*(int(x[k]) for x in numbers), groups[k]) == row, text
        counts.update(links)
    assert dict(zip(pairs.tolist(), held.tolist())) == {a * token_alignment.PAIR + b: n for (a, b), n in counts.items()}


def test_packed_numbers_come_back():
    arrays = [np.array(x, np.int64) for x in ([], [0], [1, 300, 70_000, 2**40], [255] * 9)]
    assert [x.tolist() for x in token_alignment._unpacked(token_alignment._packed(arrays))] == [x.tolist() for x in arrays]


def test_alignment_over_pieces(spark, both, monkeypatch):
    texts = [*odd_texts(40), None, "", "the cat " * 400, "the cat " * 400]
    rows = [(k if k % 9 else None, t) for k, t in enumerate(texts)] + [(7, "the cat")]
    counts, expected = collections.Counter(), []
    for k, t in rows:
        row, links = plain_alignment(t or "", both)
        counts.update(links)
        expected.append((k, row, links))
    top = collections.defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    want = sorted(((k, *row[:4], sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(row[4].encode()).hexdigest() if row[0] else "") for k, row, links in expected), key=repr)
    docs = frame(spark, rows).repartition(7)
    got = sorted(map(tuple, token_alignment.aligned_tokens(docs).collect()), key=repr)
    assert got == want
    pairs = {(r.a, r.b): r.n for r in token_alignment.pair_counts(docs).collect()}
    assert pairs == dict(counts)
    assert token_alignment.aligned_tokens(frame(spark, [])).count() == 0
    texts = token_alignment.aligned_tokens(docs, digests=False).collect()
    assert sorted(r.groups for r in texts) == sorted(row[4] for _, row, _ in expected)
