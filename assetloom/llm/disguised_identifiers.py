"""Personal data behind disguises: a transducer that keeps offsets, detection on its output, spans mapped back.

Plain identifiers are found as they stand (``PATTERNS``; leftmost, each kind for itself, failing ones dropped). The text
is then rewritten by a transducer whose every step says which characters of the text an output character came from:

1. characters: homoglyphs, compatibility forms (wide, mathematical, circled) and digits of any script become ASCII, invisible
   characters go, and a letter that looks like a digit becomes one between digits;
2. words: bracketed, and between words that end in a domain plain, forms of "at" and "dot" become ``@`` and ``.``; seven or
   more spelled digits in a row become digits, "plus" before them ``+``.

Identifiers found in the output that hold a rewritten character are mapped to the characters they came from. They are
added unless a plain identifier of their kind covers them; plain ones always stay.

Only stretches around a rewritten character are looked at a second time. Every text is read whole where it lies; nothing
is shuffled. Offsets are code points, ends exclusive. Null and empty texts hold nothing; repeated rows and rows with a null
id are read alike; other columns are not read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetloom.llm.words import pieces

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Letters of other scripts that look like the Latin letters below them.
HOMOGLYPHS = dict(zip("АВЕКМНОРСТУХаеорсухіјѕԁһԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορτυχɡɩոօ",
                      "ABEKMHOPCTYXaeopcyxijsdhqwABEZHIKMNOPTYXavoptuxgino"))
#: Characters that take no room.
INVISIBLE = "­​‌‍⁠﻿"
#: Letters that pass for a digit between digits.
DIGIT_LIKE = {"O": "0", "o": "0", "l": "1", "I": "1"}
#: Names of the digits in English, German, French and Spanish.
DIGIT_NAMES = {
    "0": "zero oh null zéro cero", "1": "one eins un uno", "2": "two zwei zwo deux dos", "3": "three drei trois tres",
    "4": "four vier quatre cuatro", "5": "five fünf cinq cinco", "6": "six sechs seis", "7": "seven sieben sept siete",
    "8": "eight acht huit ocho", "9": "nine neun neuf nueve",
}
LEAST_SPELLED = 7
_DIGIT = {name: digit for digit, names in DIGIT_NAMES.items() for name in names.split()}


def _any_of(names: list[str]) -> str:
    """A pattern of the names in which common beginnings are tried once."""
    heads = sorted({n[:1] for n in names}, reverse=True)
    parts = [c + _any_of([n[1:] for n in names if n[:1] == c]) if c else "" for c in heads]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


_NAME = _any_of(list(_DIGIT))
_GAP = r"[\x20,.\-]{1,3}"
_SPELLED = re.compile(rf"(?<!\w)(?:(plus){_GAP})?((?:(?:{_NAME}|[0-9]){_GAP}){{{LEAST_SPELLED - 1},}}(?:{_NAME}|[0-9]))(?!\w)", re.I)
_ONE_SPELLED = re.compile(rf"({_NAME}|[0-9])({_GAP}|$)", re.I)
_SPELLED_HINT = re.compile(rf"\b{_NAME}{_GAP}(?:{_NAME}|[0-9]){_GAP}(?:{_NAME}|[0-9])\b", re.I)
_SIGN = r"[\[({<]\x20?(?:(at|@)|dot|punkt|point|punto|\.)\x20?[\])}>]"
_BRACKETED, _BRACKETED_HINT = re.compile(rf"\x20?{_SIGN}\x20?", re.I), re.compile(_SIGN, re.I)
#: Last labels that are believed without brackets; none of them is an English word.
PLAIN_ENDINGS = ("com", "org", "net", "edu", "gov", "mil", "info", "biz", "io", "dev", "co", "eu", "uk", "de", "fr", "es", "ch",
                 "nl", "pl", "ru", "se", "dk", "fi", "br", "mx", "jp", "cn", "au", "ca", "example", "invalid")
#: Words around a bare "at", a domain of labels joined by "dot", and a last label of those above.
_BARE = re.compile(r"(?<![\w.])[A-Za-z0-9_%+-]{1,64}(?:(?:\.|\x20dot\x20|_dot_)[A-Za-z0-9_%+-]{1,64}){0,4}"
                   r"(\x20at\x20|_at_|@|\x20@\x20)"
                   r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20dot\x20|_dot_)[A-Za-z0-9-]{1,63}){0,4}"
                   rf"(?:\x20dot\x20|_dot_)(?:{'|'.join(PLAIN_ENDINGS)})(?![\w-])", re.I)
_BARE_IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?:(?:\.|\x20dot\x20)[0-9]{1,3}){3}(?![\w.])", re.I)
_BARE_STEP = re.compile(r"\x20at\x20|_at_|\x20@\x20|\x20dot\x20|_dot_", re.I)
_DOT_HINT = re.compile(r"\x20dot\x20|_dot_", re.I)
_REACH = 320


def disguised_identifiers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``id_col`` and ``found``: every identifier with kind, start, end, whether it is plain, and the text it
    stands for; plain ones first, each in order of kind and place."""
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body"))
    kind = dict(rows.dtypes)["doc"]
    schema = f"doc {kind}, found array<struct<kind: string, start: long, end: long, plain: boolean, value: string>>"
    return rows.mapInArrow(_search, schema).withColumnRenamed("doc", id_col)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_()),
                      ("value", pa.string())])
    for batch in batches:
        for piece in pieces(batch, "body"):
            rows = [identifiers(text or "") for text in piece.column("body").to_pylist()]
            found = [[dict(zip(("kind", "start", "end", "plain", "value"), x)) for x in row] for row in rows]
            yield pa.RecordBatch.from_arrays([piece.column("doc"), pa.array(found, pa.list_(span))],
                                             names=["doc", "found"])


def identifiers(text: str) -> list[tuple[str, int, int, bool, str]]:
    """(kind, start, end, plain, value) of the identifiers of a text."""
    plain = [(kind, a, b) for kind in KINDS for a, b in _FIND[kind](text)]
    held: dict[str, list[tuple[int, int]]] = {}
    for kind, a, b in plain:
        held.setdefault(kind, []).append((a, b))
    added = {x[:3]: x for x in _disguised(text) if not any(a <= x[1] and x[2] <= b for a, b in held.get(x[0], ()))}
    rest = sorted(added.values(), key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
    return [(kind, a, b, True, text[a:b]) for kind, a, b in plain] + [(k, a, b, False, v) for k, a, b, v in rest]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Local part, at sign and domain, found from the at sign, so that long runs of letters cost nothing."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            after = domain.end()
            yield start, after
        else:
            after = max(after, at + 1)
        at = text.find("@", max(after, at + 1))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 16:
            continue
        digits = [int(c) for c in m.group() if c.isdigit()] if m.end() - m.start() <= 37 else []
        if 16 <= len(digits) <= 19:
            doubled = [x * 2 - 9 * (x > 4) for x in digits[-2::-2]]
            if (sum(doubled) + sum(digits[::-2])) % 10 == 0:
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                yield m.span()


_FIND = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}


class _Output:
    """A rewritten stretch: its characters, where each came from, and which were rewritten."""

    __slots__ = ("text", "start", "end", "new")

    def __init__(self, text: str, start: list[int], end: list[int], new: list[bool]) -> None:
        self.text, self.start, self.end, self.new = text, start, end, new

    def rewritten(self, steps: list[tuple[int, int, str]]) -> _Output:
        """Replace [a, b) by a string for each step; its characters come from all of [a, b)."""
        if not steps:
            return self
        parts, start, end, new, at = [], [], [], [], 0
        for a, b, put in steps:
            parts += self.text[at:a], put
            start += self.start[at:a] + [self.start[a]] * len(put)
            end += self.end[at:a] + [self.end[b - 1]] * len(put)
            new += self.new[at:a] + [True] * len(put)
            at = b
        parts.append(self.text[at:])
        return _Output("".join(parts), start + self.start[at:], end + self.end[at:], new + self.new[at:])


@lru_cache(maxsize=1)
def _characters() -> dict[str, str]:
    """The characters that the first step rewrites: from Unicode's own tables and the homoglyphs."""
    table = dict(HOMOGLYPHS) | dict.fromkeys(INVISIBLE, "")
    for code in range(0x80, sys.maxunicode + 1):
        c = chr(code)
        if c in table or 0xD800 <= code < 0xE000:
            continue
        digit = unicodedata.digit(c, None)
        plain = str(digit) if digit is not None else unicodedata.normalize("NFKC", c)
        if plain != c and len(plain) <= 4 and plain.isascii() and plain.isprintable() and plain.strip() == plain != "":
            table[c] = plain
    return table


def _odd(text: str) -> re.Pattern | None:
    """A pattern of the text's characters that the first step rewrites."""
    some = set() if text.isascii() else set(text) & _characters().keys()
    return re.compile(f"[{''.join(sorted(some))}]") if some else None


_LIKE_DIGIT = re.compile(r"(?<=[0-9])[OolI](?=[0-9])")


def _disguised(text: str) -> Iterator[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the identifiers that hold a rewritten character."""
    for a, b in _stretches(text):
        out = _bare(_bracketed(_spelled(_plain_characters(_Output(
            text[a:b], list(range(a, b)), list(range(a + 1, b + 1)), [False] * (b - a))))))
        for kind in KINDS:
            for p, q in _FIND[kind](out.text):
                if any(out.new[p:q]):
                    yield kind, out.start[p], out.end[q - 1], out.text[p:q]


def _stretches(text: str) -> list[tuple[int, int]]:
    """Stretches around all that a step could rewrite, cut at white space."""
    marks = []
    for hint in (_odd(text), _LIKE_DIGIT, _BRACKETED_HINT, _SPELLED_HINT, _DOT_HINT):
        marks += [m.span() for m in hint.finditer(text)] if hint else []
    out: list[list[int]] = []
    for a, b in sorted(marks):
        a, b = max(0, a - _REACH), min(len(text), b + _REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(_edge(text, a, -1), _edge(text, b, 1)) for a, b in out]


def _edge(text: str, at: int, step: int) -> int:
    """The next place that no identifier reaches across: a line end or a blank, at most a few hundred characters on."""
    far = at + step * _REACH
    while 0 < at < len(text) and at != far and not text[at].isspace():
        at += step
    return at


def _plain_characters(out: _Output) -> _Output:
    if some := _odd(out.text):
        table = _characters()
        out = _without_gaps(out.rewritten([(*m.span(), table[m.group()]) for m in some.finditer(out.text)]))
    return out.rewritten([(*m.span(), DIGIT_LIKE[m.group()]) for m in _LIKE_DIGIT.finditer(out.text)])


def _without_gaps(out: _Output) -> _Output:
    """A character whose neighbour went belongs to what was rewritten."""
    for k in range(1, len(out.text)):
        if out.start[k] > out.end[k - 1]:
            out.new[k] = out.new[k - 1] = True
    return out


def _spelled(out: _Output) -> _Output:
    steps = []
    for m in _SPELLED.finditer(out.text):
        if m.group(2)[0].isdigit() and not re.search(rf"(?:{_NAME})", m.group(2), re.I):
            continue
        if m.group(1):
            steps.append((m.start(), m.start(2), "+"))
        for one in _ONE_SPELLED.finditer(out.text, m.start(2), m.end(2)):
            name = one.group(1).lower()
            steps.append((one.start(), one.end(), _DIGIT.get(name, name)))
    return out.rewritten(steps)


def _bracketed(out: _Output) -> _Output:
    return out.rewritten([(*m.span(), "@" if m.group(1) else ".") for m in _BRACKETED.finditer(out.text)])


def _bare(out: _Output) -> _Output:
    steps = []
    for pattern in (_BARE, _BARE_IP):
        for m in pattern.finditer(out.text):
            steps += [(*s.span(), "@" if "at" in s.group().lower() or "@" in s.group() else ".")
                      for s in _BARE_STEP.finditer(out.text, m.start(), m.end())]
    return out.rewritten(sorted(set(steps)))
