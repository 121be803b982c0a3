"""Main text of web pages by tag path ratios.

A page is cut into text nodes, each with its root-to-leaf path of tags (inline formatting left out). For every path the
text length and the punctuation of its nodes are summed and divided by the number of nodes. Both ratios are smoothed over
the nodes in page order, fused as the length ratio times one plus the punctuation ratio, and a path is content where its
mean reaches ``SHARE`` of the largest or a standard deviation. Headings, lists, tables and the like are content too where
their container holds a content path. Menus, headers and footers of the page, forms and what is not shown never count, by
tag, role or style. Sidebars, notices, adverts and the like do not count by class or id, unless the element holds so much of
the page's text (``MOST``), or a ``main``, that it is a wrapper which only mentions them. Blocks of reader comments never
count, however long, unless the page's first article or headline lies in them. A form counts only where it wraps an article,
the first headline, or paragraphs that are nearly all of the page. In a page with an
``article`` or ``main`` that has text, the rest of the page does not count either, unless it has both the better path and
more text.

Null and empty pages give an empty text. Unclosed tags, stray brackets and broken references are read as browsers do, as
far as text goes. Repeated rows give repeated rows; columns other than those named are not read. A page is one row, so no
group grows; whole pages are read.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetloom.llm.words import pieces

SHARE = 0.2
#: From which share of the page's text on a name does not make noise: by whether all words of a class or id are noise, and
#: whether the element holds an article.
MOST = {(True, False): 0.9, (True, True): 0.5, (False, False): 0.5, (False, True): 0.2}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|title|select)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|(?P<broken></?[a-zA-Z][^>]*(?:>|\Z))", re.S | re.I)
#: As _TOKEN where quotes hide no brackets.
_PLAIN_TOKEN = re.compile(_TOKEN.pattern.replace(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+", "[^>]*+"), re.S | re.I)
_ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_WORD_OF_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Tags and names that decide how a page is read.
_INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                    "strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_LEFT_OUT = frozenset("nav footer aside button head dialog menu object audio video canvas map fieldset".split())
_CONTAINERS = frozenset("html body div section article main td".split())
_ATTACHED = frozenset("h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption caption p summary".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_STOPS = frozenset("ul ol dl table tr td th div section article main body html".split())
_NOISE = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie "
                   "cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup "
                   "share sharing social related recommended recommendations sidebar widget menu nav navbar navigation "
                   "breadcrumb breadcrumbs masthead footer login search pagination pager toolbar skip alert".split())
_READERS = frozenset("comment comments reply replies disqus respond responses discussion".split())
_PARTS = frozenset("list thread threads area section container wrap wrapper block box item items body content form feed "
                   "bar panel row inner holder group".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
_PUNCTUATION = re.compile(r"[.,;:!?¡¿…。，、；：！？]")
_SPACE = re.compile(r"\s+")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, url_col, text, n_chars`` of every page."""
    kinds = dict(pages.dtypes)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("body"))
    read = rows.mapInArrow(_reader, f"id {kinds[id_col]}, url {kinds[url_col]}, text string")
    return read.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                       F.length("text").cast("long").alias("n_chars"))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "body"):
            texts = [extract(x.as_py() or "") for x in piece.column("body")]
            yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("url"), pa.array(texts, pa.string())],
                                             names=["id", "url", "text"])


def extract(page: str) -> str:
    """The main text of one page."""
    read = _Page(page)
    nodes = read.without_noise()
    inside = [n for n in nodes if n[2]]
    outside = [n for n in nodes if not n[2]]
    if inside and not (outside and _outweighs(nodes, read)):
        nodes = inside
    if not nodes:
        return ""
    chosen = _chosen([n[1] for n in nodes], [n[0] for n in nodes], read)
    return " ".join(text for text, path, *_ in nodes if path in chosen)


def _outweighs(nodes: list[tuple], page: _Page) -> bool:
    """Whether the text outside articles has the best path and is longer on its content paths."""
    score = _scores([n[1] for n in nodes], [n[0] for n in nodes])
    chosen = _chosen([n[1] for n in nodes], [n[0] for n in nodes], page)
    best, length = [0.0, 0.0], [0, 0]
    for text, path, article, _ in nodes:
        best[article] = max(best[article], score[path])
        length[article] += len(text) if path in chosen else 0
    return best[0] > best[1] and length[0] > length[1]


class _Named:
    """An element that is noise by its name or as a form, unless it wraps the main text: the element of this kind around it,
    what kind of noise it is, whether each word of a class or id is noise, and what lies in it."""

    def __init__(self, around: _Named | None, kind: str, bare: bool = False) -> None:
        self.around, self.kind, self.bare = around, kind, bare
        self.held, self.article, self.main, self.first, self.paragraph = 0, False, False, False, False
        self.noise = False


class _Article:
    """An article or main: the one around it, the named element around it, whether it has text, also as the first."""

    def __init__(self, around: _Article | None, named: _Named | None, main: bool) -> None:
        self.around, self.named, self.main, self.text, self.first = around, named, main, False, False


class _Open(NamedTuple):
    tag: str
    path: int
    noise: bool
    article: _Article | None
    named: _Named | None
    stop: int  # place of the innermost element at which an item's end stops being looked for


def _noisy(tag: str, rest: str, in_article: bool) -> bool:
    """Whether an element is none of the main text."""
    if tag in _LEFT_OUT:
        return True
    if tag == "header":
        return not in_article
    if not rest or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "role" and value.lower() in _ROLES or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return bool(re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", rest), re.I))


def _named(tag: str, rest: str, around: _Named | None) -> _Named | None:
    """The element, if it is a form or a word of its class or id names noise."""
    if tag == "form":
        return _Named(around, "form")
    if not rest or tag in ("html", "body", "main"):
        return None
    values = [next((v for v in values if v), "") for name, *values in _ATTRIBUTE.findall(rest)
              if name.lower() in ("class", "id")]
    for name in (x for value in values for x in value.split()):
        words = [w.lower() for w in _WORD_OF_NAME.findall(name)]
        if any(_one_of(w, _READERS) for w in words) and all(w in _PARTS or _one_of(w, _READERS) for w in words):
            return _Named(around, "readers")
    if tag == "article":
        return None
    noise = [[_one_of(w.lower(), _NOISE) or w.lower() in _READERS for w in _WORD_OF_NAME.findall(v)] for v in values]
    return _Named(around, "name", any(w and all(w) for w in noise)) if any(map(any, noise)) else None


def _one_of(word: str, names: frozenset[str]) -> bool:
    """Whether a word is one of the names, or one of them and the name of a part in one word (``cookiebar``)."""
    return word in names or len(word) < 32 and any(word[:i] in names and word[i:] in _PARTS for i in range(2, len(word)))


class _Page:
    """What is read of a page: ``nodes`` (text, path, whether it lies in an article, named element around it) of each block of
    text in page order, noise by tag, role or style left out; for each path its last tag and its innermost container."""

    def __init__(self, page: str) -> None:
        self.nodes: list[tuple[str, int, bool, _Named | None]] = []
        self.tags, self.homes = [""], [0]
        self._children: dict[tuple[int, str], int] = {}
        self._stack = [_Open("", 0, False, None, None, 0)]
        self._opened: dict[str, list[int]] = defaultdict(list)
        self._named: list[_Named] = []
        self._articles: list[_Article] = []
        self._held: list[str] = []
        self._headline = self._in_article = False
        self._read(page)

    def without_noise(self) -> list[tuple]:
        """The nodes that lie in no element which is noise by its name."""
        total = sum(len(n[0]) for n in self.nodes)
        for text, _, _, named in self.nodes:
            if named:
                named.held += len(text)
        for a in reversed(self._articles):
            if a.around:
                a.around.text |= a.text
            if a.named and a.text:
                a.named.article, a.named.main = True, a.named.main or a.main
                a.named.first |= a.first
        for x in reversed(self._named):
            if x.around:
                x.around.held += x.held
                for what in ("article", "main", "first", "paragraph"):
                    setattr(x.around, what, getattr(x.around, what) or getattr(x, what))
        for x in self._named:
            if x.kind == "readers":
                wraps = x.first
            elif x.kind == "form":
                wraps = x.article or x.first or x.paragraph and x.held >= MOST[True, False] * total
            else:
                wraps = x.main or x.held >= MOST[x.bare, x.article] * total
            x.noise = not wraps or x.around is not None and x.around.noise
        return [n for n in self.nodes if not (n[3] and n[3].noise)]

    def _read(self, page: str) -> None:
        at, tokens = 0, _TOKEN
        while token := tokens.search(page, at):
            if token.start() > at:
                self._held.append(page[at : token.start()])
            at = token.end()
            if token["broken"]:
                tokens = _PLAIN_TOKEN
            if token["tag"]:
                self._tag(token["tag"].lower(), bool(token["end"]), token["rest"])
        self._held.append(page[at:])
        self._flush()

    def _tag(self, tag: str, ends: bool, rest: str) -> None:
        top, inline = self._stack[-1], tag in _INLINE
        if not inline or ends and (top.noise or top.named):
            self._flush()
        if ends:
            if self._opened[tag]:
                self._cut(self._opened[tag][-1])
            return
        if tag in _VOID:
            return
        if not inline:
            self._make_room(tag)
            top = self._stack[-1]
        elif tag != "a" and not rest.strip():
            return self._push(tag, top.noise, top.article, top.named)
        noise = top.noise or _noisy(tag, rest, top.article is not None)
        named = _named(tag, rest, top.named)
        if inline and (noise and not top.noise or named):
            self._flush()
        article = top.article
        if named:
            self._named.append(named)
        elif tag in ("article", "main"):
            article = _Article(article, top.named, tag == "main")
            self._articles.append(article)
        self._push(tag, noise, article, named or top.named)

    def _push(self, tag: str, noise: bool, article: _Article | None, named: _Named | None) -> None:
        top, place = self._stack[-1], len(self._stack)
        path = top.path
        if tag not in _INLINE:
            path = self._children.setdefault((top.path, tag), len(self.tags))
            if path == len(self.tags):
                self.tags.append(tag)
                self.homes.append(path if tag in _CONTAINERS else self.homes[top.path])
        self._opened[tag].append(place)
        self._stack.append(_Open(tag, path, noise, article, named, place if tag in _STOPS else top.stop))

    def _cut(self, place: int) -> None:
        for x in reversed(self._stack[place:]):
            self._opened[x.tag].pop()
        del self._stack[place:]

    def _make_room(self, tag: str) -> None:
        """A block ends an open paragraph; an item ends the open item of its list."""
        ended = max((self._opened[x][-1] for x in ("p", *_CLOSES.get(tag, ())) if self._opened[x]), default=0)
        if ended and ended >= self._stack[-1].stop:
            self._cut(ended)

    def _flush(self) -> None:
        """The block of text that ends here."""
        text = _SPACE.sub(" ", html.unescape("".join(self._held))).strip()
        self._held.clear()
        top = self._stack[-1]
        if not text or top.noise:
            return
        if top.article:
            if not self._in_article:
                self._in_article, a = True, top.article
                while a:
                    a.first, a = True, a.around
            top.article.text = True
        if top.named:
            top.named.paragraph |= bool(self._opened["p"])
            top.named.first |= not self._headline and bool(self._opened["h1"])
        self._headline |= bool(self._opened["h1"])
        self.nodes.append((text, top.path, top.article is not None, top.named))


def _scores(paths: list[int], texts: list[str]) -> dict[int, float]:
    """The fused ratio of each path."""
    names = sorted(set(paths))
    number = {p: i for i, p in enumerate(names)}
    of = np.array([number[p] for p in paths])
    count = np.bincount(of)
    length = np.bincount(of, [len(t) for t in texts]) / count
    marks = np.bincount(of, [len(_PUNCTUATION.findall(t)) for t in texts]) / count
    kernel = np.exp(-0.5 * (np.arange(-2, 3) / 0.75) ** 2)
    weight = np.convolve(np.ones(len(of)), kernel, "full")[2:-2]
    length, marks = (np.bincount(of, np.convolve(x[of], kernel, "full")[2:-2] / weight) / count
                     for x in (length, marks))
    return dict(zip(names, length * (1 + marks)))


def _chosen(paths: list[int], texts: list[str], page: _Page) -> set[int]:
    """The content paths."""
    scores = _scores(paths, texts)
    names, score = list(scores), np.array(list(scores.values()))
    cut = min(SHARE * score.max(), max(score.std(), 1e-9))
    content = {p for p, s in zip(names, score) if s >= cut}
    homes = {page.homes[p] for p in content}
    return content | {p for p in names if page.tags[p] in _ATTACHED and page.homes[p] in homes}
