"""Name filters, namespace templates and partition-key windows as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def glob_regex(pattern: str) -> str:
    """A whole-name regex for a shell wildcard: ``*``, ``?`` and ``[...]`` / ``[!...]``."""
    pieces = re.split(r"(\*|\?|\[[!]?[^\]]+\])", pattern)
    out = []
    for piece in pieces:
        if piece == "*":
            out.append(".*")
        elif piece == "?":
            out.append(".")
        elif len(piece) > 2 and piece[0] == "[" and piece[-1] == "]":
            body = piece[1:-1].replace("\\", "\\\\")
            out.append("[^" + body[1:] + "]" if body[0] == "!" else "[" + body + "]")
        else:
            out.append(re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", piece))
    return "(?s)^" + "".join(out) + "$"


def path_glob_regex(pattern: str) -> str:
    """A regex body for a path wildcard: ``*`` and ``?`` stay within a folder, ``**`` spans folders."""
    out = []
    for piece in re.split(r"(\*\*/|\*\*|\*|\?)", pattern):
        wild = {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}.get(piece)
        out.append(wild or re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", piece))
    return "".join(out)


def like_any(c: Column, patterns: Sequence[str]) -> Column:
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | c.rlike(glob_regex(pattern))
    return hit


def name_filter(c: Column, include: Sequence[str] = ("*",), exclude: Sequence[str] = ()) -> Column:
    """Wildcard include list; an exclude match wins."""
    return like_any(c, include) & ~like_any(c, exclude)


def starts_with_regex(c: Column, patterns: Sequence[str]) -> Column:
    """True where any regex matches from the start of the name; no patterns admit everything."""
    if not patterns:
        return F.lit(True)
    return c.rlike("^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")")


def namespace_of(template: str, namespace: str, tags: Column) -> Column:
    """Resolve ``{namespace}`` and ``{tag:KEY}``: a missing tag is empty, slashes collapse and are
    trimmed, an unknown token is refused, and an empty result falls back to ``namespace``."""
    pieces = []
    for n, text in enumerate(re.split(r"\{([^{}]*)\}", template)):
        if n % 2 == 0:
            if text:
                pieces.append(F.lit(text))
        elif text == "namespace":
            pieces.append(F.lit(namespace))
        elif text.startswith("tag:") and len(text) > len("tag:"):
            pieces.append(F.coalesce(F.element_at(tags, text[len("tag:"):]), F.lit("")))
        else:
            raise ValueError(f"unknown namespace token {{{text}}}")
    joined = F.regexp_replace(F.concat(*pieces) if pieces else F.lit(""), "/+", "/")
    trimmed = F.regexp_replace(joined, "^/|/$", "")
    return F.when(trimmed == "", F.lit(namespace)).otherwise(trimmed)


def nominal_window(key: Column) -> Column:
    """``[start, end)`` of a date key (a day) or a date-hour key (its hour); null for any other key."""
    day = key.rlike(r"^\d{4}-\d{2}-\d{2}$")
    hour = key.rlike(r"^\d{4}-\d{2}-\d{2}[-T]\d{2}:\d{2}(:\d{2})?$")
    day_start = F.when(day, key).try_cast("timestamp_ntz")
    moment = F.when(hour, F.concat(F.substring(key, 1, 10), F.lit(" "), F.substring(key, 12, 8)))
    hour_start = F.date_trunc("hour", moment.try_cast("timestamp_ntz")).cast("timestamp_ntz")
    return F.when(
        day_start.isNotNull(),
        F.struct(day_start.alias("start"), (day_start + F.expr("INTERVAL 1 DAY")).alias("end")),
    ).when(
        hour_start.isNotNull(),
        F.struct(hour_start.alias("start"), (hour_start + F.expr("INTERVAL 1 HOUR")).alias("end")),
    )
