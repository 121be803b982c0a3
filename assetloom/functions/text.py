"""Text and key helpers as Column expressions (no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same set for a Java regex: Unicode white space and the four separators.
SPACE_CLASS = r"\s\x1C-\x1F"


def strip(c: Column) -> Column:
    """Drop white space at both ends."""
    return F.btrim(c, F.lit(SPACES))


def word_count(c: Column) -> Column:
    """Number of white-space separated words; null for null."""
    return F.regexp_count(c, F.lit(f"(?U)[^{SPACE_CLASS}]+"))


def has_words(minimum: int, *columns: Column) -> Column:
    """True where every column is present and holds at least ``minimum`` words."""
    keep = F.lit(True)
    for c in columns:
        keep = keep & F.coalesce(word_count(c) >= minimum, F.lit(False))
    return keep


def normal_case(c: Column) -> Column:
    return F.lower(strip(c))


def one_line(c: Column) -> Column:
    return F.replace(strip(c), F.lit("\n"), F.lit(" "))


def slug(c: Column) -> Column:
    """Lower case, every character but letters and numbers becomes ``-``, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "-"), "^-+|-+$", "")


def path_parts(c: Column) -> Column:
    """The non-empty parts of a slash-separated path."""
    return F.filter(F.split(c, "/"), lambda part: part != "")


def clean_path(c: Column) -> Column:
    """Collapse repeated slashes and drop those at the ends."""
    return F.array_join(path_parts(c), "/")


def join_keys(*columns: Column) -> Column:
    """Composite partition key ``a|b``."""
    return F.concat_ws("|", *columns)


def typed_key(kind: Column, value: Column) -> Column:
    return F.concat(kind, F.lit(":"), value)


def parse_typed_key(c: Column) -> Column:
    """``type:value`` as a struct; the value may hold further colons, a key without one is an error."""
    parts = F.split(c, ":", 2)
    checked = F.when(F.instr(c, ":") > 0, parts).otherwise(
        F.raise_error(F.concat(F.lit("partition key is not <type>:<value>: "), c)).cast("array<string>")
    )
    return F.struct(checked[0].alias("kind"), checked[1].alias("value"))


def content_key(*columns: Column) -> Column:
    """A digest to group or join long texts by; null is a value of its own."""
    cells = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
             for c in columns]
    return F.sha2(F.concat(*cells), 256)
