"""Temporal list join: every capture is judged by the list entries active when it was fetched.

Dated entries (a pattern is put on a list or taken off) become validity intervals. A capture has the keys that patterns
may name: its host, every parent domain and every path prefix. Keys and intervals meet by kind, key and the period of
``PERIOD`` days, so an interval join is an equality join and a busy host is spread over its periods; adaptive execution
splits what is still large. The most specific active pattern decides; at equal length a block does.

Nulls: a capture without a time or host meets nothing and is allowed; entries without pattern, date or action are no
entries. Repeated entries count once; an entry taken off on the day it was put on is never active. Repeated captures
each come back. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD = 30
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)"


def intervals(entries: DataFrame) -> DataFrame:
    """``list, verdict, kind, pattern, valid_from, valid_to`` (exclusive, null: still valid) of each stay on a list.

    ``entries``: ``list, verdict`` (block or allow), ``kind`` (host, domain or prefix), ``pattern, on_date, action`` (add or
    remove).
    """
    key = ["list", "verdict", "kind", "pattern"]
    clean = entries.select(*key, "on_date", "action").where(
        "pattern IS NOT NULL AND on_date IS NOT NULL AND action IN ('add', 'remove')").distinct()
    daily = clean.groupBy(*key, "on_date").agg(F.max("action").alias("action"))  # remove comes last on a day
    order = Window.partitionBy(*key).orderBy("on_date")
    return daily.withColumn("valid_to", F.lead("on_date").over(order)).where("action = 'add'").select(
        *key, F.col("on_date").alias("valid_from"), "valid_to")


def host_of(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), HOST, 1)


def judged(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
           date_col: str = "fetched_on") -> DataFrame:
    """Each capture with ``n_active`` entries, the deciding ``list``, ``pattern`` and ``listed_since``, and ``allowed``."""
    rows = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(date_col).alias("at"))
    keyed = rows.distinct().withColumn("period", _period(F.col("at"))).withColumn("k", F.explode(_keys(F.col("url"))))
    keyed = keyed.select("id", "url", "at", "period", F.col("k.kind").alias("kind"), F.col("k.pattern").alias("pattern"))
    valid = intervals(entries)
    last = F.coalesce(F.date_sub("valid_to", 1), F.greatest(F.lit(_horizon(captures, date_col)), F.col("valid_from")))
    spread = valid.withColumn("period", F.explode(F.sequence(_period(F.col("valid_from")), _period(last))))
    met = keyed.join(spread, ["kind", "pattern", "period"]).where(
        "at >= valid_from AND (valid_to IS NULL OR at < valid_to)")
    rank = F.struct(F.length("pattern").alias("size"), F.col("verdict").alias("verdict"),
                    F.col("valid_from").alias("valid_from"), F.col("list").alias("list"), F.col("kind").alias("kind"))
    best = met.groupBy("id", "url", "at").agg(
        F.count(F.lit(1)).alias("n_active"), F.max(rank).alias("top"), F.max_by("pattern", rank).alias("pattern"))
    named = best.select(F.col("id").alias("_id"), F.col("url").alias("_url"), F.col("at").alias("_at"), "n_active",
                        "pattern", "top")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("url") == F.col("_url")) & (F.col("at") == F.col("_at"))
    return rows.join(named, same, "left").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("at").alias(date_col),
        F.coalesce("n_active", F.lit(0)).alias("n_active"), F.col("top.list").alias("list"), "pattern",
        F.col("top.valid_from").alias("listed_since"),
        F.coalesce(F.col("top.verdict") != "block", F.lit(True)).alias("allowed"))


def _period(day: Column) -> Column:
    return F.floor(F.unix_date(day) / PERIOD)


def _horizon(captures: DataFrame, date_col: str):
    """The last day any capture was fetched: open intervals need no periods beyond it."""
    return captures.agg(F.coalesce(F.max(date_col), F.to_date(F.lit("1970-01-01")))).first()[0]


def _keys(url: Column) -> Column:
    """The patterns that could name a URL."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        F.lit("domain").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")))
    steps = F.filter(F.split(F.regexp_extract(F.lower(url), PATH, 1), "/"), lambda x: x != "")
    prefixes = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda i: F.struct(
        F.lit("prefix").alias("kind"),
        F.array_join(F.concat(F.array(host), F.slice(steps, 1, i)), "/").alias("pattern")))
    exact = F.array(F.struct(F.lit("host").alias("kind"), host.alias("pattern")))
    return F.when(host != "", F.concat(exact, domains, prefixes))
