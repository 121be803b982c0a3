"""The registered queries of the subpackage and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetloom.llm.decontamination import contaminated
from assetloom.llm.disguised_identifiers import KINDS, disguised_identifiers
from assetloom.llm.languages import held_out, predict_language
from assetloom.llm.mixing import mix_sources
from assetloom.llm.near_duplicates import near_duplicate_classes
from assetloom.llm.outliers import quality_outliers
from assetloom.llm.page_text import main_text
from assetloom.llm.periodic_runs import periodic_runs
from assetloom.llm.repeats import remove_repeated_passages
from assetloom.llm.suffix_tree import suffix_tree_scores
from assetloom.llm.token_alignment import aligned_tokens
from assetloom.llm.tool_calls import link_tool_calls
from assetloom.llm.url_lists import host_of, judged
from assetloom.llm.words import WORD
from assetloom.plans.registry import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


@query()
def op1_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op2_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_outliers(table(spark, sf_dir, "documents"))


@query()
def op3_super_kmer_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_passages(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def page_list_entries(pages: DataFrame) -> DataFrame:
    """A dated list log that Spark derives from the pages: hosts, their domains and first paths come and go."""
    seen = pages.select(host_of(F.col("url")).alias("host"), "page_id", F.lower("url").alias("url")).where("host != ''")
    domain = F.regexp_replace("host", r"^(www|m|blog)\.", "")
    prefix = F.concat("host", F.lit("/"), F.regexp_extract("url", r"^[a-z]+://[^/]*/([^/?#]*)", 1))
    kinds = seen.select("page_id", F.explode(F.array(
        F.struct(F.lit("host").alias("kind"), F.lit("block").alias("verdict"), F.col("host").alias("pattern")),
        F.struct(F.lit("domain").alias("kind"), F.lit("block").alias("verdict"), domain.alias("pattern")),
        F.struct(F.lit("prefix").alias("kind"), F.lit("allow").alias("verdict"), prefix.alias("pattern")))).alias("e"))
    sums = kinds.groupBy("e.kind", "e.verdict", "e.pattern").agg(
        F.min("page_id").alias("low"), F.max("page_id").alias("high"), F.count(F.lit(1)).alias("n"))
    first = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("low") % 97).cast("int"))
    second = F.date_add(first, (F.lit(20) + F.col("n") % 60).cast("int"))
    third = F.date_add(second, (F.lit(10) + F.col("high") % 90).cast("int"))
    dated = F.explode(F.array(
        F.struct(first.alias("on_date"), F.lit("add").alias("action")),
        F.struct(second.alias("on_date"), F.lit("remove").alias("action")),
        F.struct(third.alias("on_date"), F.lit("add").alias("action")))).alias("d")
    return sums.select(F.concat("kind", F.lit("s")).alias("list"), "verdict", "kind", "pattern", dated).select(
        "list", "verdict", "kind", "pattern", "d.on_date", "d.action")


OP4_SQL = r"""
WITH page AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS fetched_on,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS host,
         list_filter(string_split(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '')
           AS steps
  FROM pages),
named AS (
  SELECT page_id, 'host' AS kind, 'block' AS verdict, host AS pattern FROM page WHERE host <> ''
  UNION ALL SELECT page_id, 'domain', 'block', regexp_replace(host, '^(www|m|blog)\.', '') FROM page WHERE host <> ''
  UNION ALL SELECT page_id, 'prefix', 'allow',
    host || '/' || regexp_extract(lower(url), '^[a-z]+://[^/]*/([^/?#]*)', 1) FROM page WHERE host <> ''),
sums AS (
  SELECT kind, verdict, pattern, min(page_id) AS low, max(page_id) AS high, count(*) AS n FROM named GROUP BY ALL),
days AS (
  SELECT *, DATE '2024-01-01' + CAST(low % 97 AS INTEGER) AS d1 FROM sums),
days2 AS (
  SELECT *, d1 + CAST(20 + n % 60 AS INTEGER) AS d2 FROM days),
stays AS (
  SELECT kind, verdict, pattern, d1 AS valid_from, d2 AS valid_to FROM days2
  UNION ALL SELECT kind, verdict, pattern, d2 + CAST(10 + high % 90 AS INTEGER), NULL FROM days2),
keys AS (
  SELECT page_id, url, fetched_on, 'host' AS kind, host AS pattern FROM page WHERE host <> ''
  UNION ALL SELECT page_id, url, fetched_on, 'domain', array_to_string(string_split(host, '.')[i:], '.')
    FROM page, LATERAL (SELECT unnest(range(1, len(string_split(host, '.')) + 1)) AS i) WHERE host <> ''
  UNION ALL SELECT page_id, url, fetched_on, 'prefix', array_to_string(list_concat([host], list_slice(steps, 1, i)), '/')
    FROM page, LATERAL (SELECT unnest(range(0, len(steps) + 1)) AS i) WHERE host <> ''),
met AS (
  SELECT k.*, s.verdict, s.valid_from, row_number() OVER (PARTITION BY k.page_id, k.url ORDER BY length(k.pattern) DESC,
    s.verdict DESC, s.valid_from DESC, k.kind DESC) AS place, count(*) OVER (PARTITION BY k.page_id, k.url) AS n_active
  FROM keys k JOIN stays s ON k.kind = s.kind AND k.pattern = s.pattern
    AND k.fetched_on >= s.valid_from AND (s.valid_to IS NULL OR k.fetched_on < s.valid_to))
SELECT p.page_id, p.url, p.fetched_on, coalesce(m.n_active, 0) AS n_active, m.kind || 's' AS list, m.pattern,
       m.valid_from AS listed_since, coalesce(m.verdict <> 'block', true) AS allowed
FROM page p LEFT JOIN met m ON p.page_id = m.page_id AND p.url = m.url AND m.place = 1
"""


@query(OP4_SQL)
def op4_url_list_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int"))
    return judged(pages.withColumn("fetched_on", fetched), page_list_entries(pages))


@query()
def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


@query()
def op6_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = suffix_tree_scores(table(spark, sf_dir, "documents"), ~held_out("doc_id", 5))
    return scores.withColumn("held_out", held_out("doc_id", 5))


@query()
def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))[0]


@query()
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predicted = predict_language(docs, docs.where(~held_out("doc_id", 3)))
    return predicted.select("doc_id", held_out("doc_id", 3).alias("held_out"), "lang_pred", "score")


TOOL_SCHEMAS = [
    ("search", '{"type":"object","required":["query","limit"],"properties":{"query":{"type":"string","minLength":1},'
               '"limit":{"type":"integer","minimum":1,"maximum":10},"after":{"type":"object"}},'
               '"additionalProperties":false}'),
    ("measure", '{"type":"object","required":["query","words"],"properties":{"query":{"type":"string"},'
                '"words":{"type":"integer","minimum":5},"after":{"type":"object"}}}'),
]


def conversation_calls(turns: DataFrame) -> DataFrame:
    """A tool call for every user turn; it needs the call of the turn half as far, if that was one."""
    after = F.when(F.col("turn") >= 2, F.struct(F.concat_ws("-", "conv_id", F.floor(F.col("turn") / 2)).alias("ref")))
    short = F.length("text") % 3
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    return turns.where("role = 'user'").select(
        "conv_id", F.concat_ws("-", "conv_id", "turn").alias("call_id"), F.col("turn").alias("position"),
        F.when(short == 0, "search").when(short == 1, "measure").otherwise("lookup").alias("name"),
        F.when(short == 1, F.to_json(F.struct(words.alias("words"), F.col("text").alias("query"), after.alias("after"))))
        .otherwise(F.to_json(F.struct(F.col("text").alias("query"), (F.col("turn") % 7).alias("limit"),
                                      after.alias("after")))).alias("arguments"))


@query()
def op9_tool_call_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    results = turns.where("role = 'assistant'").select(
        "conv_id", F.concat_ws("-", "conv_id", F.col("turn") - 1).alias("call_id"), F.col("turn").alias("position"),
        F.col("text").alias("content"))
    schemas = spark.createDataFrame(TOOL_SCHEMAS, "name string, schema string")
    return link_tool_calls(conversation_calls(turns), results, schemas)


@query()
def op10_prob_minhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicate_classes(table(spark, sf_dir, "documents"))
    return classes.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """The documents with a periodic tail in every tenth: from a word on, some words repeat to the end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    split = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("w"))
    placed = split.withColumn("n", F.size("w")).withColumn("a", F.expr("int(g % n)")).withColumn(
        "p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    tail = F.expr("slice(flatten(array_repeat(slice(w, a + 1, p), int(ceil((n - a) / p)))), 1, n - a)")
    periodic = F.array_join(F.concat(F.expr("slice(w, 1, a)"), tail), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, periodic).otherwise(F.col("text")).alias("text"))


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))
    # Runs are in order of start, then period, so the first of equal exponents stays.
    greater = lambda best, r: best.isNull() | (r.length * best.period > best.length * r.period)
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(greater(b, r), r).otherwise(b))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"))


@query()
def op12_disguised_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disguised_identifiers(table(spark, sf_dir, "documents"))
    plain = F.filter("found", lambda x: x.plain)
    number = lambda k: F.size(F.filter(plain, lambda x: x.kind == k)).cast("long")
    counts = [number(k).alias(f"n_{k}") for k in KINDS]
    # "card" < "email" < "ip" < "phone" is not the order in which the kinds are listed.
    place = lambda x: F.array_position(F.array(*map(F.lit, KINDS)), x.kind)
    ordered = F.array_sort(F.transform("found", lambda x: F.struct(
        place(x).alias("place"), x.start.alias("start"), x.end.alias("end"), x.kind.alias("kind"))))
    listed = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")
    return found.select(
        "doc_id", *counts, F.sha2(listed(plain).cast("binary"), 256).alias("base_sha256"),
        listed(ordered).alias("spans"), (F.size("found") - F.size(plain)).cast("long").alias("n_added"))


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_tokens(table(spark, sf_dir, "documents")).withColumnRenamed("groups", "groups_sha256")
