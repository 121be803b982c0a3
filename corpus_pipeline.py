"""The training-data pipeline over ``documents``: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetloom.llm.decontamination import contaminated
from assetloom.llm.languages import held_out, predict_language
from assetloom.llm.mixing import mix_sources
from assetloom.llm.near_duplicates import near_duplicate_classes
from assetloom.llm.repeats import remove_repeated_passages
from assetloom.session import scratch

#: Classes and cut texts come from whole texts by Arrow functions, which SQL cannot express.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the operator accepts: with a letter, and scored as texts of the learned languages are."""
    scored = predict_language(docs, docs.where(~held_out("doc_id", 3)), keep_columns=True)
    return scored.where("accepted").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class; documents without an id stay."""
    classes = near_duplicate_classes(docs)
    kept = classes.where("doc_id = class_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words that an earlier document holds; what nothing is left of goes."""
    cut = remove_repeated_passages(docs, keep_columns=True).where("n_removed = 0 OR kept_text != ''")
    less = F.col("n_removed") > 0
    return cut.select("doc_id", F.when(less, F.col("kept_text")).otherwise(F.col("text")).alias("text"), "lang", "source",
                      F.when(less, F.length("kept_text")).otherwise(F.col("n_chars")).alias("n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contaminated(docs, items).select(F.col("doc_id").alias("found")).distinct()
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("found")), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes, with the size and target of its source."""
    return mix_sources(docs)[0]


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminate),
    ("source_mix", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
