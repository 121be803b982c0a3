"""Quality rules and robust multivariate outliers, with DataFrame functions only.

Base rules: too few words, or too many words in repeated runs of five. The rows that pass them are judged per language and
source by a minimum covariance determinant estimate of their transformed statistics: from medians and quartile ranges on,
each concentration step keeps the ``SUPPORT`` share of rows with the smallest distances and takes mean and covariance of
those. A last step re-estimates from all rows within the cutoff. A row is kept if its squared Mahalanobis distance is at
most ``CUTOFF``.

Scale: statistics are one row a document and stay a narrow table. Estimates are grouped sums with partial sums; a distance
quantile comes from counts in steps of the logarithm, so no group is sorted or collected and reruns agree. A group of less
than ``LEAST_ROWS`` rows is judged with the other small groups of its language, and those, if still too few, with the small
rest of all languages; a rest below that is judged by the estimate of all rows, and kept only where those too are fewer. A
ridge of ``FLOORS`` squared keeps a constant statistic from dividing by zero; it is what one symbol, repeated run or line
makes in a text of usual length, so that rows with a statistic that most rows lack are not hidden by it.

Nulls and empty texts have no words and fail the base rules. Null languages and sources are groups of their own. Repeated
rows count again and each come back. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetloom.llm.words import WORD
from assetloom.session import checkpointed

SUPPORT = 0.75
#: Chi-square with five degrees of freedom at 0.999.
CUTOFF = 20.515
#: 0.75 over the chance that chi-square with seven degrees is below the 0.75 quantile with five: what a covariance of the
#: inner 0.75 lacks.
CONSISTENCY = 1.41
STEPS = 4
LEAST_ROWS = 50
FLOORS = (0.1, 0.05, 0.03, 0.35, 0.1)
_N = len(FLOORS)
_RUN = 5
_POOL = "all rows"


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    spaces = r"[\x20\x09-\x0D]+"
    bare = F.btrim(F.coalesce(text_col, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, spaces))
    cut = docs.withColumn("_words", words).withColumn("_lines", F.filter(
        F.split(F.coalesce(text_col, F.lit("")), "\n"), lambda x: x.rlike(WORD)))
    at = F.sequence(F.lit(0), F.size("_words") - _RUN)
    runs = F.when(F.size("_words") >= _RUN, F.transform(at, lambda i: F.xxhash64(
        *[F.get("_words", i + k) for k in range(_RUN)])))
    counted = cut.withColumn("_runs", runs).withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text_col, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")})
    repeated = counted.withColumn("_sorted", F.when(
        F.size("_runs") > F.size(F.array_distinct("_runs")),
        F.sort_array(F.transform("_runs", lambda x, i: F.struct(x.alias("run"), i.alias("at"))))))
    pairs = repeated.withColumn("_at", F.sort_array(F.transform(F.filter("_sorted", lambda x, i: (
        x["run"].eqNullSafe(F.get("_sorted", i - 1)["run"]) | x["run"].eqNullSafe(F.get("_sorted", i + 1)["run"]))),
        lambda x: x["at"])))
    covered = F.aggregate(
        F.transform("_at", lambda x, i: F.least(F.lit(_RUN), F.coalesce(F.get("_at", i + 1) - x, F.lit(_RUN)))),
        F.lit(0), lambda total, x: total + x)
    return pairs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).withColumn(
        "n_symbols", F.coalesce("n_symbols", F.lit(0).cast("long"))).drop(
        "_words", "_lines", "_runs", "_sorted", "_at")


def quality_outliers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source") -> DataFrame:
    """Every row: ``id_col``, the statistics, ``base_failed``, ``distance`` (squared; null where none) and ``kept``."""
    named = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("body"), F.col(lang_col).alias("lang"),
                        F.col(source_col).alias("source"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = checkpointed(text_statistics(named, "body").drop("body").withColumn("base_failed", failed))
    vectors = checkpointed(_grouped(rows.where("NOT base_failed").withColumns(
        {f"x{i}": x for i, x in enumerate(_transformed())})))
    grouped = vectors.where("part IS NOT NULL")
    n, n_grouped = vectors.agg(F.count(F.lit(1)), F.count("part")).first()
    if n_grouped < n and n >= LEAST_ROWS:
        grouped = grouped.unionByName(vectors.withColumn("part", F.lit(_POOL)))
    estimate = _distances(vectors.withColumn("part", F.coalesce("part", F.lit(_POOL))), _fit(grouped))
    far = F.col("distance") > CUTOFF
    columns = ["doc", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance"]
    judged = estimate.withColumn("kept", ~F.coalesce(far, F.lit(False)))
    rejected = rows.where("base_failed").withColumns({"distance": F.lit(None).cast("double"), "kept": F.lit(False)})
    return judged.select(*columns, "kept").unionByName(rejected.select(*columns, "kept")).withColumnRenamed("doc", id_col)


def _transformed() -> list[Column]:
    return [F.log1p("n_words"), F.log(F.col("word_chars") / F.col("n_words")),
            F.sqrt(F.col("n_symbols") / F.col("word_chars")), F.log1p("n_dup_lines"),
            F.sqrt(F.col("n_repeat_words") / F.col("n_words"))]


def _grouped(rows: DataFrame) -> DataFrame:
    """``part``: the group of each row; null where too few are left over."""
    for size, key in (("own", ["lang", "source"]), ("rest", ["lang"]), ("all", [])):
        if size == "own":
            whole, part = rows.withColumn("part", F.lit(None).cast("string")), F.to_json(F.array(
                F.coalesce("lang", F.lit("\x00")), F.coalesce("source", F.lit("\x00"))))
        elif size == "rest":
            part = F.to_json(F.array(F.coalesce("lang", F.lit("\x00"))))
        else:
            part = F.lit("[]")
        open_rows = whole.where("part IS NULL").withColumn("part", part)
        large = open_rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_ROWS)
        named = large.select(F.col("part").alias("named"))
        found = whole.withColumn("would", F.coalesce("part", part)).join(named, F.col("would") == F.col("named"), "left")
        whole = found.withColumn("part", F.coalesce("part", "named")).drop("would", "named")
    return whole


def _fit(grouped: DataFrame) -> DataFrame:
    """Mean and lower triangular root of the covariance of each group."""
    quartiles = grouped.groupBy("part").agg(*[
        F.percentile(F.round(f"x{i}", 2), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i in range(_N)])
    start = [F.get(f"q{i}", 1).alias(f"m{i}") for i in range(_N)]
    for i in range(_N):
        for j in range(i + 1):
            spread = F.greatest((F.get(f"q{i}", 2) - F.get(f"q{i}", 0)) / 1.349, F.lit(FLOORS[i]))
            start.append((spread if i == j else F.lit(0.0)).alias(f"l{i}{j}"))
    model = checkpointed(quartiles.select("part", *start))
    for _ in range(STEPS):
        near = _distances(grouped, model).withColumn("step", F.floor(F.log(F.col("distance") + 1e-6) * 16))
        inner = near.join(_quantile(near), "part").where("step <= limit")
        model = checkpointed(_moments(inner, CONSISTENCY))
    return checkpointed(_moments(_distances(grouped, model).where(F.col("distance") <= CUTOFF), 1.0))


def _quantile(near: DataFrame) -> DataFrame:
    """The step of the distances below which the ``SUPPORT`` share of a group lies."""
    steps = near.groupBy("part", "step").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("part")
    upto = steps.withColumn("upto", F.sum("n").over(group.orderBy("step"))).withColumn("of", F.sum("n").over(group))
    return upto.where(F.col("upto") >= SUPPORT * F.col("of")).groupBy("part").agg(F.min("step").alias("limit"))


def _moments(rows: DataFrame, factor: float) -> DataFrame:
    """Mean and Cholesky root of the covariance, times the factor, plus the ridge."""
    found = rows.groupBy("part").agg(
        *[F.avg(f"x{i}").alias(f"m{i}") for i in range(_N)],
        *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i in range(_N) for j in range(i + 1)])
    for i in range(_N):
        for j in range(i + 1):
            value = F.col(f"c{i}{j}") * factor + (FLOORS[i] ** 2 if i == j else 0.0)
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            found = found.withColumn(f"l{i}{j}", F.sqrt(value) if i == j else value / F.col(f"l{j}{j}"))
    return found.select("part", *[f"m{i}" for i in range(_N)], *[f"l{i}{j}" for i in range(_N) for j in range(i + 1)])


def _distances(rows: DataFrame, model: DataFrame) -> DataFrame:
    """The rows with their squared distance, by solving for the root; null without a group."""
    solved = rows.join(model, "part", "left")
    for i in range(_N):
        value = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"z{k}")
        solved = solved.withColumn(f"z{i}", value / F.col(f"l{i}{i}"))
    squares = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, _N)), F.col("z0") * F.col("z0"))
    return solved.withColumn("distance", squares).select(*rows.columns, "distance")
