"""Mixing sources to target weights in blocks of fixed length, with DataFrame functions only.

The words of a source, document after document, are cut into blocks of ``block`` words. Sources share all words by
weight; a target stops at ``most`` times the size of its source and the excess is shared again by weight until no target
is above. A source is taken whole as often as its target holds it; a last round takes blocks until the rest is met, and
the slot that meets it is cut, so every source takes its target rounded to whole words. The i-th slot of a round takes the
block that a pseudorandom permutation of the source's block numbers gives to i; each source and round has another one.
One more permutation deals all slots to output shards of ``SHARD_SLOTS`` slots each, so the source counts of the shards are
a multinomial draw under the condition that all shards together meet the targets. Slots and blocks join by source and
number.

The permutations are keyed Feistel networks over a grid barely larger than the numbers permuted; what falls outside walks
on until it is inside, which happens to one in the square root of them.

Scale: places in a source come from running totals within hashed chunks of about ``CHUNK_WORDS`` words plus the totals of
the chunks before, so the largest source is numbered by many tasks. The only window over everything is over the list of
sources, one row each.

A null or empty text has size 0 and takes 0. The null source is a source of its own, last. Repeated rows count again.
Other columns are kept out of the work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assetloom.llm.words import WORD
from assetloom.session import checkpointed

BLOCK_WORDS = 128
CHUNK_WORDS = 1 << 22
SHARD_SLOTS = 8192
WEIGHTS = (5, 2, 1)
_SPAN = 1 << 16
#: Rounds of the Feistel networks, each of which changes both halves.
_TURNS = 3


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = WEIGHTS, most: int = 3, block: int = BLOCK_WORDS,
                seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """The documents with ``size, source_size, target, taken``, and the slots of the mix.

    A slot: ``shard, slot, source_no, block_no, round``, the ``words`` it takes of its block, from the first on, and the words
    that the block holds (``full``). ``weights`` repeat over the sources in code point order.
    """
    rows = checkpointed(docs.select(
        F.col(id_col).alias("doc"), F.col(source_col).alias("source"), F.xxhash64(id_col, text_col).alias("row"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    plan = checkpointed(_plan(rows, weights, most, block))
    slots = _slots(plan, block, seed)
    placed = checkpointed(_placed(rows, plan))
    pieces = _pieces(placed, block)
    uses = slots.groupBy("source_no", "block_no").agg(
        F.count_if(F.col("words") == F.col("full")).alias("uses"),
        F.max(F.when(F.col("words") < F.col("full"), F.col("words"))).alias("cut"))
    cut = _first(F.coalesce("cut", F.lit(0)))
    taken = pieces.join(uses, ["source_no", "block_no"]).groupBy("source_no", "place").agg(
        F.sum(F.col("words") * F.col("uses") + cut).alias("taken"))
    out = placed.join(taken, ["source_no", "place"], "left").unionByName(
        _with_plan(rows.where("size = 0"), plan), allowMissingColumns=True)
    return out.select(F.col("doc").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken")), slots


def slot_pieces(docs: DataFrame, slots: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = 3,
                block: int = BLOCK_WORDS) -> DataFrame:
    """What fills each slot: ``shard, slot, doc``, the first word taken of it and how many."""
    rows = docs.select(
        F.col(id_col).alias("doc"), F.col(source_col).alias("source"), F.xxhash64(id_col, text_col).alias("row"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    pieces = _pieces(_placed(rows, _plan(rows, weights, most, block)), block)
    met = slots.withColumnRenamed("words", "limit").join(pieces, ["source_no", "block_no"])
    return met.withColumn("words", _first(F.col("limit"))).where("words > 0").select(
        "shard", "slot", F.col("doc").alias(id_col),
        F.greatest(F.lit(0), F.col("block_no") * block - F.col("place")).alias("first_word"), "words")


def _first(limit: Column) -> Column:
    """How many words of a piece are among the first words of its block."""
    return F.greatest(F.lit(0), F.least(F.col("offset") + F.col("words"), limit) - F.col("offset"))


def _plan(rows: DataFrame, weights: tuple[int, ...], most: int, block: int) -> DataFrame:
    """A row for each source: its number, size, target, blocks, how often it is taken whole, the words of the rest, and
    its slots ``low`` to ``high`` of the mix."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    listed = sizes.withColumn("source_no", F.row_number().over(by_name).cast("long"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("source_no") - 1) % len(weights) + 1).cast("int"))
    listed = listed.withColumns({
        "weight": weight, "cap": (F.col("source_size") * most).cast("double"),
        "total": F.sum("source_size").over(everything).cast("double")})
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
    levelled = listed.withColumn("level", level).withColumn(
        "level", F.max(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))).over(everything))
    shared = levelled.withColumn("target", F.least("cap", F.col("level") * F.col("weight")))
    wanted = F.round("target").cast("long")
    counted = shared.withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long")).withColumn(
        "rounds", F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    counted = counted.withColumn("rest", wanted - F.col("rounds") * F.col("source_size"))
    # One slot more than whole blocks would need, as the last block of a source may be short.
    last = F.when(F.col("rest") > 0, F.least("blocks", F.ceil(F.col("rest") / block) + 1)).otherwise(F.lit(0))
    n_slots = (F.col("rounds") * F.col("blocks") + last).cast("long")
    ended = counted.withColumn("n_slots", n_slots).withColumn(
        "high", F.sum("n_slots").over(by_name.rowsBetween(Window.unboundedPreceding, 0)))
    return ended.select("source", "source_no", "source_size", "target", "blocks", "rounds", "rest",
                        (F.col("high") - F.col("n_slots")).alias("low"), "high")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    named = plan.select(F.col("source").alias("of"), "source_no", "source_size", "target")
    return rows.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def _slots(plan: DataFrame, block: int, seed: int) -> DataFrame:
    spark = plan.sparkSession
    n = int(plan.agg(F.coalesce(F.max("high"), F.lit(0))).first()[0])
    key = lambda of: F.xxhash64("source_no", of, F.lit(seed))
    named = plan.where("high > low").withColumn("short_at", _permuted(
        F.col("blocks") - 1, F.col("blocks"), key(F.col("rounds")), back=True))
    spans = named.withColumn("span", F.explode(
        F.sequence(F.floor(F.col("low") / _SPAN), F.floor((F.col("high") - 1) / _SPAN))))
    numbers = spark.range(n).withColumn("span", F.floor(F.col("id") / _SPAN))
    i = F.col("id") - F.col("low")
    drawn = numbers.join(spans, "span").where("id >= low AND id < high").withColumns({
        "round": F.floor(i / F.col("blocks")), "at": i % F.col("blocks")})
    placed = drawn.withColumn("block_no", _permuted(F.col("at"), F.col("blocks"), key(F.col("round")))).withColumn(
        "full", F.least(F.lit(block), F.col("source_size") - F.col("block_no") * block))
    short = F.lit(block) - (F.col("source_size") - (F.col("blocks") - 1) * block)
    before = F.col("at") * block - F.when(F.col("short_at") < F.col("at"), short).otherwise(F.lit(0))
    words = F.when(F.col("round") < F.col("rounds"), F.col("full")).otherwise(F.least("full", F.col("rest") - before))
    dealt = _permuted(F.col("id"), F.lit(n).cast("long"), F.lit(seed).cast("long"))
    return placed.withColumn("words", words).where("words > 0").select(
        F.floor(dealt / SHARD_SLOTS).alias("shard"), F.col("id").alias("slot"), "source_no", "block_no", "round", "words",
        "full")


def _permuted(i: Column, n: Column, key: Column, back: bool = False) -> Column:
    """What a permutation of 0 to n-1 that ``key`` chooses gives for i; ``back``: for what it gives i."""
    rows = F.ceil(F.sqrt(n)).cast("long")
    columns = F.ceil(n / rows).cast("long")

    def moved(x: Column) -> Column:
        left, right = F.floor(x / columns), x % columns
        for k in range(_TURNS, 0, -1) if back else range(1, _TURNS + 1):
            by = lambda half, of, size: F.pmod(F.xxhash64(half, key, F.lit(of)), size)
            if back:
                right = F.pmod(right - by(left, -k, columns), columns)
                left = F.pmod(left - by(right, k, rows), rows)
            else:
                left = F.pmod(left + by(right, k, rows), rows)
                right = F.pmod(right + by(left, -k, columns), columns)
        return left * columns + right

    # No walk is longer than what lies outside, which is less than a row of the grid.
    walk = F.sequence(F.lit(1).cast("long"), F.greatest(rows, columns))
    once = moved(i)
    return F.when(once < n, once).otherwise(F.aggregate(walk, once, lambda x, _: F.when(x < n, x).otherwise(moved(x))))


def _placed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents with words, and the place of their first word in their source."""
    known = _with_plan(rows.where("size > 0"), plan).withColumn(
        "chunk", F.pmod("row", F.ceil(F.col("source_size") / CHUNK_WORDS)))
    totals = known.groupBy("source_no", "chunk").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("source_no", "chunk", F.coalesce(F.sum("words").over(order), F.lit(0)).alias("start"))
    within = Window.partitionBy("source_no", "chunk").orderBy("row", "doc").rowsBetween(Window.unboundedPreceding, -1)
    return known.withColumn("place", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        starts, ["source_no", "chunk"]).withColumn("place", F.col("place") + F.col("start")).drop("start", "chunk")


def _pieces(placed: DataFrame, block: int) -> DataFrame:
    """The part of a document in each block it reaches, and where in the block it begins."""
    end = F.col("place") + F.col("size")
    reached = F.sequence(F.floor(F.col("place") / block), F.floor((end - 1) / block))
    spread = placed.withColumn("block_no", F.explode(reached))
    begin = F.greatest("place", F.col("block_no") * block)
    words = F.least(end, (F.col("block_no") + 1) * block) - begin
    return spread.select("source_no", "place", "doc", "block_no", words.alias("words"),
                         (begin - F.col("block_no") * block).alias("offset"))
