"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are laid end to end in a shuffled order, its tape,
which is read round and round and cut into blocks of equal word counts.  A
schedule of slots visits the sources: slot k's golden-ratio point falls into
one source's stretch of the cumulative targets, so every run of slots is close
to the target mixture.  The r-th slot of a source takes the r-th block of its
tape, an equi-join, until the source's target is met.  A source whose blocks
outnumber its slots gets the missing slots at the end of the schedule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm.common import WORD, running, spread_of, stored

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK_WORDS = 64
_STEP = 2654435769  # 2**32 / golden ratio
_GRID = 1024


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_no, source_size, weight, target) per source of ``sized(source, size)``.

    Weights repeat over the sources in code-point order, null last.  Targets
    share all words by weight, but none passes ``most`` times its source's
    words; what is cut off is shared again by weight among the rest.  With
    sources ordered by the level at which they fill up, a source is full
    exactly if the level that all before it leave is at least its own.  The
    windows run over one row per source.
    """
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    stats = stats.withColumn("source_no", (F.row_number().over(by_name) - 1).cast("int"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("source_no") % len(weights) + 1)
    stats = stats.withColumn("weight", w).withColumn("limit", (most * F.col("source_size")).cast("double"))
    level = Window.orderBy(F.col("limit") / F.col("weight"), "source_no")
    everything = Window.partitionBy()
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    onwards = level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    stats = stats.withColumn("left", F.sum("source_size").over(everything)
                             - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
    stats = stats.withColumn("own", F.col("left") / F.sum("weight").over(onwards))
    stats = stats.withColumn("full", F.col("own") >= F.col("limit") / F.col("weight"))
    # All sources beyond the full ones share one level: that of the first of them.
    first = F.min(F.when(~F.col("full"), F.struct((F.col("limit") / F.col("weight")).alias("r"), "source_no", "own"))).over(everything)
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.least(first["own"] * F.col("weight"), F.col("limit")))
    return stats.select("source", "source_no", "source_size", "weight", target.alias("target"))


def slots(spark, sources: DataFrame, n: int) -> DataFrame:
    """(slot, source_no, rank) for slots 0 to n-1: the source that each golden-ratio point falls to, and its turn.

    The unit interval is cut into a grid, and each source's stretch is listed
    in the cells that it covers, so finding a point's source is an equi-join.
    """
    order = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.col("target") / F.sum("target").over(Window.partitionBy())
    hi = F.round(F.least(F.sum("share").over(order), F.lit(1.0)) * F.lit(2.0 ** 32)).cast("long")
    cum = sources.withColumn("share", share).withColumn("hi", hi)
    last = F.max("source_no").over(Window.partitionBy())
    cum = cum.withColumn("hi", F.when(F.col("source_no") == last, F.lit(2 ** 32)).otherwise(F.col("hi")))
    cum = cum.withColumn("lo", F.lag("hi", 1, 0).over(Window.orderBy("source_no"))).filter("hi > lo")
    width = 2 ** 32 // _GRID
    cells = cum.select("source_no", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("cell"))
    point = F.pmod(F.pmod(F.col("id"), F.lit(2 ** 31)) * F.lit(_STEP), F.lit(2 ** 32))
    points = spark.range(n).select(F.col("id").alias("slot"), point.alias("u")).withColumn("cell", F.floor(F.col("u") / width))
    placed = points.join(stored(cells, "mix-cells"), "cell").filter("u >= lo AND u < hi").select("slot", "source_no")
    scale = 2 ** 62 // max(1, n)
    return running(stored(placed, "mix-points"), ["source_no"], [], F.col("slot") * F.lit(scale), index="rank")


def schedule_of(spark, sources: DataFrame, n: int, block: int = BLOCK_WORDS) -> DataFrame:
    """``slots``, and after them one slot for each block of ``sources(.., wanted)`` that drew none.

    Blocks are rounded up per source and points only come close to the shares,
    so small sources may draw fewer slots than they have blocks.  The added slots
    of a source are spread evenly over the end of the schedule, in rank order.
    """
    drawn = stored(slots(spark, sources, n), "mix-slots")
    have = drawn.groupBy("source_no").agg(F.count(F.lit(1)).alias("have"))
    owed = sources.select("source_no", F.ceil(F.col("wanted") / block).alias("need")).join(have, "source_no", "left") \
        .withColumn("have", F.coalesce("have", F.lit(0).cast("long"))).filter("need > have")
    missing = owed.select("source_no", "have", "need", F.explode(F.sequence(F.col("have"), F.col("need") - 1)).alias("rank"))
    begin = F.pmod(F.xxhash64("source_no"), F.lit(2 ** 20)) / 2 ** 20
    at = (F.col("rank") - F.col("have") + begin) / (F.col("need") - F.col("have"))
    late = running(stored(missing, "mix-missing"), [], ["source_no", "rank"], F.floor(at * 2.0 ** 62), index="late")
    return drawn.unionByName(late.select((F.col("late") + n).alias("slot"), "source_no", "rank"))


def mix(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, most: int = MOST_REPEATS, block: int = BLOCK_WORDS,
        seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The mixture of ``docs``: what each document gives, and the schedule.

    First (key, text_hash, copy, size, source_no, source_size, target, taken) per row:
    ``taken`` counts the words that the mix takes, repeats included; ``copy``
    numbers rows of equal key and text from 0.  Then (slot, source_no, rank,
    row, words) per piece of a block, ``row`` a row number.

    A null text has no words and a null source is a source.  Documents without
    words are taken 0 times, whatever the target.  Equal rows are separate
    documents.  No document is taken more than ``most`` times its size.  Ties
    of the shuffle are broken by key and text.  An empty table gives empty
    results.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(key).alias("id"), F.col(source).alias("source"), F.col(text).alias("text"))
    sized = stored(src.select(
        F.monotonically_increasing_id().alias("row"), "id", "source", F.xxhash64("text").alias("text_hash"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        spread_of(F.lit(seed), "id", "text").alias("at")), "mix-sizes")
    sources = stored(source_targets(sized, weights, most), "mix-sources")
    wanted = F.round("target").cast("long")
    words = sources.agg(F.sum(wanted)).first()[0] or 0
    n = -(-words // block)
    # A few spare slots, so that hardly any source is short of one; each stops at its target.
    schedule = schedule_of(spark, sources.withColumn("wanted", wanted), n + n // 64 + 64, block) if words else None

    by_source = sized.alias("d").join(
        sources.select(F.col("source").alias("s"), "source_no", "source_size", "target", wanted.alias("wanted")),
        F.expr("source <=> s")).drop("s")
    if schedule is None:
        nothing = by_source.withColumn("taken", F.lit(0).cast("long"))
        pieces = spark.createDataFrame([], "slot long, source_no int, rank long, row long, words long")
        return _numbered(nothing, key), pieces
    tape = running(by_source.filter("size > 0"), ["source_no"], ["id", "text_hash", "size"], F.col("at"), sums={"start": "size"})
    turns = F.ceil(F.col("wanted") / F.col("source_size")).cast("int")
    laid = tape.filter("wanted > 0").select(
        "row", "source_no", "wanted", "size", F.explode(F.sequence(F.lit(0), turns - 1)).alias("turn"), "source_size", "start")
    laid = laid.withColumn("a", F.col("turn") * F.col("source_size") + F.col("start"))
    laid = laid.withColumn("b", F.least(F.col("a") + F.col("size"), "wanted")).filter("a < b")
    cut = laid.select("row", "source_no", "a", "b", F.explode(F.sequence(
        F.floor(F.col("a") / block), F.floor((F.col("b") - 1) / block))).alias("rank"))
    cut = cut.select("row", "source_no", "rank", (F.least("b", (F.col("rank") + 1) * block)
                                                  - F.greatest("a", F.col("rank") * block)).alias("words"))
    pieces = cut.join(schedule, ["source_no", "rank"]).select("slot", "source_no", "rank", "row", "words")
    taken = pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    mixed = by_source.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
    return _numbered(mixed, key), pieces


def _numbered(mixed: DataFrame, key: str) -> DataFrame:
    same = Window.partitionBy("id", "text_hash").orderBy("source", "row")
    return mixed.withColumn("copy", F.row_number().over(same) - 1).select(
        F.col("id").alias(key), "text_hash", "copy", "size", "source_no", "source_size", "target", "taken")
