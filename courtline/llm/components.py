"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import stored

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the smallest node of its component.

    Each round hangs every node's larger neighbours, then its smaller ones, on
    the smallest neighbour; the number of rounds grows with the logarithm of
    the longest chain.  A round's links are written to the shared folder, so a
    lost executor costs one round at most.  Hubs are plain inner-join keys,
    which the adaptive skew join splits.  Only a count and a checksum of the
    links reach the driver.  Self links and nulls are ignored; no links give
    no rows.
    """
    edges = stored(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    for _ in range(MAX_ROUNDS):
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == mark:
            break
        mark = now
        edges = stored(_small_star(_large_star(edges)), "links")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    children = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return children.unionAll(children.select(F.col("root").alias("node"), "root").distinct())
