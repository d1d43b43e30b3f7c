"""Bounded-frame window features over a per-entity sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Rows of a group that one task can well hold and sort.
HOT_ROWS = 1 << 16


def window_sql(partition: Sequence[str], order: Sequence[str], frame: str = "") -> str:
    return f"OVER (PARTITION BY {', '.join(partition)} ORDER BY {', '.join(order)}{' ' + frame if frame else ''})"


def trailing_mean_sql(cols: Sequence[str], partition: Sequence[str], order: Sequence[str],
                      n: int = 3, prefix: str = "avg_last_{n}_", empty: float = 0.0) -> list[str]:
    """Mean of each column over the previous ``n`` rows (current row excluded), as SQL.

    Nulls are skipped and shorten the denominator; an empty frame gives
    ``empty``.  All expressions share one window spec, so Catalyst evaluates
    them in a single Window node over one shuffle and one sort.  They are
    built as SQL text so a wide projection costs one call into the JVM.
    """
    over = window_sql(partition, order, f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING")
    name = prefix.format(n=n)
    return [f"coalesce(avg({c}) {over}, CAST({float(empty)!r} AS DOUBLE)) AS {name}{c}" for c in cols]


def trailing_means(cols: Sequence[str], partition: Sequence[str], order: Sequence[str],
                   n: int = 3, prefix: str = "avg_last_{n}_", empty: float = 0.0) -> list[Column]:
    """Column form of :func:`trailing_mean_sql`."""
    return [F.expr(e) for e in trailing_mean_sql(cols, partition, order, n, prefix, empty)]


def next_value_sql(col: str, partition: Sequence[str], order: Sequence[str], alias: str) -> str:
    return f"lead({col}) {window_sql(partition, order)} AS {alias}"


def next_value(col: str, partition: Sequence[str], order: Sequence[str | Column], alias: str) -> Column:
    """Value of ``col`` in the following row of the sequence (null on the last one)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return F.lead(col).over(w).alias(alias)


def with_trailing_features(df: DataFrame, cols: Sequence[str], partition: Sequence[str],
                           order: Sequence[str | Column], n: int = 3,
                           lead_col: str | None = None, lead_alias: str | None = None) -> DataFrame:
    """``df`` plus trailing means (and optionally a lead) in one projection."""
    exprs = trailing_mean_sql(cols, partition, order, n=n)
    if lead_col:
        exprs.append(next_value_sql(lead_col, partition, order, lead_alias or f"next_{lead_col}"))
    return df.selectExpr("*", *exprs)


def shifted_frame_features(df: DataFrame, cols: Sequence[str], partition: Sequence[str],
                           order: Sequence[str], n: int = 3, lead_col: str | None = None,
                           lead_alias: str | None = None, prefix: str = "avg_last_{n}_",
                           empty: float = 0.0, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Same result as :func:`with_trailing_features`, safe when one group is huge.

    A window partitioned by the group puts all of a group's rows on one task,
    which is right for groups of up to ``hot_rows`` rows.  Rows of larger ones
    are range-partitioned by (group, order), which cuts them into blocks, and the
    window runs in each (group, block).  At most one group goes on across each
    cut; its blocks get copies of the ``n`` rows before them and of the row after
    them, which only serve the frames and are left out again.  ``order`` must be
    a total order within a group.
    """
    from courtline.session import default_blocks, materialize

    group, block, own = list(partition), "_fr_block", "_fr_own"
    keys = [F.col(g).alias(f"_fr_g{i}") for i, g in enumerate(group)]
    same = [F.col(g).eqNullSafe(F.col(f"_fr_g{i}")) for i, g in enumerate(group)]
    out = [f"{prefix.format(n=n)}{c}" for c in cols]
    if lead_col:
        lead_alias = lead_alias or f"next_{lead_col}"
        out.append(lead_alias)

    def frames(rows: DataFrame, by: Sequence[str]) -> DataFrame:
        exprs = trailing_mean_sql(cols, by, order, n=n, prefix=prefix, empty=empty)
        return rows.selectExpr("*", *exprs, *([next_value_sql(lead_col, by, order, lead_alias)] if lead_col else []))

    # The rows are read to be counted and for either part, so they are computed once.
    every = materialize(df)
    # One group at most for each ``hot_rows`` rows: a proven bound, so that no other row is shuffled to be told apart.
    hot = F.broadcast(every.groupBy(*keys).count().filter(F.col("count") > hot_rows))
    plain = frames(every.join(hot, same, "left_anti"), group).select(*df.columns, *out)
    # Both the blocks and their edges are made from the rows, so the blocks are fixed in one copy.
    rows = materialize(every.join(hot, same, "left_semi").repartitionByRange(default_blocks(df.sparkSession), *group, *order)
                       .withColumn(block, F.spark_partition_id()))
    spans = rows.groupBy(*keys).agg(F.min(block).alias("_fr_lo"), F.max(block).alias("_fr_hi")).filter("_fr_lo < _fr_hi")
    # Groups of several blocks, at most one a cut: a few rows of each end of a block.
    cut = rows.join(spans, same, "left_semi")
    in_block = Window.partitionBy(*group, block)
    ends = cut.withColumn("_fr_first", F.row_number().over(in_block.orderBy(*order))) \
        .withColumn("_fr_last", F.row_number().over(in_block.orderBy(*[F.desc(c) for c in order]))) \
        .filter((F.col("_fr_first") == 1) | (F.col("_fr_last") <= n))
    places = ends.select(*keys, F.col(block).alias("_fr_to")).distinct()
    around = ends.join(places, same).filter(F.col(block) != F.col("_fr_to"))
    to = Window.partitionBy(*group, "_fr_to", F.col(block) < F.col("_fr_to"))
    before = F.row_number().over(to.orderBy(*[F.desc(c) for c in order]))
    after = F.row_number().over(to.orderBy(*order))
    halo = around.withColumn("_fr_before", before).withColumn("_fr_after", after).filter(
        ((F.col(block) < F.col("_fr_to")) & (F.col("_fr_before") <= n)) | ((F.col(block) > F.col("_fr_to")) & (F.col("_fr_after") == 1)))
    halo = halo.withColumn(block, F.col("_fr_to")).select(*rows.columns, F.lit(False).alias(own))
    work = rows.withColumn(own, F.lit(True)).unionByName(halo)
    return plain.unionByName(frames(work, [*group, block]).filter(own).select(*df.columns, *out))
