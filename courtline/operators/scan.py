"""Running row numbers and running sums inside groups, safe for huge groups.

A plain ``Window.partitionBy(group).orderBy(order)`` sends every row of a group
to one task.  When a group is large and the number of groups is small (a team's
season grows with the data while the number of teams does not; a single
season holds all its games), that caps parallelism at the number of groups and
puts one third of the data on one task when one key holds a third of the rows.

``running_scan`` is the classic two-level parallel prefix sum expressed with
DataFrame operations:

1. cut the order into blocks: by ``block``, an expression that rises with the
   order and by itself bounds a block's rows (a number divided by a width), or,
   where there is none, by a range partitioning on ``(group, order)``, which
   cuts even a single hot group into blocks of bounded size;
2. scan each ``(group, block)`` with an ordinary window (bounded work per task);
3. total each ``(group, block)`` with a partial (map-side) aggregate; a window
   over this small table (at most one row per block and group) gives the carry
   of all earlier blocks of the same group;
4. add the carry back with an equi-join on ``(group, block)``.

The ``order`` columns must form a total order within a group (append a unique
tie-break), otherwise row numbers are not reproducible -- as for SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.session import default_blocks
from courtline.session import materialize as write_checkpoint

_BLOCK = "_scan_block"
_KEY = "_scan_key"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def running_scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    *,
    row_number: str | None = None,
    exclusive_sums: Mapping[str, str | Column] | None = None,
    blocks: int | None = None,
    materialize: str = "checkpoint",
    block: Column | None = None,
) -> DataFrame:
    """Append a 1-based row number and/or exclusive running sums per group.

    ``exclusive_sums`` maps an output name to a numeric column; the output is
    the sum of that column over the rows *before* the current one in the group
    (0 for the first row; nulls are skipped, as by SQL ``SUM``).  With ``block``
    nothing runs while the plan is built: rows and block totals compute the same
    block from the same row, so the input is planned twice and stored nowhere.
    """
    exclusive_sums = dict(exclusive_sums or {})
    n_blocks = blocks or default_blocks(df.sparkSession)
    group = list(group)
    order_cols = [_col(c) for c in order]

    # Without ``block`` the block id is the range partition index.  It feeds two branches (the
    # per-block totals and the rows), and two separately planned reads of the
    # same shuffle may be coalesced differently by AQE, so the blocked rows
    # are materialised once with a reliable checkpoint in the cluster's
    # checkpoint directory: both branches read the same partitions, a lost
    # executor re-reads the files instead of re-sampling the range bounds, and
    # the lineage (and plan) downstream stays short.  ``materialize="persist"``
    # keeps them in the block manager instead (faster, but the cached entry
    # lives until unpersisted).
    # One struct key for the group: struct equality treats null fields as
    # equal (a null group is a group, as for a window), and the window, the
    # block totals and the carry join all partition on the same expression,
    # so the rows are shuffled once for the scan and not again for the join.
    key = F.struct(*[F.col(g) for g in group]) if group else F.lit(0)
    if block is not None:
        blocked = df.withColumn(_BLOCK, block).withColumn(_KEY, key)
    else:
        blocked = df.repartitionByRange(n_blocks, *[F.col(g) for g in group], *order_cols) \
            .withColumn(_BLOCK, F.spark_partition_id()).withColumn(_KEY, key)
        if materialize == "persist":
            blocked = blocked.persist(StorageLevel.MEMORY_AND_DISK)
        elif materialize == "checkpoint":
            blocked = write_checkpoint(blocked)

    in_block = Window.partitionBy(_KEY, _BLOCK).orderBy(*order_cols)
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    local = blocked.withColumn("_scan_rn", F.row_number().over(in_block))
    for name, c in exclusive_sums.items():
        local = local.withColumn(f"_scan_l_{name}", F.coalesce(F.sum(_col(c)).over(before), F.lit(0)))

    totals = blocked.groupBy(_KEY, _BLOCK).agg(
        F.count(F.lit(1)).alias("_scan_n"),
        *[F.coalesce(F.sum(_col(c)), F.lit(0)).alias(f"_scan_t_{name}") for name, c in exclusive_sums.items()],
    )
    earlier = Window.partitionBy(_KEY).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        _KEY, _BLOCK,
        F.coalesce(F.sum("_scan_n").over(earlier), F.lit(0)).alias("_scan_cn"),
        *[F.coalesce(F.sum(f"_scan_t_{name}").over(earlier), F.lit(0)).alias(f"_scan_c_{name}")
          for name in exclusive_sums],
    )

    joined = local.join(carry, on=[_KEY, _BLOCK], how="inner")
    out_cols = [F.col(c) for c in df.columns]
    if row_number:
        out_cols.append((F.col("_scan_cn") + F.col("_scan_rn")).alias(row_number))
    for name in exclusive_sums:
        out_cols.append((F.col(f"_scan_c_{name}") + F.col(f"_scan_l_{name}")).alias(name))
    return joined.select(*out_cols)


def window_scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    *,
    row_number: str | None = None,
    exclusive_sums: Mapping[str, str | Column] | None = None,
) -> DataFrame:
    """Same contract as :func:`running_scan` with one plain window per group.

    Used where the group size is bounded by the domain (a player's season), and
    as the reference implementation in tests.
    """
    w = Window.partitionBy(*group).orderBy(*[_col(c) for c in order])
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    out = df
    if row_number:
        out = out.withColumn(row_number, F.row_number().over(w).cast("long"))
    for name, c in (exclusive_sums or {}).items():
        out = out.withColumn(name, F.coalesce(F.sum(_col(c)).over(before), F.lit(0)))
    return out


def dense_ids(df: DataFrame, order: Sequence[str | Column], out: str = "id",
              start: Column | int = 1) -> DataFrame:
    """Consecutive ids ``start, start+1, ...`` in the given total order.

    A global ``row_number()`` would pull every row into one task; the
    range-blocked scan spreads the numbering over all blocks.
    """
    numbered = running_scan(df, [], order, row_number="_dense_rn")
    start_col = start if isinstance(start, Column) else F.lit(start)
    return numbered.withColumn(out, (F.col("_dense_rn") - 1 + start_col).cast("long")).drop("_dense_rn")
