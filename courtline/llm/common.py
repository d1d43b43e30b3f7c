"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence

import courtline
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from courtline.session import scratch_path

# ASCII blanks and the words between them, as every operator here counts words.
_BLANKS = "\t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per Spark application."""
    sc = spark.sparkContext
    if getattr(sc, "_courtline_shipped", False):
        return
    root = os.path.dirname(courtline.__file__)
    path = os.path.join(tempfile.mkdtemp(), "courtline.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(at, name), os.path.join("courtline", os.path.relpath(at, root), name))
    sc.addPyFile(path)
    sc._courtline_shipped = True


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` below the cluster's shared checkpoint folder and read it back.

    This is how lineage is cut here: one pass, columnar files that outlive any
    executor, and later readers that prune columns.
    """
    path = scratch_path(df.sparkSession, "llm", name, unique=True)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a table that :func:`stored` wrote, once nothing reads it any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


_KINDS = {"long": (LongType(), pa.int64()), "double": (DoubleType(), pa.float64()), "string": (StringType(), pa.string())}


def map_texts(df: DataFrame, keep: Sequence[str], text: str, outputs: dict[str, str],
              make: Callable[[], Callable[[list], Sequence]]) -> DataFrame:
    """``keep`` columns, untouched, and ``outputs`` (name to kind) computed from the text column in Arrow batches.

    ``make`` runs once per task and gives the function from a batch's texts
    (None for null) to one sequence per output.
    """
    src = df.select(*[df[c] for c in keep], df[text].alias("_text"))
    schema = StructType([*src.schema.fields[:-1], *[StructField(n, _KINDS[k][0]) for n, k in outputs.items()]])
    kinds = [_KINDS[k][1] for k in outputs.values()]

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for f in frames:
            got = compute(f.column(f.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*f.columns[:-1], *[pa.array(x, k) for x, k in zip(got, kinds)]], names=schema.names)

    return src.mapInArrow(batches, schema)


def words(text: str | Column) -> Column:
    """Array of ASCII-lower-cased words of a text; null and blank texts give an empty array."""
    text = F.col(text) if isinstance(text, str) else text
    flat = F.translate(F.coalesce(text, F.lit("")), _BLANKS + UPPER, " " * len(_BLANKS) + UPPER.lower())
    return F.array_remove(F.split(flat, " "), "")


def running(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], spread: Column, *,
            sums: dict[str, str] | None = None, index: str | None = None, rows_per_block: int = 5000) -> DataFrame:
    """Append a gapless index from 0 and exclusive running sums per group, with no group in one task.

    ``spread`` is an even 62-bit number by which a group's rows are ordered
    first (``order`` breaks its ties).  Equal slices of its range are the
    blocks, as many as give about ``rows_per_block`` rows if one group held
    all rows.  A window runs inside each (group, block), block totals are
    summed over the small block table, and the sums come back by an equi-join
    on the same key, so rows are shuffled once.  Null groups are groups.  The
    input is read three times: pass a stored table.
    """
    sums = dict(sums or {})
    # 31 bits of the spread times a block count below 2**31 cannot overflow a long.
    blocks = max(1, min(2 ** 31 - 1, -(-df.count() // rows_per_block)))
    key = F.struct(*[F.col(c) for c in group]) if group else F.struct(F.lit(0).alias("all"))
    block = F.shiftrightunsigned(F.shiftrightunsigned("_spread", 31) * F.lit(blocks).cast("long"), 31)
    rows = df.withColumn("_spread", spread).withColumn("_block", F.struct(key.alias("g"), block.alias("b")))
    totals = rows.groupBy("_block").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy("_block.g").orderBy("_block.b").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_c"),
        *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_c_{n}") for n in sums])
    within = Window.partitionBy("_block").orderBy("_spread", *order)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    out = rows.select(
        "*", (F.row_number().over(within) - 1).cast("long").alias("_i"),
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_l_{n}") for n, c in sums.items()],
    ).join(carry, "_block")
    if index:
        out = out.withColumn(index, F.col("_c") + F.col("_i"))
    for n in sums:
        out = out.withColumn(n, F.col(f"_c_{n}") + F.col(f"_l_{n}"))
    return out.drop("_block", "_spread", "_i", "_c", *[f"_{p}_{n}" for n in sums for p in ("c", "l")])


def spread_of(*cols: str | Column) -> Column:
    """A 62-bit non-negative hash to order and cut rows by."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 2)
