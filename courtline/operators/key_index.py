"""Natural keys of stored tables, kept apart from the tables and cut into hash buckets.

A table's constraint needs, for a batch, whether each of its keys is stored and
under which id.  The index answers from the buckets that the batch hits alone:
Parquet below ``bucket=<n>``, pruned by the partition column, with rows sorted by
key and Bloom filters on the key columns inside.  The table itself is not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64


def bucket_of(key: Sequence[str], buckets: int = BUCKETS) -> Column:
    """Bucket by the last key column, so that what comes together, as a game's box rows do, lies together."""
    return F.pmod(F.xxhash64(key[-1]), F.lit(buckets)).cast("int")


class KeyIndex:
    """Keys and ids of the tables below ``root``; ``kept`` gives the committed deltas with their versions."""

    def __init__(self, spark: SparkSession, root: str, keys: Mapping[str, Sequence[str]], buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), keys, buckets
        self.kept: DataFrame | None = None
        self.deleted: Mapping[str, DataFrame] = {}

    def write(self, name: str, rows: DataFrame, delta: str) -> None:
        """Add the keys of a delta's new rows; a retry of the delta replaces them."""
        key = self.keys[name]
        out = rows.select(*key, "id", bucket_of(key, self.buckets).alias("bucket")).repartition("bucket") \
            .sortWithinPartitions("bucket", *key).write.mode("overwrite").partitionBy("bucket")
        for c in key:
            out = out.option(f"parquet.bloom.filter.enabled#{c}", "true")
        out.parquet(f"{self.root}/{name}/delta={delta}")

    def lookup(self, name: str, wanted: DataFrame) -> DataFrame:
        """(key columns, id) of the keys of ``wanted`` that are stored; at most ``buckets`` numbers come to the driver."""
        key = self.keys[name]
        keys = wanted.select(*key).distinct()
        hit = [b for (b,) in keys.select(bucket_of(key, self.buckets).alias("b")).distinct().collect()]
        path = f"{self.root}/{name}"
        stored = self.spark.read.option("basePath", path).schema(self._schema(name, wanted)).parquet(path) \
            .filter(F.col("bucket").isin(hit)).join(self.kept, "delta", "left_semi" if name not in self.deleted else "inner")
        if name in self.deleted:
            gone = self.deleted[name]
            stored = stored.join(gone, (F.col("id") == gone._gone_id) & (F.col("version") < gone._gone_version), "left_anti")
        return stored.select(*key, "id").join(keys, list(key), "left_semi")

    def _schema(self, name: str, wanted: DataFrame) -> str:
        types = {f.name: f.dataType.simpleString() for f in wanted.schema.fields}
        return ", ".join([*(f"{c} {types[c]}" for c in self.keys[name]), "id long", "delta string", "bucket int"])
