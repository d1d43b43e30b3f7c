"""Token-id files: Parquet list columns in document order, with small metadata columns beside them.

Documents are range-partitioned by key, so the files in order hold all
documents in order; tokenizing follows the exchange in the same stage and is
done once.  Ids are dictionary-encoded (a vocabulary is a small dictionary)
and the metadata columns are delta-encoded (format version 2); row groups and
pages are bounded, and page indexes, which the writer adds to every column
chunk, let a reader fetch one document's ids or the metadata alone.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from courtline.llm.token_counts import byte_symbols

CACHE_ENTRIES = 1_000_000
CACHE_CHARS = 64
ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 1024
_BLANKS = "\n\t\r\x0b\x0c"
# Signs that never belong to a contraction or a special token.
_TAIL = ".,;:!?|&$#%*()-\""


class _Known(dict):
    """Ids of pieces, as bytes; a piece that is not there is encoded and kept."""

    def __init__(self, content: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__({"": b""})
        self.library = Tokenizer.from_buffer(content)
        self.model = self.library.model
        self.shown = {b: c for c, b in byte_symbols().items()}

    def __missing__(self, piece: str) -> bytes:
        body = piece.rstrip(_TAIL)
        if body.isalpha() and body.isascii() or body.isalpha() and ord(max(body)) < 256:
            if len(body) < len(piece):
                out = self[body] + self[piece[len(body):]]
            else:
                # One pre-token of Latin-1 letters: already composed, lower-cased letter by letter.
                shown = body.lower()
                if not shown.isascii():
                    shown = shown.encode("utf-8").decode("latin-1").translate(self.shown)
                out = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        else:
            out = array("I", self.library.encode(piece, add_special_tokens=False).ids).tobytes()
        if len(piece) <= CACHE_CHARS:
            if len(self) > CACHE_ENTRIES:
                self.clear()
                self[""] = b""
            self[piece] = out
        return out


class Encoder:
    """Ids of whole texts, by pieces between ASCII blanks.

    Only for vocabularies like the one here, whose normalizer composes and
    lower-cases and whose pre-tokens are letter runs, single digits and runs of
    other signs, never with a blank: then a text's ids are those of its pieces,
    one after another, and a piece that comes again costs one lookup.  Pieces
    of plain letters go straight to the library's BPE model, others through
    its whole pipeline.
    """

    def __init__(self, content: bytes):
        self.known = _Known(content)

    def encode(self, texts: list[str | None], end_id: int | None) -> list[bytes]:
        """Little-endian 32-bit ids of each text, ``end_id`` after each."""
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        look = self.known.__getitem__
        out = []
        for t in texts:
            for blank in _BLANKS:
                if t and blank in t:
                    t = t.replace(blank, " ")
            out.append(b"".join(map(look, t.split(" "))) + end if t else end)
        return out


_ENCODERS: dict[bytes, Encoder] = {}


def encoder(content: bytes) -> Encoder:
    """The encoder of a vocabulary file, kept for the life of the Python worker."""
    if content not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[content] = Encoder(content)
    return _ENCODERS[content]


def _schema(key: StructField) -> StructType:
    return StructType([StructField("key", key.dataType), StructField("part", IntegerType()),
                       StructField("part_start", LongType()), StructField("n_tokens", LongType()),
                       StructField("tokens", ArrayType(IntegerType()))])


def write_tokens(docs: DataFrame, path: str, vocabulary: str, *, key: str = "doc_id", text: str = "text",
                 end_id: int | None = 1) -> None:
    """Encode every whole text and write ``path`` in ascending key order.

    Columns: ``key``, ``part`` (file number), ``part_start`` (ids of the
    documents before this one in its file), ``n_tokens`` and ``tokens``, the
    ids with ``end_id`` after each document.  A null text is an empty one; null
    keys come first; rows with the same key are ordered by text, and the hash
    of the text is part of the range key, so a key that holds many rows is
    still split.  Repeated rows stay.  Other columns are not read.  An empty
    table writes an empty file set.  ``vocabulary`` is a tokenizers JSON file
    on the driver, broadcast by content.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    src = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = _schema(src.schema["key"])

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, enc = TaskContext.get().partitionId(), 0, encoder(shared.value)
        for f in frames:
            ids = enc.encode(f.column("text").to_pylist(), end_id)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            ends = np.cumsum(sizes)
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            tokens = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [f.column("key"), pa.array(np.full(len(ids), part), pa.int32()), pa.array(start + ends - sizes, pa.int64()),
                 pa.array(sizes, pa.int64()), tokens], names=schema.names)
            start += int(ends[-1]) if len(ends) else 0

    ordered = src.repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions("key", "text")
    (ordered.mapInArrow(batches, schema).write
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "false").option("parquet.enable.dictionary#tokens.list.element", "true")
     .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.row.count.limit", PAGE_ROWS)
     .option("compression", "zstd").parquet(path))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """key, part, part_start, n_tokens and ``start`` (ids of all documents before), without reading any ids."""
    meta = spark.read.parquet(path).select("key", "part", "part_start", "n_tokens")
    # One row per file, however many documents there are.
    parts = meta.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return meta.join(parts, "part").withColumn("start", F.col("offset") + F.col("part_start")).drop("offset")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """key, part, part_start, n_tokens, tokens and ``start``, in no particular order."""
    rows = spark.read.parquet(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # Bounded by the number of files, at a few bytes each.
    return rows.join(F.broadcast(parts), "part").withColumn("start", F.col("offset") + F.col("part_start")).drop("offset")


def with_crc32(tokens: DataFrame) -> DataFrame:
    """key, start, n_tokens and ``ids_crc32``, the unsigned crc32 of the ids as little-endian 32-bit integers."""
    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in frames:
            lists = f.column("tokens")
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            at = lists.offsets.to_numpy()
            crcs = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(at.tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [f.column("key"), f.column("start"), f.column("n_tokens"), pa.array(crcs, pa.int64())],
                names=["key", "start", "n_tokens", "ids_crc32"])

    src = tokens.select("key", "start", "n_tokens", "tokens")
    return src.mapInArrow(batches, f"key {src.schema[0].dataType.simpleString()}, start long, n_tokens long, ids_crc32 long")
