"""SimHash near-duplicates by multi-index hashing.

Fingerprints are taken in numpy inside map tasks, one pass over the texts.
Equal fingerprints are one class from then on.  The 64 bits are cut into
segments; by the pigeonhole principle two fingerprints within the radius agree
in some segment up to that segment's own small radius, so every fingerprint
looks up the Hamming ball of each of its segments in the table of segment
values, and matches are verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm.common import map_texts, stored
from courtline.llm.components import components

SEED = 42
_LANES = np.uint64(0x0101010101010101)
_PER_LANE = 255
_CHUNK = _PER_LANE * 256
# Members of one bucket that a task compares at once; larger buckets are cut into blocks of this size.
BLOCK = 2048


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set."""
    pad = -len(hashes) % _PER_LANE
    rows = np.concatenate([hashes, np.zeros(pad, np.uint64)]).reshape(-1, _PER_LANE)
    counts = np.empty((8, 8), np.int64)
    for j in range(8):  # one byte lane for every eighth bit, which 255 summands cannot overflow
        lanes = ((rows >> np.uint64(j)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts[:, j] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.reshape(64)


def fingerprint(text: str | None, k: int = 4) -> int:
    """64-bit SimHash of a whole text: k-word shingles, repeats included; no words give 0."""
    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    flat = b" ".join(parts)
    if len(parts) <= k:
        return xxhash.xxh64_intdigest(flat, SEED)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = len(parts) - k + 1
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, _CHUNK):
        hi = min(n, lo + _CHUNK)
        spans = zip(starts[lo:hi].tolist(), ends[lo + k - 1:hi + k - 1].tolist())
        counts += _bit_counts(np.fromiter((digest(flat[a:b], SEED) for a, b in spans), np.uint64, hi - lo))
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", k: int = 4, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fp``, the fingerprint as a signed long."""
    def make():
        return lambda texts: [np.array([fingerprint(t, k) for t in texts], np.uint64).view(np.int64)]

    return map_texts(docs, keep, text, {"fp": "long"}, make)


def segments(radius: int, bits: int = 64, width: int = 21) -> list[tuple[int, int, int]]:
    """(shift, bits, own radius) of each segment; some segment of a pair within ``radius`` is within its own.

    With m segments of about ``width`` bits, the first ``radius % m + 1``
    segments get radius ``radius // m`` and the rest one less: were every
    segment beyond its own radius, the whole distance would exceed ``radius``.
    """
    m = max(1, bits // width)
    cuts = [bits * i // m for i in range(m + 1)]
    q, r = divmod(radius, m)
    return [(cuts[i], cuts[i + 1] - cuts[i], q if i <= r else q - 1) for i in range(m)]


def _ball(value, n: int, radius: int) -> list:
    """The value itself and every value that sets up to ``radius`` of its zero bits (null where the bit is set).

    Two values at distance d both reach their union by setting bits, together
    d of them, so they meet there: half a Hamming ball on either side is enough.
    """
    out, level = [value], [(value, 0)]
    for _ in range(radius):
        level = [(F.when((v.bitwiseAND(F.lit(1 << i))) == 0, v.bitwiseOR(F.lit(1 << i))), i + 1)
                 for v, lo in level for i in range(lo, n)]
        out += [v for v, _ in level]
    return out


def _links_in_bucket(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among one bucket's fingerprints."""
    n = len(fps)
    bits = fps.view(np.uint64)  # of signed numbers numpy would count the bits of the absolute value
    root = np.arange(n)
    out: list[tuple[int, int]] = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for lo in range(0, n, 256):
        near = np.bitwise_count(bits[lo:lo + 256, None] ^ bits[None, lo:]) <= radius
        for i, j in zip(*np.nonzero(np.triu(near, 1))):
            a, b = find(lo + int(i)), find(lo + int(j))
            if a != b:
                root[b] = a
                out.append((int(fps[lo + i]), int(fps[lo + j])))
    return out


def fingerprint_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between different fingerprints of ``distinct(fp)`` that connect whatever all links connect.

    Every pair within ``radius`` bits meets in a bucket and is verified there
    on all 64 bits; a bucket gives a spanning forest of its links, not its
    pairs.  A bucket beyond ``BLOCK`` members is cut into blocks, and every
    pair of blocks is a bucket of its own, so no task holds more than two blocks.
    """
    keys = []
    for s, (shift, n, own) in enumerate(segments(radius)):
        if own < 0:
            continue
        value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << n) - 1))
        keys += [v + F.lit(s << 32) for v in _ball(value, n, own)]
    rows = distinct.select("fp", F.explode(F.array(*keys)).alias("bucket")).filter("bucket IS NOT NULL")
    large = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
    large = large.select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(large, "bucket", "left")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    rows = rows.select("bucket", "fp", F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: (
            F.least(mine, j).cast("long") * F.lit(1 << 31) + F.greatest(mine, j))))).alias("pair"))

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for f in frames:
            got = f[["bucket", "pair", "fp"]].to_numpy()
            if rest is not None:
                got = np.concatenate([rest, got])
            starts = np.flatnonzero(np.r_[True, (got[1:, :2] != got[:-1, :2]).any(axis=1)])
            rest = got[starts[-1]:]
            yield linked(got[:starts[-1]], starts[:-1])
        if rest is not None:
            yield linked(rest, np.zeros(1, np.int64))

    def linked(got: np.ndarray, starts: np.ndarray) -> pd.DataFrame:
        ends = np.r_[starts[1:], len(got)]
        sizes = ends - starts
        out: list[tuple[int, int]] = []
        two = starts[sizes == 2]  # the common case, at once
        a, b = got[two, 2], got[two + 1, 2]
        near = np.bitwise_count((a ^ b).view(np.uint64)) <= radius
        out += zip(a[near].tolist(), b[near].tolist())
        for lo, hi in zip(starts[sizes > 2], ends[sizes > 2]):
            out += _links_in_bucket(np.unique(got[lo:hi, 2]), radius)
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "bucket", "pair").sortWithinPartitions("bucket", "pair").mapInPandas(
        batches, "a long, b long").filter("a != b").distinct()


def simhash_groups(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = 4, radius: int = 4) -> DataFrame:
    """(key, fingerprint, component_id) per row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the smallest
    ``key`` reachable over links of at most ``radius`` differing bits.  Null,
    empty and blank texts have fingerprint zero and link like any other.
    Repeated rows stay, one result each.  A null key takes part; it is never
    the smallest unless its component has no other (then null).  Other columns
    of ``docs`` are not read.  An empty table gives an empty result.
    """
    marked = stored(fingerprints(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), k=k, keep=("id",)), "simhash")
    classes = classes_of(marked, "id", radius)
    # Fingerprints are spread evenly, but one may hold a third of the rows: a plain equi-join, which AQE can split.
    return marked.join(classes, "fp").select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def classes_of(marked: DataFrame, key: str, radius: int) -> DataFrame:
    """(fp, root, component_id) per distinct fingerprint of ``marked(key, fp)``."""
    distinct = stored(marked.groupBy("fp").agg(F.min(key).alias("least")), "simhash-classes")
    roots = components(fingerprint_links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def representatives(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs``, all columns as they are, of which each near-duplicate group keeps one.

    That is the row with the group's smallest key; a group of null keys keeps
    one of them, and of rows with that key the one whose text hash is smallest.
    Rows are found again by key and text hash, so the texts are shuffled once,
    for that join, and equal rows, which the join brings together, leave one.
    """
    hashed = docs.select(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text"))
    marked = stored(fingerprints(hashed, k=k, keep=("id", "h")), "simhash")
    classes = classes_of(marked, "id", radius)
    # Null keys sort last; one row per distinct fingerprint, then per component.
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("h"))
    first = marked.groupBy("fp").agg(F.min(order).alias("o"))
    roots = first.join(classes, "fp").groupBy("root").agg(F.min("o").alias("o"))
    kept = stored(roots.select(F.col("o.id").alias("_kept_id"), F.col("o.h").alias("_kept_hash")), "simhash-kept")
    here = docs.withColumn("_hash", F.xxhash64(F.col(text)))
    found = here.join(kept, here[key].eqNullSafe(F.col("_kept_id")) & (F.col("_hash") == F.col("_kept_hash")))
    same = Window.partitionBy("_kept_id", "_kept_hash").orderBy("_hash")
    return found.withColumn("_row", F.row_number().over(same)).filter("_row = 1").select(*[docs[c] for c in docs.columns])
