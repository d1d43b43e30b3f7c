"""Benchmark decontamination by SimHash windows, multi-index Hamming blocks and exact verification.

All of it is DataFrame functions.  A window of a document is a run of as many
words as a benchmark item has.  Windows that share no shingle with an item
have similarity 0, and a window may be moved on to the first shingle that it
shares with the benchmark without losing any; so the windows that begin at a
shared shingle are all that need a fingerprint.  Fingerprints are SimHashes of
the window's shingles, weighted by their counts; items of a window's size are
looked up by Hamming balls within blocks of the fingerprint, such that every
item within the radius is met; and what is met is verified by the exact
weighted Jaccard similarity of the shingles.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import stored, words
from courtline.llm.simhash import segments

SHINGLE = 5
SIMILARITY = 0.8
# At similarity 0.8 two weighted SimHashes differ by 9.7 of 64 bits in the mean, with deviation 2.9: three deviations on.
RADIUS = 18
BLOCK_BITS = 7
# Distinct benchmark shingles, 24 bytes each, up to which they are broadcast; beyond, they are joined by a shuffle.
MOST_BROADCAST_ANCHORS = 1_000_000


def _shingle_at(w: Column | str, at: Column, k: int) -> Column:
    """Hash of the k words from position ``at`` (from 0)."""
    return F.xxhash64(*[F.get(w, at + i) for i in range(k)])


def _bits(counts: list[Column], n: Column) -> Column:
    """Fingerprint from 32 sums, each of two bit counts in the halves of a long: bit set in over half of ``n``."""
    out = None
    for j, s in enumerate(counts):
        low = s.bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(s, 32)
        for count, bit in ((low, j), (high, j + 32)):
            value = 1 << bit
            value -= (1 << 64) if value >= 1 << 63 else 0
            term = F.when(2 * count > n, F.lit(value).cast("long")).otherwise(F.lit(0).cast("long"))
            out = term if out is None else out.bitwiseOR(term)
    return out


def fingerprints(shingles: DataFrame, by: list[str], h: str = "h") -> DataFrame:
    """``by`` and ``fp``: SimHash of each group's rows of shingle hashes, repeats included.

    Thirty-two sums hold the 64 bit counts, two to a long, so map-side partial
    sums carry at most one small row per group and task.
    """
    pair = F.lit(0x0000000100000001).cast("long")
    sums = [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(pair)).alias(f"c{j}") for j in range(32)]
    got = shingles.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums)
    return got.select(*by, _bits([F.col(f"c{j}") for j in range(32)], F.col("n")).alias("fp"))


def _balls(value: Column, bits: int, radius: int) -> Column:
    """All values within ``radius`` bits of a ``bits``-bit value."""
    masks = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(bits), r)]
    return F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: value.bitwiseXOR(m))


def matches(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
            shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(key, text_hash, item, start, similarity, distance): the best window of each document for each item it contains.

    Words are runs of characters other than ASCII blanks, A-Z lower-cased; an
    item of fewer than ``shingle`` words is one shingle of all its words, and a
    document shorter than an item is one window.  Items and documents without
    words match nothing; null texts have none.  A pair is reported if some
    window's fingerprint is within ``radius`` bits of the item's and the weighted
    Jaccard similarity of the shingles (counts as weights) is at least
    ``similarity``; of equally similar windows the first counts.  Repeated
    rows with equal key and text count once, null keys are reported as null,
    equal items are reported each.  Either table may be empty.

    ``items`` is the benchmark.  Its distinct shingles are counted, and broadcast
    only up to ``MOST_BROADCAST_ANCHORS``.
    """
    own = items.select(F.col(item_key).alias("item"), words(text).alias("w")).filter(F.size("w") > 0)
    own = own.withColumn("size", F.size("w")).withColumn("k", F.least(F.lit(shingle), "size"))
    own = stored(own.withColumn("row", F.monotonically_increasing_id()), "bench-items")
    # At most ``shingle`` different lengths.
    lengths = sorted(r[0] for r in own.select("k").distinct().collect())
    src = docs.select(F.col(key).alias("id"), F.xxhash64(F.col(text)).alias("text_hash"), words(text).alias("w"))
    if not lengths:
        return _result(src.limit(0).select("id", "text_hash"), own, key)

    parts = [own.filter(F.col("k") == k).select("row", "size", F.lit(k).alias("k"), "w", F.explode(
        F.sequence(F.lit(0), F.col("size") - k)).alias("at")).select(
            "row", "size", "k", _shingle_at("w", F.col("at"), k).alias("h")) for k in lengths]
    item_shingles = parts[0]
    for p in parts[1:]:
        item_shingles = item_shingles.unionAll(p)
    item_shingles = stored(item_shingles, "bench-shingles")
    anchors = stored(item_shingles.select("k", "h", "size").distinct(), "bench-anchors")

    # One pass over all shingles of all documents, kept inside one generated loop up to the join with the anchors.
    small = anchors.count() <= MOST_BROADCAST_ANCHORS
    start = F.greatest(F.lit(0), F.least("p", F.col("n") - F.col("size")))
    window = F.slice("w", F.col("start") + 1, F.col("size"))
    found = None
    for k in lengths:
        at = src.select("id", "text_hash", "w", F.size("w").alias("n"), F.posexplode("w").alias("p", "word")) \
            .filter(F.col("p") <= F.col("n") - k).select(
                "id", "text_hash", *(["w"] if small else []), "n", "p", _shingle_at("w", F.col("p"), k).alias("h"))
        own_k = anchors.filter(F.col("k") == k).select("h", "size")
        hit = at.join(F.broadcast(own_k) if small else own_k, "h").withColumn("start", start)
        hit = hit.select("id", "text_hash", "size", "start", *([window.alias("w")] if small else []))
        found = hit if found is None else found.unionAll(hit)
    windows = found.distinct()
    if not small:
        # Too many anchors to broadcast: the shuffle must not carry texts with every shingle, so the documents that
        # hold a spot come a second time for the words of their windows.
        spots = stored(windows, "bench-spots")
        held = spots.select(F.col("id").alias("i"), F.col("text_hash").alias("t")).distinct()
        some = src.join(held, (F.col("id").eqNullSafe(F.col("i"))) & (F.col("text_hash") == F.col("t")), "left_semi") \
            .dropDuplicates(["id", "text_hash"]).select(F.col("id").alias("i"), F.col("text_hash").alias("t"), "w")
        windows = spots.join(some, (F.col("id").eqNullSafe(F.col("i"))) & (F.col("text_hash") == F.col("t"))).select(
            "id", "text_hash", "size", "start", window.alias("w"))
    windows = stored(windows.withColumn("window", F.monotonically_increasing_id()), "bench-windows")
    parts = [windows.select("window", "size", "w", F.least(F.lit(shingle), "size").alias("k"), F.size("w").alias("n"))
             .filter(F.col("k") == k).filter(F.col("n") >= k).select(
                 "window", "size", "w", F.explode(F.sequence(F.lit(0), F.col("n") - k)).alias("at"))
             .select("window", "size", _shingle_at("w", F.col("at"), k).alias("h")) for k in lengths]
    window_shingles = parts[0]
    for p in parts[1:]:
        window_shingles = window_shingles.unionAll(p)

    item_prints = stored(fingerprints(item_shingles, ["row", "size"]), "bench-prints")
    prints = stored(fingerprints(window_shingles, ["window", "size"]), "bench-window-prints")
    cuts = list(enumerate(segments(radius, width=BLOCK_BITS)))
    value = lambda shift, bits: F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << bits) - 1))
    table = None
    for b, (shift, bits, near) in cuts:
        if near < 0:
            continue
        t = item_prints.select("row", "size", F.col("fp").alias("item_fp"), F.lit(b).alias("block"),
                               F.explode(_balls(value(shift, bits), bits, near)).alias("value"))
        table = t if table is None else table.unionAll(t)
    probes = prints.select("window", "size", "fp", F.posexplode(F.array(*[value(s, n) for _, (s, n, _) in cuts])).alias("block", "value"))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    met = probes.join(stored(table, "bench-table"), ["size", "block", "value"]).filter(distance <= radius)
    met = met.groupBy("window", "row").agg(F.min(distance).alias("distance"))

    a = window_shingles.groupBy("window", "h").agg(F.count(F.lit(1)).alias("c"))
    b = item_shingles.groupBy("row", "h").agg(F.count(F.lit(1)).alias("d"))
    shared = met.join(a, "window").join(b, ["row", "h"]).groupBy("window", "row", "distance").agg(
        F.sum(F.least("c", "d")).alias("shared"))
    k, n = F.least(F.lit(shingle), "size"), F.size("w")
    sized = windows.select("window", "id", "text_hash", "start", (n - k + 1).alias("here"))
    whole = own.select("row", "item", (F.col("size") - F.col("k") + 1).alias("there"))
    scored = shared.join(sized, "window").join(whole, "row").withColumn(
        "similarity", F.col("shared") / (F.col("here") + F.col("there") - F.col("shared")))
    best = scored.filter(F.col("similarity") >= similarity).groupBy("id", "text_hash", "item", "row").agg(
        F.min_by(F.struct("start", "similarity", "distance"), F.struct(-F.col("similarity"), F.col("start"))).alias("m"))
    return best.select(F.col("id").alias(key), "text_hash", "item", F.col("m.start").cast("long").alias("start"),
                       F.col("m.similarity").alias("similarity"), F.col("m.distance").alias("distance"))


def _result(none: DataFrame, own: DataFrame, key: str) -> DataFrame:
    return none.select(F.col("id").alias(key), "text_hash", F.lit(None).cast(own.schema["item"].dataType).alias("item"),
                       F.lit(None).cast("long").alias("start"), F.lit(None).cast("double").alias("similarity"),
                       F.lit(None).cast("int").alias("distance"))


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns kept, null keys and repeated rows included."""
    key, text = options.get("key", "doc_id"), options.get("text", "text")
    bad = matches(docs, items, **options).select(F.col(key).alias("_bad_key"), F.col("text_hash").alias("_bad_text")).distinct()
    return docs.join(bad, docs[key].eqNullSafe(F.col("_bad_key")) & (F.xxhash64(docs[text]) == F.col("_bad_text")), "left_anti")


# The same result by brute force over every window that begins at a shared shingle.
ORACLE = """
WITH d AS (SELECT doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') if x <> ''] AS w FROM documents),
b AS (SELECT item_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') if x <> ''] AS w FROM benchmark),
bi AS (SELECT item_id, w, len(w) AS size, least(5, len(w)) AS k FROM b WHERE len(w) > 0),
bs AS (SELECT item_id, size, k, array_to_string(w[p + 1:p + k], ' ') AS s
       FROM (SELECT *, unnest(range(0, size - k + 1)) AS p FROM bi)),
ks AS (SELECT DISTINCT k FROM bi),
ds AS (SELECT doc_id, k, n, p, array_to_string(w[p + 1:p + k], ' ') AS s
       FROM (SELECT doc_id, w, k, len(w) AS n, unnest(range(0, len(w) - k + 1)) AS p FROM d, ks WHERE len(w) >= k)),
spots AS (SELECT DISTINCT ds.doc_id, bs.item_id, bs.size, bs.k, ds.n,
            greatest(0, least(ds.p, ds.n - bs.size)) AS start
          FROM ds JOIN bs ON ds.k = bs.k AND ds.s = bs.s),
ws AS (SELECT t.doc_id, t.item_id, t.start, ds.s, count(*) AS c
       FROM spots t JOIN ds ON ds.doc_id = t.doc_id AND ds.k = t.k AND ds.p >= t.start
        AND ds.p <= t.start + least(t.size, t.n) - t.k GROUP BY ALL),
bc AS (SELECT item_id, s, count(*) AS c FROM bs GROUP BY ALL),
sh AS (SELECT ws.doc_id, ws.item_id, ws.start, sum(least(ws.c, bc.c)) AS shared
       FROM ws JOIN bc ON bc.item_id = ws.item_id AND bc.s = ws.s GROUP BY ALL),
sim AS (SELECT sh.doc_id, sh.item_id, sh.start,
          CAST(shared AS DOUBLE) / CAST((least(t.size, t.n) - t.k + 1) + (t.size - t.k + 1) - shared AS DOUBLE) AS similarity
        FROM sh JOIN spots t ON t.doc_id = sh.doc_id AND t.item_id = sh.item_id AND t.start = sh.start)
SELECT doc_id, item_id, CAST(start AS BIGINT) AS start, similarity FROM sim WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""
