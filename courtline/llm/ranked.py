"""Ranked lexical search by NRA: sorted access only, with score intervals.

A first pass cuts every whole text into terms and keeps, per document, its
length and the counts of the terms that a query holds.  A second pass takes the
documents in shards of bounded size.  A shard's postings are sorted by impact
within each term, and for each query its lists are read from the top, all to
the same impact in a round.  What was read of a document is the lower end of
its score; the upper end adds, for every list that has not shown the document,
what that list may still hold.  A query is done in a shard when no document
that may be among the best has an open interval and no unread one can get
there; so membership, ties and scores are exact.  Shards share nothing but the
bar that a task's earlier shards have set, and the shards' best are merged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from courtline.llm.common import running, spread_of, stored

# Documents and postings of a shard at most, but for its last document.
SHARD_DOCS, SHARD_POSTINGS = 20_000, 2_000_000
# Query terms of one block, broadcast to the tasks; more queries go through in further blocks.
MOST_TERMS = 1_000_000
# Impacts stay below 2**36: floor(1000 ln(2N + 2)) times less than a million.
IMPACT_BITS = 36

# Bytes that end a term become blanks, A-Z lower case; bytes above 127, of any other letter or sign, stay.
_CUT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order, repeats included."""
    return text.translate(_CUT).split() if text else []


def weight(n_docs: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Queries:
    """Queries of a block as ranges of term numbers, each with how often the query holds it."""
    ids: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    times: np.ndarray


def _query_terms(queries: DataFrame, text: str) -> DataFrame:
    """(q, term, times) of every query row."""
    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for f in frames:
            for q, body in zip(f.column(0).to_pylist(), f.column(1).to_pylist()):
                found = Counter(terms_of(body))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([q] * len(found), pa.int64()), pa.array(list(found), pa.binary()),
                         pa.array(list(found.values()), pa.int64())], names=["q", "term", "times"])

    return queries.select("q", F.col(text).cast("binary")).mapInArrow(count, "q long, term binary, times long")


def _term_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(row, key, n, terms, tfs) per document: its terms, repeats included, and the counts of those in the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = StructType([*docs.schema.fields[:2], StructField("n", LongType()), StructField("terms", ArrayType(IntegerType())),
                         StructField("tfs", ArrayType(IntegerType()))])

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for f in frames:
            ns, ends, terms, tfs = [], [0], [], []
            body = f.column(2)
            for i in range(len(body)):
                found = terms_of(body[i].as_py())
                counts = Counter(map(number, found))
                counts.pop(None, None)
                ns.append(len(found))
                terms.extend(counts)
                tfs.extend(counts.values())
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [f.column(0), f.column(1), pa.array(ns, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tfs, pa.int32()))], names=schema.names)

    return docs.mapInArrow(batches, schema)


class Shard:
    """Impact-sorted lists of a shard's documents."""

    def __init__(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, weights: np.ndarray,
                 n_docs: int, total: int):
        m = 75 + (25 * n * n_docs) // max(total, 1)
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        # One sorted array of (term, falling impact): a search in it finds how far a list is read.
        sort_key = (term.astype(np.int64) << IMPACT_BITS) - impact
        order = np.argsort(sort_key, kind="stable")
        self.sort_key, self.doc, self.impact, self.size = sort_key[order], doc[order], impact[order], len(n)

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the terms' lists begin and end; no impact reaches 2**IMPACT_BITS."""
        base = terms.astype(np.int64) << IMPACT_BITS
        return (np.searchsorted(self.sort_key, base - (1 << IMPACT_BITS) + 1),
                np.searchsorted(self.sort_key, base, side="right"))

    def best(self, terms: np.ndarray, times: np.ndarray, k: int, bar: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, exact scores, postings read) of all that may be among the ``k`` best and score at least ``bar``."""
        start, end = self.lists(terms)
        held = end > start
        terms, times, start, end = terms[held], times[held], start[held], end[held]
        lower = np.zeros(self.size, np.int64)
        # For each document, how often the query holds the unexhausted lists that have shown it.
        shown = np.zeros(self.size, np.int64)
        none = np.zeros(0, np.int64)
        if not len(terms):
            return none, none, 0
        base = terms.astype(np.int64) << IMPACT_BITS
        cap = self.impact[start]
        at, edge, read = start.copy(), int(cap.max()), 0
        while True:
            # Each round reads all impacts of at least the edge, from every list.
            to = np.searchsorted(self.sort_key, base - edge, side="right") if edge > 0 else end
            to = np.maximum(np.minimum(to, end), at)
            self._read(lower, shown, at, to, times)
            read += int((to - at).sum())
            done = (to == end) & (at < end)
            if done.any():
                self._add(shown, start[done], end[done], -times[done])
            at = to
            open_ = at < end
            if not open_.any():
                break
            # What follows in an open list is below the edge, and in an unread one at most its first impact.
            left = int((times * np.minimum(edge, cap))[open_].sum())
            upper = lower + left - edge * shown
            if self.size > k:
                bar = max(bar, int(np.partition(lower, self.size - k)[self.size - k]))
            if not ((upper >= bar) & (upper > lower)).any():
                break
            edge = edge * 5 // 8
        if self.size > k:
            bar = max(bar, int(np.partition(lower, self.size - k)[self.size - k]))
        found = np.flatnonzero(lower >= bar)
        return found, lower[found], read

    def _at(self, start: np.ndarray, end: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = end - start
        first = np.cumsum(sizes) - sizes
        return np.arange(int(sizes.sum())) + np.repeat(start - first, sizes), np.repeat(times, sizes)

    def _read(self, lower: np.ndarray, shown: np.ndarray, start: np.ndarray, end: np.ndarray, times: np.ndarray) -> None:
        i, t = self._at(start, end, times)
        if len(i):
            gain = t * self.impact[i]
            if float(gain.sum(dtype=np.float64)) < 2.0 ** 52:  # then sums in doubles are exact
                lower += np.bincount(self.doc[i], gain, self.size).astype(np.int64)
            else:
                np.add.at(lower, self.doc[i], gain)
            shown += np.bincount(self.doc[i], t, self.size).astype(np.int64)

    def _add(self, shown: np.ndarray, start: np.ndarray, end: np.ndarray, times: np.ndarray) -> None:
        i, t = self._at(start, end, times)
        shown += np.bincount(self.doc[i], t, self.size).astype(np.int64)


def _shards(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole documents, each of bounded size."""
    held: list[pa.RecordBatch] = []
    docs = postings = 0
    for f in frames:
        at = 0
        ends = np.cumsum(np.diff(f.column(3).offsets.to_numpy()))
        while at < f.num_rows:
            before = int(ends[at - 1]) if at else 0
            fit = int(np.searchsorted(ends, before + SHARD_POSTINGS - postings, side="right")) - at
            take = min(max(fit, 1), SHARD_DOCS - docs, f.num_rows - at)
            held.append(f.slice(at, take))
            docs, postings, at = docs + take, postings + int(ends[at + take - 1]) - before, at + take
            if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield pa.Table.from_batches(held)
                held, docs, postings = [], 0, 0
    if docs:
        yield pa.Table.from_batches(held)


def _best(counts: DataFrame, queries: Queries, weights: np.ndarray, n_docs: int, total: int, k: int) -> DataFrame:
    """(q, row, key, score): every shard's best of every query."""
    shared = counts.sparkSession.sparkContext.broadcast((queries, weights))
    schema = StructType([StructField("q", LongType()), StructField("row", LongType()), counts.schema["key"],
                         StructField("score", LongType())])

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, w = shared.value
        bars = np.ones(len(asked.ids), np.int64)
        tops: list[np.ndarray] = [np.zeros(0, np.int64)] * len(asked.ids)
        for t in _shards(frames):
            t = t.combine_chunks()
            terms, tfs = (t.column(c).chunk(0) for c in ("terms", "tfs"))
            n = t.column("n").to_numpy()
            doc = np.repeat(np.arange(t.num_rows), np.diff(terms.offsets.to_numpy()))
            shard = Shard(n, doc, terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64),
                          w, n_docs, total)
            key, row = t.column("key").chunk(0), t.column("row").to_numpy()
            rank = pc.rank(key, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy()
            out_q, out_at, out_score = [], [], []
            for i, q in enumerate(asked.ids):
                span = slice(asked.starts[i], asked.starts[i + 1])
                found, score, _ = shard.best(asked.terms[span], asked.times[span], k, int(bars[i]))
                if not len(found):
                    continue
                first = np.lexsort((row[found], rank[found], -score))[:k]
                found, score = found[first], score[first]
                tops[i] = np.sort(np.concatenate([tops[i], score]))[-k:]
                if len(tops[i]) == k:
                    bars[i] = max(bars[i], tops[i][0])
                out_q.append(np.full(len(found), q))
                out_at.append(found)
                out_score.append(score)
            if out_q:
                at = np.concatenate(out_at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_q), pa.int64()), pa.array(row[at], pa.int64()), key.take(pa.array(at)),
                     pa.array(np.concatenate(out_score), pa.int64())], names=schema.names)

    return counts.mapInArrow(batches, schema)


def search(docs: DataFrame, queries: DataFrame, *, k: int = 20, key: str = "doc_id", text: str = "text",
           query_key: str = "item_id", query_text: str = "text", most_terms: int = MOST_TERMS) -> DataFrame:
    """(query_key, rank, key, score): for each row of ``queries`` its ``k`` best rows of ``docs``, score above 0.

    Every row is a document of its own, repeated rows and keys included; equal
    scores rank by ascending key, null keys last, then in any fixed order.
    Null, empty and term-free texts are never found, and queries without terms
    find nothing.  Other columns are not read.  Empty tables give an empty
    result.  Query terms are broadcast, at most ``most_terms`` and the terms of
    one query at a time; further queries go through in further blocks, each
    against all documents.
    """
    spark = docs.sparkSession
    asked = stored(queries.withColumn("q", F.monotonically_increasing_id())
                   .select("q", F.col(query_key).alias("asked"), F.col(query_text).alias("text")), "search-queries")
    pairs = stored(_query_terms(asked, "text"), "search-terms")
    sizes = stored(pairs.groupBy("q").agg(F.count(F.lit(1)).alias("n")), "search-sizes")
    blocks = stored(running(sizes, [], ["q"], spread_of("q"), sums={"before": "n"})
                    .select("q", F.floor(F.col("before") / most_terms).alias("block")), "search-blocks")
    body = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).cast("binary").alias("body"))
    found = []
    for (block,) in blocks.select("block").distinct().orderBy("block").collect():
        part = pairs.join(blocks.filter(F.col("block") == block), "q").select("q", "term", "times").toPandas()
        part = part.sort_values(["q", "term"], ignore_index=True)
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for t in part["term"]}))}
        ids, starts = np.unique(part["q"].to_numpy(dtype=np.int64), return_index=True)
        numbers = np.array([vocabulary[bytes(t)] for t in part["term"]], np.int64)
        block_queries = Queries(ids, np.append(starts, len(part)), numbers, part["times"].to_numpy(dtype=np.int64))
        counts = stored(_term_counts(body, vocabulary), "search-counts")
        n_docs, total = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(vocabulary), np.int64)
        for term, df in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            weights[term] = weight(n_docs, df)
        found.append(stored(_best(counts, block_queries, weights, n_docs, total, k), "search-best"))
    if not found:
        return spark.createDataFrame([], StructType([
            StructField(query_key, asked.schema["asked"].dataType), StructField("rank", IntegerType()),
            StructField(key, body.schema["key"].dataType), StructField("score", LongType())]))
    best = found[0]
    for more in found[1:]:
        best = best.unionAll(more)
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("key"), "row")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("q", "asked"), "q").select(F.col("asked").alias(query_key), "rank", F.col("key").alias(key), "score")


def _terms_sql(text: str) -> str:
    return ("regexp_extract_all(translate(" + text + ", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


# The contract of the query, stated over all pairs of a document and an item that share a term.
ORACLE = f"""
WITH d AS (SELECT doc_id, unnest({_terms_sql('text')}) AS t FROM documents WHERE text IS NOT NULL),
tf AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
len AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
tot AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM len),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest({_terms_sql('text')}) AS t FROM benchmark) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), tot),
s AS (SELECT item_id, doc_id,
             sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))))::BIGINT AS score
      FROM q JOIN tf USING (t) JOIN w USING (t) JOIN len USING (doc_id), tot GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 20
"""
