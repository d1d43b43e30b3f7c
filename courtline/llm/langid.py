"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every n-gram of every labelled text: each task adds up one
dense (language, bucket) matrix of a bounded number of languages at a time, and
Spark adds those up by language.  The matrix of log-probabilities is broadcast
in blocks of at most ``BLOCK`` languages, a fixed size each, and a batch of
texts is scored by sparse sums in numpy, block after block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import stored

BUCKET_BITS = 14
SIZES = (1, 2, 3)
SMOOTHING = 0.5
# Languages of one block: 32 MB of log-probabilities, broadcast on its own.
BLOCK = 512
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_ODD = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_CHUNK = 1 << 20


def grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of all character n-grams of a lower-cased text, in chunks of bounded size."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    for lo in range(0, len(chars), _CHUNK):
        part = chars[lo:lo + _CHUNK + max(SIZES) - 1]
        for n in SIZES:
            count = min(_CHUNK, len(part) - n + 1)
            if count <= 0:
                continue
            code = np.full(count, n, np.uint32)
            for i in range(n):
                code = (code ^ part[i:i + count]) * _ODD[i]
                code ^= code >> np.uint32(15)
            yield code >> np.uint32(32 - BUCKET_BITS)


@dataclass
class Block:
    """Log-probability of each bucket for some languages (float32), their priors and names."""
    languages: list[str]
    log_probs: np.ndarray  # (buckets, languages)
    log_priors: np.ndarray

    def scores(self, text: str) -> np.ndarray:
        """Joint log-likelihood per language."""
        total = self.log_priors.copy()
        for g in grams(text):
            # A text is a sparse row of bucket counts; long ones repeat buckets and are summed by bucket.
            if len(g) > 1 << BUCKET_BITS:
                total += np.bincount(g, minlength=1 << BUCKET_BITS) @ self.log_probs
            else:
                total += self.log_probs[g].sum(axis=0, dtype=np.float64)
        return total

    def better(self, text: str | None, lang: str, best: float, mass: float) -> tuple[str, float, float]:
        """The best language so far, its log-likelihood and all languages' likelihood beside it, with this block's."""
        if not text or not _LETTER.search(text):
            return lang, best, mass
        total = self.scores(text)
        at = int(total.argmax())  # of equal ones the first in code-point order
        if total[at] > best:
            lang, mass, best = self.languages[at], mass * float(np.exp(best - total[at])), float(total[at])
        return lang, best, mass + float(np.exp(total - best).sum())


@dataclass
class Model:
    """All languages of the training rows, in blocks in code-point order; none where there were no rows."""
    blocks: list[Block]

    @property
    def languages(self) -> list[str]:
        return [x for b in self.blocks for x in b.languages]

    def predict(self, text: str | None) -> tuple[str, float]:
        """Most likely language and its probability; ``und`` and 0 for null texts and those without a letter."""
        so_far = (UNKNOWN, -np.inf, 0.0)
        for b in self.blocks:
            so_far = b.better(text, *so_far)
        return so_far[0], 1.0 / so_far[2] if so_far[2] else 0.0


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves ``remainder``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % modulus == remainder


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> Model:
    """Fit on all rows with a text and a language, any number of languages.

    Rows with a null in either are passed over; equal rows count each time;
    with no rows at all the model knows no language and predicts ``und``.
    What comes to the driver is the model: a vector of 64 KB a language.
    """
    src = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    size = 1 << BUCKET_BITS

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}

        def counted() -> Iterator[pd.DataFrame]:
            for language, c in seen.items():
                at = np.flatnonzero(c)
                yield pd.DataFrame({"lang": language, "bucket": np.r_[-1, at], "n": np.r_[rows[language], c[at]]})
            seen.clear()
            rows.clear()

        for f in frames:
            for t, language in zip(f["text"], f["lang"]):
                if language not in seen:
                    if len(seen) >= BLOCK:
                        yield from counted()
                    seen[language] = np.zeros(size, np.int64)
                rows[language] = rows.get(language, 0) + 1
                for g in grams(t):
                    seen[language] += np.bincount(g, minlength=size)
        yield from counted()

    def packed(f: pd.DataFrame) -> pd.DataFrame:
        c = np.zeros(size + 1)
        c[f["bucket"].to_numpy(dtype=np.int64)] = f["n"].to_numpy(dtype=np.float64)  # the number of rows, bucket -1, comes last
        log = np.log((c[:-1] + SMOOTHING) / (c[:-1].sum() + SMOOTHING * size))
        return pd.DataFrame({"lang": f["lang"].iloc[:1], "rows": [int(c[-1])], "logs": [log.astype(np.float32).tobytes()]})

    sums = src.mapInPandas(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    vectors = stored(sums.groupBy("lang").applyInPandas(packed, "lang string, rows long, logs binary"), "language-vectors")
    total = vectors.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    languages = sorted(r["lang"] for r in vectors.select("lang").collect())
    blocks = []
    for lo in range(0, len(languages), BLOCK):
        names = languages[lo:lo + BLOCK]
        got = {r["lang"]: r for r in vectors.filter(F.col("lang").between(names[0], names[-1])).collect()}
        logs = np.stack([np.frombuffer(got[x]["logs"], np.float32) for x in names], axis=1)
        blocks.append(Block(names, logs, np.log(np.array([got[x]["rows"] for x in names]) / total)))
    return Model(blocks)


def identify(docs: DataFrame, model: Model, *, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, lang_pred and score per row.

    Equal rows get equal results, null keys are keys like any other, other
    columns are not read, and an empty table gives none.  Null texts and texts
    without a letter of any script get ``und`` and 0.  Each block of languages
    is one pass over the texts, in the same tasks.
    """
    spark = docs.sparkSession
    keep = list(keep)
    rows = docs.select(*[docs[c].alias(f"_k{i}") for i, c in enumerate(keep)], docs[text].alias("_t"),
                       F.lit(UNKNOWN).alias("_lang"), F.lit(float("-inf")).alias("_best"), F.lit(0.0).alias("_mass"))
    for block in model.blocks:
        rows = _better(rows, spark.sparkContext.broadcast(block))
    return rows.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], F.col("_lang").alias("lang_pred"),
                       F.when(F.col("_mass") > 0, 1 / F.col("_mass")).otherwise(0.0).alias("score"))


def _better(rows: DataFrame, shared) -> DataFrame:
    schema = rows.schema

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for f in frames:
            texts, *so_far = (f.column(c).to_pylist() for c in ("_t", "_lang", "_best", "_mass"))
            got = [block.better(*r) for r in zip(texts, *so_far)]
            new = [pa.array([g[i] for g in got], k) for i, k in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*f.columns[:-3], *new], names=schema.names)

    return rows.mapInArrow(batches, schema)
