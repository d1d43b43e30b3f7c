"""Secret scan with a random forest against false positives.

Long strings with digits and values assigned to a secret's name, whatever
their length and signs, are findings.  A forest, trained on labelled
findings, tells secrets from placeholders, addresses, numbers, paths and
identifiers by length, character transitions, dictionary coverage, path signs
and the neighbouring words.  Transition and word counts cover all texts.

The corpus has no labels of findings, so findings with a known truth are
planted: values of many kinds, drawn at random, are put behind names of secrets
and of other things into surroundings cut from the corpus.  Drawn secrets behind
a secret's name or alone are secrets; words and placeholders behind the same
names are not, nor are drawn values behind the name of an id or a checksum.  So
no single feature tells the label.  Their number is bounded.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from courtline.llm.common import stored, words

LEAST_LENGTH = 12
# Planted findings that the forest is trained on, and surroundings cut from the corpus for them, at most.
MOST_TRAINING_ROWS, MOST_SURROUNDINGS = 20_000, 2_000
DICTIONARY_WORDS = 5_000
NEIGHBOURS = 16
TREES, DEPTH, SEED = 40, 10, 7

_RUN = re.compile(r"[A-Za-z0-9+/_\-.@=:]{%d,}" % LEAST_LENGTH)
_DIGIT = re.compile(r"\d")
# Names before an assigned secret, and the form of one provider's key ids.
_NAMES = r"(?:token|password|passwd|pwd|secret|api[_-]?key|access[_-]?key|auth)[\"']?"
_ASSIGNED = re.compile(_NAMES + r"\s*[=:]\s*[\"']?$", re.I)
_NAME, _LONGEST_NAME, _SIGN = re.compile(_NAMES + "$", re.I), 11, re.compile("[=:]")
# An assigned value: quoted, up to the same quote on its line (escapes included), or else up to the next blank.
_VALUE = re.compile(r"\s*(?:\"((?:[^\"\\\n]|\\.)+)\"|'((?:[^'\\\n]|\\.)+)'|[\"']?([^\s\"']\S*))")
_PROVIDER = re.compile(r"AKIA[A-Z0-9]{16}")
# Forms that are never secrets.
_HARMLESS = re.compile(r"\d{1,3}(?:\.\d{1,3}){3}|[\d.\-+/:]+|[\w.+\-]+@[\w\-]+(?:\.[\w\-]+)+|https?://.*|(?:/[\w.\-]+)+/?", re.I)

# Names that planted values stand behind, and words that stand where a secret should.
_SECRET_NAMES = ["token", "password", "passwd", "pwd", "secret", "api_key", "api-key", "apikey", "access_key", "auth"]
_OTHER_NAMES = ["id", "commit", "sha", "checksum", "etag", "version", "ref", "order", "build", "page"]
_PLACEHOLDERS = ["changeme", "please", "example", "never", "none", "null", "todo", "test", "here", "required", "hidden", "your_token_here",
                 "xxxxxxxx", "********", "<password>", "${TOKEN}", "redacted", "forgotten", "unknown", "optional"]
_SECRET_WORDS, _OTHER_WORDS = (frozenset(re.sub("[^a-z]", "", n) for n in names) for names in (_SECRET_NAMES, _OTHER_NAMES))

FEATURES = ["chars", "entropy", "digits", "uppers", "lowers", "others", "changes", "transition", "covered",
            "slashes", "dots", "ats", "quoted", "assigned", "right_known", "left_secret", "left_other", *[f"left_{i}" for i in range(NEIGHBOURS)]]


def transition_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of ASCII character pairs over all texts, as a 128 x 128 matrix."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(128 * 128, np.int64)
        for f in frames:
            for t in f["text"]:
                for lo in range(0, len(t), 1 << 20):
                    b = np.minimum(np.frombuffer(t[lo:lo + (1 << 20) + 1].encode("latin-1", "replace"), np.uint8), 127).astype(np.int32)
                    total += np.bincount(b[:-1] * 128 + b[1:], minlength=128 * 128)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"pair": at, "n": total[at]})

    src = docs.select(F.col(text).alias("text")).filter("text IS NOT NULL")
    got = src.mapInPandas(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(128 * 128)  # as many rows at most
    out[got["pair"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.int64)
    out = out.reshape(128, 128)
    return np.log((out + 0.5) / (out.sum(axis=1, keepdims=True) + 64))


def dictionary(docs: DataFrame, text: str = "text") -> frozenset[str]:
    """The most frequent words of 3 to 12 letters over all texts, ties by code point."""
    w = docs.select(F.explode(words(text)).alias("w")).filter(F.length("w").between(3, 12) & F.col("w").rlike("^[a-z]+$"))
    top = w.groupBy("w").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").limit(DICTIONARY_WORDS)
    return frozenset(r["w"] for r in top.collect())


def _covered(value: str, known: frozenset[str]) -> float:
    """Share of the characters that dictionary words cover, taken greedily from the left, longest first."""
    low, i, hit = value.lower(), 0, 0
    while i < len(low):
        n = next((n for n in range(min(12, len(low) - i), 2, -1) if low[i:i + n] in known), 0)
        hit += n
        i += n or 1
    return hit / len(low)


def describe(text: str, start: int, end: int, table: np.ndarray, known: frozenset[str]) -> list[float]:
    """The features of one finding."""
    value = text[start:end]
    n = len(value)
    counts = np.unique(np.frombuffer(value.encode("latin-1", "replace"), np.uint8), return_counts=True)[1] / n
    kinds = [0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3 for c in value]
    codes = np.minimum(np.frombuffer(value.encode("latin-1", "replace"), np.uint8), 127)
    before = text[max(0, start - 40):start]
    left, right = before.split(), text[end:end + 40].split(maxsplit=1)
    neighbour = [0.0] * NEIGHBOURS
    name = ""
    if left:  # the nearest word before, signs and quotes between passed over
        name = next((w for w in (re.sub(r"[^a-z]", "", x.lower()) for x in reversed(left)) if w), "")
        neighbour[zlib.crc32(name.encode()) % NEIGHBOURS] = 1.0
    return [
        float(n), float(-(counts * np.log2(counts)).sum()), *[kinds.count(k) / n for k in range(4)],
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n, float(table[codes[:-1], codes[1:]].mean()) if n > 1 else 0.0,
        _covered(value, known), float(value.count("/")), float(value.count(".")), float(value.count("@")),
        float(before[-1:] in "\"'" and before != ""), float(bool(re.search(r"[=:]\s*[\"']?$", before))),
        float(bool(right) and re.sub(r"[^a-z]", "", right[0].lower()) in known),
        float(name in _SECRET_WORDS), float(name in _OTHER_WORDS), *neighbour]


def assigned(text: str) -> list[tuple[int, int, int]]:
    """(name, start, end) of values behind a secret's name, without quotes and the signs that close a clause behind a bare value."""
    out, at = [], 0
    for sign in _SIGN.finditer(text):
        behind = sign.start()
        if behind < at:
            continue
        while behind > at and text[behind - 1].isspace():
            behind -= 1
        name = _NAME.search(text, max(at, behind - _LONGEST_NAME), behind)
        value = name and _VALUE.match(text, sign.end())
        if not value:
            continue
        start, at = value.span(value.lastindex)
        if value.lastindex == 3:
            while at > start + 1 and text[at - 1] in "\"',;)]}":
                at -= 1
        out.append((name.start(), start, at))
    return out


def spans(text: str) -> list[tuple[int, int]]:
    """Findings of a text, in order: assigned values, and long runs with a digit outside of them, without an assignment's name."""
    sure = assigned(text)
    out, at = [(start, end) for _, start, end in sure], 0
    for m in _RUN.finditer(text):
        start, end = m.span()
        value = m[0]
        while at < len(sure) and sure[at][2] <= start:
            at += 1
        if at < len(sure) and sure[at][1] < end:  # the name, if inside, ends what stands before it
            end = max(start, sure[at][0])
            value = text[start:end]
        cut = max(value.rfind("=", 0, len(value.rstrip("=")) or 1), -1)
        if cut >= 0:
            start += cut + 1
        while end > start and text[end - 1] in ".:-":
            end -= 1
        if end - start >= LEAST_LENGTH and _DIGIT.search(text, start, end):
            out.append((start, end))
    return sorted(out)


def rule_label(text: str, start: int, end: int) -> int | None:
    """What a plain rule says of a finding, for comparison: 1 for a provider's key or an assigned value, 0 for a harmless form, else None."""
    value = text[start:end]
    if _HARMLESS.fullmatch(value):
        return 0
    if _PROVIDER.fullmatch(value) or _ASSIGNED.search(text[max(0, start - 40):start]):
        return 1
    return None


def drawn_secret(r: random.Random) -> str:
    """A random value of one of the kinds that secrets have."""
    kind = r.randrange(7)
    hexed, letters = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"
    alnum = letters + letters.upper() + "0123456789"
    if kind == 0:
        value = "".join(r.choices(hexed, k=r.choice((16, 18, 24, 32, 40, 40, 64))))
        return value.upper() if r.random() < 0.3 else value
    if kind in (1, 2):
        return "".join(r.choices(alnum + ("+/-_" if kind == 2 else ""), k=r.randrange(12, 60)))
    if kind == 3:
        return "AKIA" + "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=16))
    if kind == 4:
        return "".join(r.choices(alnum + "!$%&~?^#", k=r.randrange(8, 20)))
    if kind == 5:
        return "".join(r.choices(letters, k=r.randrange(4, 9))) + "".join(r.choices("0123456789", k=r.randrange(1, 5))) + r.choice(("", "!", "$"))
    return "".join(r.choices(letters + letters.upper(), k=r.randrange(14, 32)))


def drawn_other(r: random.Random, known: Sequence[str]) -> str:
    """A random value of one of the kinds that stand where a secret might: words, placeholders, addresses, numbers, paths, names.

    Half of the words are the corpus's, half are made of syllables, as names are that no dictionary holds.
    """
    def word() -> str:
        if known and r.random() < 0.5:
            return r.choice(known)
        return "".join(r.choice("bcdfghklmnprstvw") + r.choice(("a", "e", "i", "o", "u", "ai", "ou")) + r.choice(("", "", "n", "r", "s", "l"))
                       for _ in range(r.randrange(1, 4)))

    kind = r.randrange(10)
    if kind <= 1:
        return r.choice(_PLACEHOLDERS)
    if kind <= 3:
        value = r.choice(("", "", "-", "_", ".")).join(word() for _ in range(r.randrange(1, 4)))
        return r.choice((value, value, value.upper(), value.capitalize()))
    if kind == 4:
        return ".".join(str(r.randrange(256)) for _ in range(4))
    if kind == 5:
        return r.choice(("", "", "+")) + "".join(r.choices("0123456789", k=r.randrange(10, 20)))
    if kind == 6:
        return f"{r.randrange(1990, 2030)}-{r.randrange(1, 13):02}-{r.randrange(1, 29):02}" + r.choice(("", f"T{r.randrange(24):02}:{r.randrange(60):02}:00"))
    if kind == 7:
        return f"{word()}.{r.randrange(100)}@{word()}{r.randrange(10)}.{r.choice(('example.com', 'org', 'net'))}"
    if kind == 8:
        return r.choice(("", "https:/")) + "".join(f"/{word()}{r.choice(('', str(r.randrange(1000))))}" for _ in range(r.randrange(2, 6)))
    return f"{word()}{r.choice('-_.')}{word()}{r.choice('-_')}{r.randrange(10, 99999)}"


def planted(around: str, r: random.Random, known: Sequence[str]) -> tuple[str, int, int, int]:
    """(text, start, end, label): a drawn value put at the middle of ``around``."""
    middle = len(around) // 2
    left, right = around[:middle], around[middle:]
    place, secret = r.randrange(4), r.random() < 0.5
    if place == 3:  # alone
        opening = closing = ""
        label = int(secret)
    else:
        name = r.choice(_OTHER_NAMES if place == 2 else _SECRET_NAMES)
        name = r.choice((name, name, name.upper()))
        opening, closing = r.choice(((f'{name} = "', '"'), (f"{name}=", ""), (f"{name}: ", ""), (f'"{name}": "', '"'), (f"{name} = '", "'")))
        label = int(secret and place != 2)
    value = drawn_secret(r) if secret else drawn_other(r, known)
    if place == 3 and secret and (len(value) < LEAST_LENGTH or not _DIGIT.search(value)):
        value = "".join(r.choices("0123456789abcdef", k=40))
    text = f"{left} {opening}{value}{closing} {right}"
    start = len(left) + 1 + len(opening)
    return text, start, start + len(value), label


def planted_findings(docs: DataFrame, table: np.ndarray, known: frozenset[str], *, text: str = "text",
                     most_rows: int = MOST_TRAINING_ROWS) -> DataFrame:
    """(value, start, label, features...) of at most ``most_rows`` planted findings, always the same for the same texts.

    Surroundings are 120 characters each of different texts, those with the
    smallest hashes; from none of them nothing is planted.
    """
    shared = docs.sparkSession.sparkContext.broadcast((table, known))
    size = F.length(text)
    cut = docs.filter(size > 0).select(F.xxhash64(text).alias("h"), F.substring(
        F.col(text), (F.pmod(F.xxhash64(text), size) + 1).cast("int"), F.lit(120)).alias("around"))
    around = stored(cut.groupBy("h").agg(F.min("around").alias("around")).orderBy("h").limit(MOST_SURROUNDINGS), "secret-surroundings")
    n = around.count()
    each = most_rows // n if n else 0

    def plant(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, words_ = shared.value
        listed = sorted(words_)
        for f in frames:
            for h, piece in zip(f["h"], f["around"]):
                r = random.Random(int(h))
                got = [planted(piece, r, listed) for _ in range(each)]
                out = pd.DataFrame([describe(t, a, b, pairs, words_) for t, a, b, _ in got], columns=FEATURES)
                out.insert(0, "label", [x for *_, x in got])
                out.insert(0, "start", [a for _, a, _, _ in got])
                out.insert(0, "value", [t[a:b] for t, a, b, _ in got])
                yield out

    return around.repartition(8, "h").mapInPandas(
        plant, "value string, start long, label int, " + ", ".join(f"{c} double" for c in FEATURES))


def findings(docs: DataFrame, table: np.ndarray, known: frozenset[str], *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, start, length, value, label, features...) per finding; ``label`` is what a plain rule says, null where it says nothing."""
    shared = docs.sparkSession.sparkContext.broadcast((table, known))
    src = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = StructType([StructField("key", src.schema["key"].dataType), StructField("start", LongType()),
                         StructField("length", LongType()), StructField("value", StringType()), StructField("label", IntegerType()),
                         *[StructField(n, DoubleType()) for n in FEATURES]])

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, words_ = shared.value
        for f in frames:
            texts = f.column("text").to_pylist()
            got = [(i, a, b) for i, t in enumerate(texts) if t for a, b in spans(t)]
            shown = np.array([describe(texts[i], a, b, pairs, words_) for i, a, b in got], np.float64).reshape(len(got), len(FEATURES))
            yield pa.RecordBatch.from_arrays([
                f.column("key").take(pa.array([i for i, _, _ in got], pa.int64())),
                pa.array([a for _, a, _ in got], pa.int64()), pa.array([b - a for _, a, b in got], pa.int64()),
                pa.array([texts[i][a:b] for i, a, b in got], pa.string()),
                pa.array([rule_label(texts[i], a, b) for i, a, b in got], pa.int32()),
                *[pa.array(shown[:, j], pa.float64()) for j in range(len(FEATURES))]], names=schema.names)

    return src.mapInArrow(batches, schema)


def train(labelled: DataFrame, most_rows: int = MOST_TRAINING_ROWS):
    """A forest on findings with a ``label``, at most ``most_rows`` of them; None unless both labels occur."""
    rows = labelled.filter("label IS NOT NULL").orderBy(F.xxhash64("value", "start"), "value", "start").limit(most_rows)
    rows = stored(rows.select("label", *FEATURES), "secret-sample")
    if rows.select("label").distinct().count() < 2:
        return None
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
                                  featureSubsetStrategy="onethird").fit(assembled)


def classify(found: DataFrame, model) -> DataFrame:
    """``found`` with ``score``, the forest's probability that a finding is a secret; 0.5 without a forest."""
    if model is None:
        return found.withColumn("score", F.lit(0.5))
    out = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found))
    return out.withColumn("score", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text", train_on=None) -> DataFrame:
    """(key, start, length, value, label, score, secret) per finding in the whole texts of ``docs``.

    ``train_on``, a condition on ``key``, restricts the texts that surroundings of
    planted findings are cut from.  ``label`` is a plain rule's opinion, which the
    forest does not see.  Null and empty texts hold nothing; equal rows give
    equal findings, each its own; keys may be null; other columns are not read;
    an empty table gives an empty result.
    """
    src = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    table, known = transition_counts(src), dictionary(src)
    found = findings(src, table, known, key="key")
    model = train(planted_findings(src if train_on is None else src.filter(train_on), table, known))
    return classify(found, model).select(F.col("key").alias(key), "start", "length", "value", "label", "score",
                                         (F.col("score") >= 0.5).alias("secret"))
