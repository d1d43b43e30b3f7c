"""Toxicity by noisy-channel deobfuscation.

A writer hides words by look-alike characters, blanks between letters and
repeated letters.  Each suspicious stretch of a text becomes a lattice: every
character lists the letters it may stand for, repeats may be dropped, gaps may
be closed, each at the channel's cost.  Viterbi decoding under a character
trigram model of the corpus restores the text, and a lexicon of words and word
beginnings, learned from labelled rows, scores it.

The character model counts all trigrams of all texts given to it; each task
adds up one dense table.  Only the lexicon is fitted on a bounded sample of
labelled rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import map_texts, stored

# Letters that a character is commonly written for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "aeiou", "#": "h",
}
LETTERS = "abcdefghijklmnopqrstuvwxyzàáâäçèéêëìíîïñòóôöùúûüß"
BREAK, OTHER = 0, len(LETTERS) + 1
SYMBOLS = len(LETTERS) + 2
# Channel costs, as natural logarithms of probabilities.
SUBSTITUTED, KEPT_SYMBOL, DROPPED_SYMBOL, DROPPED_DIGIT = -1.0, -6.0, -5.0, -9.0
DROPPED_REPEAT, KEPT_REPEAT = -0.3, -1.5
CLOSED_GAP, KEPT_GAP = -0.1, -3.0
# Rows that the lexicon is fitted on at most, taken by a hash of their text.
MOST_TRAINING_ROWS = 40_000
LEAST_SUPPORT = 3
LEAST_PRECISION = 0.5
PRIOR_ROWS = 2.0
PENALTY = 0.2
STEPS = 400
# A feature of at least this support and weight, and hardly ever in other texts, may convince alone.
ALONE_SUPPORT, ALONE_WEIGHT, ALONE_OTHERS = 20, 1.0, 0.01
# Entries of a worker's one cache of tokens.
CACHE_ENTRIES = 60_000
CACHE_CHARS = 32
# Steps of a run of one sign within which costs repeat, if they do.
STEADY_WITHIN, LONGEST_TURN = 50, 6

_SYMBOL = {c: i + 1 for i, c in enumerate(LETTERS)}
# Options of a character that stands once, and of a letter's second in a row.
_OPTIONS = {c: [(c, 0.0)] for c in LETTERS} | {
    c: [*((x, SUBSTITUTED) for x in letters), (c, KEPT_SYMBOL), ("", DROPPED_DIGIT if c.isdigit() else DROPPED_SYMBOL)]
    for c, letters in LOOKALIKES.items()}
_AGAIN = {c: [(c, 0.0), ("", DROPPED_REPEAT)] for c in LETTERS}
_GAP, _GAP_ON = [("", CLOSED_GAP), (" ", KEPT_GAP)], [("", 0.0)]
_MARK_SIGNS = frozenset(c for c in LOOKALIKES if not c.isdigit())
_MARKS = re.escape("".join(sorted(_MARK_SIGNS)))
_PARTS = re.compile(r"[^\W\d_]+")
# Common punctuation that is no look-alike mark.
_AROUND = ".,;:?\"'-"
_RUN = re.compile(r"([^\W\d_])\1+")
_REPEAT = re.compile(r"([^\W\d_])\1")
_MARK = re.compile(rf"[{_MARKS}]")
_LOOKALIKE = re.compile(f"[{re.escape(''.join(LOOKALIKES))}]")
# Three or more single or doubled characters or marks, anything but letters and digits between them.
_SPACED = re.compile(rf"(?<![^\W_])(?:(?:([^\W_])\1?(?![^\W_])|[{_MARKS}])(?:[^\w{_MARKS}]|_)*){{3,}}")
_ONLY_MARKS = re.compile(rf"[{_MARKS}]+")
# What a mark in a spaced stretch may be.
GAPS, LETTERS_ONLY, EITHER = "gaps", "letters", "either"


def _is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def _is_junk(c: str) -> bool:
    """Punctuation that is no look-alike mark."""
    return not _is_word(c) and c not in _MARK_SIGNS


def _same_run(s: str, at: int, stop: int, step: int) -> int:
    """Where the run of the character at ``at`` ends, going by ``step`` until ``stop``."""
    i = at
    while i != stop and s[i] == s[at]:
        i += step
    return i


def _inner(s: str) -> str:
    """A stretch without the punctuation around it."""
    i, j = 0, len(s)
    while i < j and _is_junk(s[i]):
        i += 1
    while j > i and _is_junk(s[j - 1]):
        j -= 1
    return s[i:j]


def _without_front(s: str) -> str:
    """A stretch without the marks, or the sign repeated three times or more, that it opens with, and what punctuation is around them."""
    n = len(s)
    i = 0
    while i < n and not s[i].isalnum():
        run = _same_run(s, i, n, 1) if s[i] != "_" else i
        if run - i < 3 and s[i] not in _MARK_SIGNS:
            i = max(run, i + 1)
            continue
        if run - i < 3:
            run = i
            while run < n and s[run] in _MARK_SIGNS:
                run += 1
        while run < n and _is_junk(s[run]):
            run += 1
        return s[run:]
    return s


def _without_back(s: str) -> str:
    """A stretch without the marks that it closes with, or signs one of which stands three times or more, and the punctuation around."""
    i = len(s)
    while i and _is_junk(s[i - 1]):
        i -= 1
    if i and s[i - 1] in _MARK_SIGNS:
        while i and s[i - 1] in _MARK_SIGNS:
            i -= 1
        while i and _is_junk(s[i - 1]):
            i -= 1
        return s[:i]
    return s[:i] if re.search(r"(.)\1\1", s[i:], re.S) else s


_TABLE = np.full(0x250, OTHER, np.uint8)
for _c, _i in _SYMBOL.items():
    _TABLE[ord(_c)] = _i
for _c in " \t\n\r\x0b\x0c":
    _TABLE[ord(_c)] = BREAK


def trigram_counts(texts: Sequence[str]) -> np.ndarray:
    """Counts of all symbol trigrams of lower-cased texts, a break around each."""
    joined = np.frombuffer((" " + " ".join(texts) + " ").lower().encode("utf-32-le", "replace"), np.uint32)
    s = _TABLE[np.minimum(joined, len(_TABLE) - 1)].astype(np.int32)
    return np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS ** 3)


def char_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Trigram counts of every whole text of ``docs``; nulls and empty texts add nothing."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for f in frames:
            some, size = [], 0
            for t in f["text"]:
                some.append(t)
                size += len(t)
                if size > 1 << 20:
                    total += trigram_counts(some)
                    some, size = [], 0
            total += trigram_counts(some) if some else 0
        at = np.flatnonzero(total)
        yield pd.DataFrame({"gram": at, "n": total[at]})

    src = docs.select(F.col(text).alias("text")).filter("text IS NOT NULL AND text != ''")
    got = src.mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SYMBOLS ** 3, np.int64)  # at most SYMBOLS ** 3 rows came to the driver
    out[got["gram"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=np.int64)
    return out


def char_model(counts: np.ndarray) -> np.ndarray:
    """log P(third symbol | first two), backing off to one and none by Witten-Bell weights."""
    c3 = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
    c2 = c3.sum(axis=0)
    c1 = c2.sum(axis=0)
    p = (c1 + 1) / (c1.sum() + SYMBOLS)

    def mix(c: np.ndarray, lower: np.ndarray) -> np.ndarray:
        kinds = np.maximum((c > 0).sum(axis=-1, keepdims=True), 1)
        return (c + kinds * lower) / (c.sum(axis=-1, keepdims=True) + kinds)

    return np.log(mix(c3, mix(c2, p)))


def _is_letter(c: str) -> bool:
    """Whether ``_PARTS`` takes a character for a letter."""
    return c.isalnum() and not c.isdecimal()


class Beginnings:
    """Trie of a lexicon's features, to tell which lattices cannot hold any of them."""

    def __init__(self, features: Iterable[str]):
        self.after: list[dict[str, int]] = [{}]
        self.ends = [False]
        for f in features:
            at = 0
            for c in f.removesuffix("$"):
                to = self.after[at].get(c)
                if to is None:
                    to = self.after[at][c] = len(self.after)
                    self.after.append({})
                    self.ends.append(False)
                at = to
            self.ends[at] = True

    def in_reach(self, lattice: list[list[tuple[str, float]]]) -> bool:
        """Whether some path through the lattice holds the letters of a feature from the beginning of a word on."""
        after, ends = self.after, self.ends
        active: set[int] = {0}  # the root stands for a word that may begin here
        for options in lattice:
            if len(options) == 1:
                c = options[0][0]
                if not _is_letter(c):
                    active = {0}
                    continue
                moved = set()
            else:
                moved = set()
                for c, _ in options:
                    if not c:
                        moved |= active
                    elif not _is_letter(c):
                        moved.add(0)
            for c, _ in options:
                if c:
                    for at in active:
                        to = after[at].get(c)
                        if to is not None:
                            if ends[to]:
                                return True
                            moved.add(to)
            active = moved
        return False


class Restorer:
    """Viterbi decoding of obfuscated stretches under a character model.

    With a lexicon's ``beginnings``, a stretch that cannot be restored to any
    of its features is not decoded, as nothing in it would count.
    """

    def __init__(self, log_probs: np.ndarray, beginnings: Beginnings | None = None):
        self.rows = log_probs.tolist()
        self.beginnings = beginnings
        self.known: dict[str, tuple[str, ...]] = {}

    def _decoded(self, stretch: str, spaced: bool, marks: str = LETTERS_ONLY) -> list[str]:
        lattice = self.lattice(stretch, spaced, marks)
        if self.beginnings is not None and not self.beginnings.in_reach(lattice):
            return []
        return _PARTS.findall(self.decode(lattice))

    def decode(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The likeliest string: each position gives one of its options, a character or nothing.

        What comes before the first choice, and what follows the last one once
        all paths share a state, costs every path the same and is not walked.
        In a run of one sign the states' costs, relative to the best, soon
        repeat every few steps; from there on the choices repeat too, and the
        rest of the run is filled in without weighing them.
        """
        rows = self.rows
        open_ = [i for i, options in enumerate(lattice) if len(options) > 1]
        if not open_:
            return "".join([o[0][0] for o in lattice]).strip()
        start, last = "".join([o[0][0] for o in lattice[:open_[0]]]), open_[-1]
        a, b = [OTHER, BREAK, *[BREAK if c == " " else _SYMBOL.get(c, OTHER) for c in start[-2:]]][-2:]
        states: dict[tuple[int, int], tuple[float, tuple]] = {(a, b): (0.0, ((), start))}
        rest, i, steps = "", open_[0] - 1, None
        while i < len(lattice):
            i += 1
            if i > last and len(states) == 1:
                rest = "".join([o[0][0] for o in lattice[i:]])
                break
            if not (0 < i < len(lattice) and lattice[i] is lattice[i - 1]):
                steps = None
            elif steps is None:
                steps = []
            if steps is not None and len(steps) < STEADY_WITHIN:
                states, step = self._run_step(states, lattice[i])
                steps.append(step)
                turn = next((steps[-n:] for n in range(1, min(LONGEST_TURN + 1, len(steps))) if steps[-1 - n] == step), None)
                while turn and i + 1 < len(lattice) and lattice[i + 1] is lattice[i]:
                    i += 1
                    states = {s: (c, (states[p][1], out) if out else states[p][1]) for s, (c, p, out) in turn[0].items()}
                    turn = turn[1:] + turn[:1]
                continue
            options = [(out, BREAK if out == " " else _SYMBOL.get(out, OTHER), p) for out, p in lattice[i]] \
                if i < len(lattice) else [(" ", BREAK, 0.0)]
            after: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (cost, path) in states.items():
                row = rows[a][b]
                for out, c, p in options:
                    if out:
                        state, total, new = (b, c), cost + p + row[c], (path, out)
                    else:
                        state, total, new = (a, b), cost + p, path
                    best = after.get(state)
                    if best is None or total > best[0]:
                        after[state] = (total, new)
            states = after
        path, out = max(states.values(), key=lambda x: x[0])[1], [rest]
        while path:
            path, c = path
            out.append(c)
        return "".join(reversed(out)).strip()

    def _run_step(self, states: dict, options: list[tuple[str, float]]) -> tuple[dict, dict]:
        """One step inside a run of one sign: the new states, costs relative to the best, and each one's cost, origin and output."""
        rows = self.rows
        best: dict[tuple[int, int], tuple[float, tuple[int, int], str]] = {}
        for (a, b), (cost, _) in states.items():
            row = rows[a][b]
            for out, p in options:
                c = BREAK if out == " " else _SYMBOL.get(out, OTHER)
                state, total = ((b, c), cost + p + row[c]) if out else ((a, b), cost + p)
                if state not in best or total > best[state][0]:
                    best[state] = (total, (a, b), out)
        top = max(t for t, _, _ in best.values())
        step = {s: (t - top, origin, out) for s, (t, origin, out) in best.items()}
        after = {s: (t, (states[origin][1], out) if out else states[origin][1]) for s, (t, origin, out) in step.items()}
        return after, step

    @staticmethod
    def lattice(stretch: str, spaced: bool, marks: str = LETTERS_ONLY) -> list[list[tuple[str, float]]]:
        """Options of each character of a stretch; ``spaced`` lets gaps close, ``marks`` says what its look-alike marks may be."""
        out: list[list[tuple[str, float]]] = []
        before, run, gap = "", 0, False
        for c in stretch:
            run = run + 1 if c == before else 1
            before = c
            if spaced and not c.isalnum():
                mark = c in LOOKALIKES
                closing = _GAP_ON if gap else _GAP
                if not mark or marks == GAPS:
                    out.append(closing)
                    gap = True
                    continue
                if marks == EITHER:
                    out.append([(x, SUBSTITUTED) for x in LOOKALIKES[c]] + closing)
                    continue
            gap = False
            if run > 1 and c in _SYMBOL:
                out.append(_AGAIN[c] if run == 2 else [(c, KEPT_REPEAT), ("", DROPPED_REPEAT)])
            else:
                out.append(_OPTIONS.get(c) or [(c, 0.0)])
        return out

    @staticmethod
    def cores(token: str) -> list[str]:
        """A token without punctuation around it, with and without the look-alike marks at either edge."""
        core = _inner(token)
        if core.isalnum():
            return [core]
        front = dict.fromkeys((core, _without_front(core)))
        return [c for c in dict.fromkeys(x for f in front for x in (f, _without_back(f))) if c]

    def words(self, token: str) -> tuple[str, ...]:
        """The letter runs of one blank-free, lower-case token, as it is and, where it may be obfuscated, restored."""
        known = self.known.get(token)
        if known is not None:
            return known
        found = _PARTS.findall(token)
        if _REPEAT.search(token) or not token.isalpha():
            for core in self.cores(token):
                if _REPEAT.search(core) or _LOOKALIKE.search(core):
                    found += self._decoded(core, False)
        out = tuple(dict.fromkeys(found))
        if self.beginnings is None and len(token) <= CACHE_CHARS:
            if len(self.known) >= CACHE_ENTRIES:
                self.known.clear()
            self.known[token] = out
        return out

    def spaced_words(self, text: str) -> list[str]:
        """Words hidden in runs of single or doubled characters with gaps between them."""
        out: list[str] = []
        for m in _SPACED.finditer(text):
            stretch = m[0].strip()
            if _ONLY_MARKS.fullmatch(stretch):
                continue  # a part of one token
            for core in self.cores(stretch):
                for marks in (GAPS, LETTERS_ONLY, EITHER) if _MARK.search(core) else (GAPS,):
                    out += self._decoded(core, True, marks)
        return list(dict.fromkeys(out))

    def restored(self, text: str) -> set[str]:
        """All words of a text, with those that its obfuscated stretches restore to."""
        text = text.lower()
        out: set[str] = set()
        for token in set(text.split()):
            out.update(self.words(token))
        out.update(self.spaced_words(text))
        return out


def features(word: str) -> tuple[str, ...]:
    """What the lexicon may hold of a word: itself, marked, and its beginnings."""
    return (f"{word}$", *(word[:n] for n in range(4, 8) if len(word) >= n)) if len(word) >= 3 else ()


@dataclass
class Model:
    """Character model, lexicon of weights, and the score of a text without evidence, all log-odds."""
    log_probs: np.ndarray
    lexicon: dict[str, float] = field(default_factory=dict)
    base: float = -5.0


class Scorer:
    """Scores texts under a model.

    A feature's letters, each run of one letter as one, open every word that
    shows it, restored or not; so words that begin like no feature are passed
    over at once.
    """

    def __init__(self, model: Model):
        self.model = model
        self.restorer = Restorer(model.log_probs, Beginnings(model.lexicon))
        self.starts = {f.removesuffix("$")[:3] for f in model.lexicon}
        self.single = {_RUN.sub(r"\1", f.removesuffix("$"))[:3] for f in model.lexicon}
        self.hits: dict[str, tuple[str, ...]] = {}

    def _of(self, word: str) -> list[str]:
        lexicon = self.model.lexicon
        return [f for f in features(word) if f in lexicon] if word[:3] in self.starts else []

    def _hits(self, token: str) -> tuple[str, ...]:
        """The lexicon's features in a token and in what it may be restored to."""
        known = self.hits.get(token)
        if known is None:
            known = tuple(f for w in self.restorer.words(token) for f in self._of(w))
            if len(token) <= CACHE_CHARS:
                if len(self.hits) >= CACHE_ENTRIES:
                    self.hits.clear()
                self.hits[token] = known
        return known

    def score(self, text: str | None) -> float:
        """Probability of the label, from the weights of all different pieces of evidence in the restored text."""
        lexicon, low = self.model.lexicon, (text or "").lower()
        starts, single = self.starts, self.single
        evidence: set[str] = set()
        for token in set(low.split()) if lexicon else ():
            core = token if token.isalpha() else token.strip(_AROUND)
            if not core.isalpha():
                evidence.update(self._hits(token))
                continue
            if core[:3] in starts:
                evidence.update(self._of(core))
            if _REPEAT.search(core):
                once = _RUN.sub(r"\1", core)
                if once[:3] in single or once[:2] in single or once[:1] in single:
                    evidence.update(self._hits(core))
        if lexicon:
            for w in self.restorer.spaced_words(low):
                evidence.update(self._of(w))
        odds = self.model.base + sum(sorted(lexicon[f] for f in evidence))
        return float(1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30))))


def _logistic(rows: np.ndarray, cols: np.ndarray, label: np.ndarray, n_cols: int) -> tuple[np.ndarray, float]:
    """Weights, none negative, and intercept of a penalised logistic regression on a sparse 0/1 matrix (Adam)."""
    w, base = np.zeros(n_cols), float(np.log((label.sum() + 1) / (len(label) - label.sum() + 1)))
    theta, m, v = np.r_[w, base], np.zeros(n_cols + 1), np.zeros(n_cols + 1)
    for t in range(1, STEPS + 1):
        odds = theta[-1] + np.bincount(rows, theta[cols], minlength=len(label))
        wrong = 1 / (1 + np.exp(-np.clip(odds, -30, 30))) - label
        g = np.r_[np.bincount(cols, wrong[rows], minlength=n_cols) + PENALTY * theta[:-1], wrong.sum()]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        theta[:-1] = np.maximum(theta[:-1], 0)
    return theta[:-1], float(theta[-1])


def fit(sample: DataFrame, counts: np.ndarray) -> Model:
    """Character model from ``counts``, lexicon from ``sample(text, label)``, which must be of bounded size.

    Feature counts over the sample are added up by Spark.  Features that are
    mostly toxic are candidates, and a logistic regression weighs them
    together, so that words which merely come along with a telling one, as in
    copies of one toxic text, share its weight instead of each having all of it.
    """
    model = Model(char_model(counts))
    shared = sample.sparkSession.sparkContext.broadcast(model.log_probs)

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(shared.value)
        for f in frames:
            yield pd.DataFrame({
                "label": f["label"].to_numpy(),
                "features": [sorted({x for w in restorer.restored(t) for x in features(w)}) for t in f["text"]]})

    seen = stored(sample.mapInPandas(rows, "label int, features array<string>")
                  .withColumn("id", F.monotonically_increasing_id()), "toxic-features")
    total, toxic = seen.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not total or not toxic:
        return model
    prior = toxic / total
    per = seen.select("label", F.explode("features").alias("f")).groupBy("f").agg(
        F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n")).select("f", "toxic", "n")
    telling = stored(per.filter((F.col("toxic") >= LEAST_SUPPORT)
                                & ((F.col("toxic") + PRIOR_ROWS * prior) / (F.col("n") + PRIOR_ROWS) >= LEAST_PRECISION)),
                     "toxic-telling")
    # The sampled rows that hold a candidate, and the candidates they hold: bounded by the sample.
    held = seen.select("id", "label", F.explode("features").alias("f")).join(telling.select("f"), "f") \
        .groupBy("id", "label").agg(F.sort_array(F.collect_list("f")).alias("fs")).toPandas().sort_values("id")
    names = sorted({f for fs in held["fs"] for f in fs})
    at = {f: i for i, f in enumerate(names)}
    cols = np.fromiter((at[f] for fs in held["fs"] for f in fs), np.int64)
    rows_ = np.repeat(np.arange(len(held)), [len(fs) for fs in held["fs"]])
    label = np.zeros(total)  # rows without candidates follow; only their number and labels matter
    label[:len(held)] = held["label"].to_numpy()
    label[len(held):len(held) + int(toxic - held["label"].sum())] = 1
    weights, model.base = _logistic(rows_, cols, label, len(names))
    model.lexicon = {f: float(x) for f, x in zip(names, weights) if x > 1e-3}
    # Toxic texts mostly hold several telling words, which share the weight that one of them deserves on its own.
    for f, t, n in telling.filter(
            (F.col("toxic") >= ALONE_SUPPORT) & (F.col("n") - F.col("toxic") <= ALONE_OTHERS * F.col("toxic"))).collect():
        if model.lexicon.get(f, 0.0) >= ALONE_WEIGHT:
            odds = np.log((t + PRIOR_ROWS * prior) / (n - t + PRIOR_ROWS * (1 - prior)))
            model.lexicon[f] = max(model.lexicon[f], float(odds) - model.base)
    return model


def learn(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
          most_rows: int = MOST_TRAINING_ROWS) -> Model:
    """Model of a corpus: characters from all of ``docs``, lexicon from rows that ``labels`` marks.

    Rows with a null text or label are passed over and equal texts count once
    (toxic if any is).  Beyond ``most_rows`` different texts, those with the
    smallest hashes are taken.  Texts stay where they are: keys and hashes are
    joined, the chosen hashes with the smallest key of each, at most
    ``most_rows`` small rows, go back by broadcast, and of a text's copies only
    those with that key move, one a task.  Without toxic rows the lexicon is empty.
    """
    src = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).filter("text IS NOT NULL")
    marks = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("label")).dropna()
    chosen = src.select("k", F.xxhash64("text").alias("h")).join(marks, "k") \
        .groupBy("h").agg(F.max("label").alias("label"), F.min("k").alias("k")).orderBy("h").limit(most_rows)
    chosen = stored(chosen, "toxic-sample")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = src.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["h", "k"]) \
        .select("h", "label", "text").groupBy("h", "label").agg(F.min("text").alias("text"))
    sample = sample.repartition(n).select("text", "label")
    return fit(sample, char_counts(docs, text))


def score(docs: DataFrame, model: Model, *, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns and ``score`` per row.

    Null and empty texts score the base rate; equal rows score equally; only
    the text is read besides ``keep``; an empty table gives an empty result.
    Any number of characters is scored whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value)
        return lambda texts: [[scorer.score(t) for t in texts]]

    return map_texts(docs, keep, text, {"score": "double"}, make)


def keep_clean(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they are.

    Each row goes by its text alone, repeated ones and null keys included; null
    and empty texts score the base rate; an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for f in frames:
            yield f.filter(pa.array([scorer.score(t) < threshold for t in f.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(batches, docs.schema)
