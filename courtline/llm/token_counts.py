"""Exact token counts of every prefix of a text, by dynamic programming.

The encoding of a prefix ends with exactly one token, and cutting that token
off leaves the encoding of a shorter prefix.  So one pass from left to right
finds, for each prefix, the token that ends it: the one whose pair with the
last token of the shorter prefix would be left alone by the merges.  The count
of a prefix is then one more than the count of the shorter one.  The counts
are stored per text as the step from the prefix before, one signed byte per
character or, in a text that has a step beyond it, four; they answer truncation
and budget questions without encoding anything again.

Texts are cut where a single space stands between two other characters: a
pre-token always starts at such a space.  Steps of the pieces are remembered,
so a piece that comes again costs one lookup.
"""

from __future__ import annotations

import itertools
import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

# Fixed value: the pre-token pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_ENTRIES = 1_200_000
CACHE_CHARS = 64
INNER, UNSURE, WHOLE = 0, 1, 2
# Signs that never belong to a contraction or a special token.
_TAIL = ".,;:!?|&$#%*()-\""
_TWO_BLANKS = re.compile(r"\s\s|^\s|\s$")
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class StepTooWide(Exception):
    """A step does not fit the bytes that hold steps."""


class _Later(dict):
    """Steps of pieces that follow a single space, the space included; a piece that is not there is worked out and kept."""

    def __init__(self, counter: "PrefixCounter"):
        super().__init__()
        self.counter = counter

    def __missing__(self, piece: str) -> bytes:
        body = piece.rstrip(_TAIL)
        if not body.isalpha():
            out = self.counter._span(" " + piece)
        elif len(body) < len(piece):  # letters and signs are pre-tokens of their own
            out = self[body] + self.counter._pre_token(piece[len(body):])
        else:
            out = self.counter._worked_out(" " + piece)
        if len(piece) <= CACHE_CHARS:
            if len(self) > CACHE_ENTRIES:
                self.clear()
            self[piece] = out
        return out


class PrefixCounter:
    """Token counts of all prefixes under one byte-level BPE vocabulary (a tokenizers JSON file's bytes).

    Steps are signed numbers of one byte, or of four with ``wide``; one that does not fit raises StepTooWide.
    """

    def __init__(self, content: bytes, wide: bool = False):
        self.content, self.wide = content, wide
        self.code, self.most = ("i", (1 << 31) - 1) if wide else ("b", 127)
        spec = json.loads(content)
        back = byte_symbols()
        raw = lambda s: bytes(back[c] for c in s)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        # Every start of a token: INNER where it is none itself, WHOLE where its bytes are encoded as it.
        self.kind: dict[bytes, int] = {t[:i]: INNER for t in self.ids for i in range(1, len(t))}
        self.kind |= dict.fromkeys(self.ids, UNSURE)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        # A token's rank is that of the merge that makes it; bytes have rank -1.
        self.rank: dict[tuple[bytes, bytes], int] = {}
        self.parts: dict[bytes, tuple[bytes, bytes]] = {}
        for r, (a, b) in enumerate(pairs):
            a, b = raw(a), raw(b)
            self.rank[a, b] = r
            self.parts.setdefault(a + b, (a, b))
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, self.specials))) if self.specials else None
        # The library's blanks are those of Unicode's White_Space; the regex module's \s has four more.
        self.pattern = regex.compile(PATTERN.replace(r"\S", r"[^\s]").replace(r"\s", r"\p{White_Space}"))
        self.blank = regex.compile(r"\p{White_Space}+").fullmatch
        self.edges: dict[tuple[bytes, int], list[tuple[bytes, float]]] = {}
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.tokens: dict[str, bytes] = {}
        self.later = _Later(self)

    # -- merges ---------------------------------------------------------------

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """What stands at one end of a token while it is merged, each with the rank that takes it up."""
        out = self.edges.get((token, side))
        if out is None:
            out, part, taken = [], token, float("inf")
            while True:
                out.append((part, taken))
                if len(part) == 1:
                    break
                a, b = self.parts[part]
                taken = self.rank[a, b]
                part = (a, b)[side]
            self.edges[token, side] = out
        return out

    def _pair_stays(self, left: bytes, right: bytes) -> bool:
        """Whether the merges of ``left`` + ``right`` end in these two tokens.

        They do unless some merge joins what then stands at the inner ends
        before either end is taken up by its own side; of equal ranks the left
        one goes first.
        """
        known = self.fits.get((left, right))
        if known is None:
            known, rank, rights = True, self.rank.get, self._edge(right, 0)
            for a, ta in self._edge(left, 1):
                for b, tb in rights:
                    r = rank((a, b))
                    if r is not None and r < ta and r <= tb:
                        known = False
            if len(self.fits) > CACHE_ENTRIES:
                self.fits.clear()
            self.fits[left, right] = known
        return known

    def _is_whole(self, token: bytes) -> bool:
        """Whether the bytes of a token are encoded as that token."""
        known = len(token) == 1 or token in self.parts and self._merged(token) == [token]
        self.kind[token] = WHOLE if known else INNER
        return known

    def _merged(self, data: bytes) -> list[bytes]:
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            r, i = min((self.rank.get(p, float("inf")), i) for i, p in enumerate(zip(parts, parts[1:])))
            if r == float("inf"):
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    # -- prefixes ---------------------------------------------------------------

    def _pre_token(self, piece: str) -> bytes:
        """Steps of one pre-token, one number per character, remembered."""
        known = self.tokens.get(piece)
        if known is None:
            known = self._worked_out(piece)
            if len(piece) <= CACHE_CHARS:
                if len(self.tokens) > CACHE_ENTRIES // 8:
                    self.tokens.clear()
                self.tokens[piece] = known
        return known

    def _worked_out(self, piece: str) -> bytes:
        """Steps of one pre-token, by the dynamic program."""
        data = piece.encode("utf-8")
        n, kind, fits, stays = len(data), self.kind.get, self.fits.get, self._pair_stays
        last, count = [b""] * (n + 1), [0] * (n + 1)
        for j in range(n):  # last[j] is known by now: hand it on to all prefixes one token longer
            end, next_count = last[j], count[j] + 1
            for i in range(j + 1, n + 1):
                t = data[j:i]
                k = kind(t)
                if k is None:
                    break
                if k and not last[i]:
                    if k == UNSURE and not self._is_whole(t):
                        continue
                    ok = not j or fits((end, t))
                    if ok is None:
                        ok = stays(end, t)
                    if ok:
                        last[i], count[i] = t, next_count
        if n != len(piece):
            count = [0, *(count[e] for e in itertools.accumulate(len(c.encode("utf-8")) for c in piece))]
        return self._packed([b - a for a, b in zip(count, count[1:])])

    def _packed(self, steps: Iterable[int]) -> bytes:
        try:
            return array(self.code, steps).tobytes()
        except OverflowError:
            raise StepTooWide from None

    def _moved(self, steps: bytes, at: int, by: int) -> bytes:
        """``steps`` with ``by`` added to the one at position ``at``, if there is one."""
        got = array(self.code, steps)
        if at < len(got):
            value = got[at] + by
            if not -self.most <= value <= self.most:
                raise StepTooWide
            got[at] = value
        return got.tobytes()

    def _span(self, text: str) -> bytes:
        """Steps of a text without special tokens, by its pre-tokens."""
        if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
            return self._pre_token(text)
        out = bytearray()
        found = self.pattern.findall(text)
        i = 0
        while i < len(found):
            piece = found[i]
            if self.blank(piece):
                # A prefix that ends inside a run of blanks has the run so far as one pre-token.
                run, j = piece, i + 1
                while j < len(found) and self.blank(found[j]):
                    run += found[j]
                    j += 1
                inner = j < len(found)
                total = sum(self._total(p) for p in found[i:j])
                extra = " " if inner and found[j][0] == " " else ""  # the blank that the next pre-token takes
                steps = self._pre_token(run + extra)
                out += steps
                ahead = total - self._sum(steps)  # back from the run to the pre-tokens as they are
                if extra:
                    following = array(self.code, self._pre_token(found[j]))
                    out += self._moved(following[1:].tobytes(), 0, ahead + following[0])
                    j += 1
                elif inner:
                    out += self._moved(self._cut(found[j]), 0, ahead)
                    j += 1
                i = j
            else:
                out += self._cut(piece)
                i += 1
        return bytes(out)

    def _cut(self, piece: str) -> bytes:
        """Steps of a pre-token whose own prefixes may be several pre-tokens: 'll is ' and l until its last letter."""
        if len(piece) == 3 and piece in ("'re", "'ve", "'ll"):
            return self._packed([1, 1, self._total(piece) - 2])
        return self._pre_token(piece)

    def _sum(self, steps: bytes) -> int:
        return int(np.frombuffer(steps, self.code).sum(dtype=np.int64))

    def _total(self, piece: str) -> int:
        return self._sum(self._pre_token(piece))

    def _plain(self, text: str) -> bytes:
        """Steps of a text without special tokens, by cached pieces."""
        pieces = text.split(" ") if not _TWO_BLANKS.search(text) else _INNER_SPACE.split(text)
        return self._span(pieces[0]) + b"".join(map(self.later.__getitem__, pieces[1:]))

    def steps(self, text: str | None) -> bytes:
        """One number per character of ``text``: the count of the prefix it ends, less that of the prefix before."""
        if not text:
            return b""
        found = list(self.special.finditer(text)) if self.special and any(s in text for s in self.specials) else ()
        out, at = [], 0
        for m in found:
            # Inside the special string a prefix is ordinary text; its last character makes it one token.
            own = self._sum(self._plain(text[at:m.start()]))
            through = self._plain(text[at:m.end()])
            out.append(self._moved(through, m.end() - at - 1, own + 1 - self._sum(through)))
            at = m.end()
        if at < len(text):
            out.append(self._plain(text[at:]))
        return b"".join(out)

    def stored_steps(self, text: str | None) -> bytes:
        """The steps of a text after a byte that says how many bytes each has; nothing for an empty text."""
        if not text:
            return b""
        try:
            return b"\1" + self.steps(text)
        except StepTooWide:
            if not hasattr(self, "wider"):
                self.wider = PrefixCounter(self.content, wide=True)
            return b"\4" + self.wider.steps(text)


def read_steps(stored: bytes) -> np.ndarray:
    """Steps of one text as they were stored."""
    return np.frombuffer(stored, np.int8 if stored[0] == 1 else np.int32, offset=1) if stored else np.zeros(0, np.int8)


_COUNTERS: dict[bytes, PrefixCounter] = {}


def counter(content: bytes) -> PrefixCounter:
    """The counter of a vocabulary file, kept for the life of the Python worker."""
    if content not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[content] = PrefixCounter(content)
    return _COUNTERS[content]


def prefix_counts(docs: DataFrame, vocabulary: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, steps) per row: ``steps`` holds the counts of all prefixes.

    ``vocabulary`` is the path, on the driver, of a byte-level BPE file of the
    tokenizers library; its content goes to the executors as a broadcast of
    that file's size.  A null text counts as empty: no bytes, no tokens, no
    steps.  Keys may be null or repeated: each row gets its own result.  Other
    columns are not read; an empty table gives an empty result.  Nothing is
    shuffled; memory per task is one Arrow batch and bounded caches.
    """
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(shared.value)
        for f in frames:
            texts = f.column(1).to_pylist()
            steps = [count.stored_steps(t) for t in texts]
            totals = [int(read_steps(s).sum(dtype=np.int64)) for s in steps]
            sizes = [len(t.encode("utf-8")) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [f.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), pa.array(steps, pa.binary())],
                names=[key, "n_bytes", "n_tokens", "steps"])

    src = docs.select(F.col(key), F.col(text).alias("_text"))
    return src.mapInArrow(batches, f"`{key}` {src.schema[0].dataType.simpleString()}, n_bytes long, n_tokens long, steps binary")


def counts_of(steps: bytes) -> np.ndarray:
    """Token count of the empty prefix and of each longer one."""
    return np.concatenate([[0], np.cumsum(read_steps(steps), dtype=np.int64)])


@F.pandas_udf(LongType())
def tokens_in_prefix(steps, n_chars):
    """Tokens of the first ``n_chars`` characters, from stored steps."""
    import pandas as pd

    return pd.Series([int(read_steps(s)[:max(0, n)].sum(dtype=np.int64)) for s, n in zip(steps, n_chars)])


@F.pandas_udf(LongType())
def longest_prefix(steps, budget):
    """Characters of the longest prefix of at most ``budget`` tokens, from stored steps."""
    import pandas as pd

    return pd.Series([int(np.flatnonzero(counts_of(s) <= max(0, b))[-1]) for s, b in zip(steps, budget)])
