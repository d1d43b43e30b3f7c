"""Token files, token counts, language and fingerprints against plain versions."""
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from courtline.llm import langid, simhash, token_binary, token_counts
from courtline.session import scratch_path
from tests.llm.conftest import AWKWARD, DOCS

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PIECES = ["a", "b", " ", "  ", "\n", "\t", "'ll", "'re", "'s", "'", "!", "<|endoftext|>", "<|endo", "é", "é", "日本", "12",
          "Hello", " world", " ", "\x1c", "́", "Σ", "İ", "The", "ing", ".", "\x85", "\xa0", "aaaa", "----"]


def mixture(seed, n=14):
    r = random.Random(seed)
    return "".join(r.choice(PIECES) for _ in range(r.randint(0, n)))


def test_prefix_counts_match_the_library_at_every_prefix():
    path = P.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    mine = token_counts.PrefixCounter(open(path, "rb").read())
    for seed in range(400):
        t = mixture(seed)
        want = [len(library.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        assert token_counts.counts_of(mine.stored_steps(t)).tolist() == want, t


BLANKS = [" ", "\t", "\n", "\r\n", " \t", "\n\n ", "\u2003", "\xa0", "\t\t ", "\x0b", "\u3000 "]


def test_long_blank_runs_count_as_in_the_library():
    path = P.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    mine = token_counts.PrefixCounter(open(path, "rb").read())
    wide = token_counts.PrefixCounter(open(path, "rb").read(), wide=True)

    def count(t):
        return len(library.encode(t, add_special_tokens=False).ids)

    for blank in BLANKS:
        for n in (1, 2, 60, 127, 128, 129, 300, 5000):
            run = (blank * n)[:n] if n < 5000 else blank * n
            for text in (run, f"a{run}b", f"a{run} b", f"{run} word", f"word{run}", f"x{run} 'll{run}!", f"1{run}<|endoftext|>{run} 2"):
                assert token_counts.counts_of(mine.stored_steps(text))[-1] == count(text), (blank, n, text[:3], text[-3:])
            if n <= 129:
                text = f"a{run} b{run}'re"
                want = [count(text[:i]) for i in range(len(text) + 1)]
                assert token_counts.counts_of(mine.stored_steps(text)).tolist() == want
                assert np.concatenate([[0], np.cumsum(np.frombuffer(wide.steps(text), np.int32))]).tolist() == want


def test_steps_beyond_a_byte_are_stored_wider(monkeypatch):
    mine = token_counts.PrefixCounter(open(P.path("byte_bpe_50k.json"), "rb").read())
    text = "one  two\t\t\tthree <|endoftext|> four"
    plain = token_counts.counts_of(mine.stored_steps(text)).tolist()

    def too_wide(text):
        raise token_counts.StepTooWide

    monkeypatch.setattr(mine, "steps", too_wide)
    stored = mine.stored_steps(text)
    assert stored[0] == 4 and token_counts.counts_of(stored).tolist() == plain
    with pytest.raises(token_counts.StepTooWide):
        mine._packed([1, 200])
    with pytest.raises(token_counts.StepTooWide):
        mine._moved(b"\x01", 0, 127)


def test_prefix_counts_rows_and_budgets(spark, docs_of):
    path = P.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    got = token_counts.prefix_counts(docs_of(AWKWARD), path)
    rows = got.collect()
    texts = [t or "" for _, t in AWKWARD]
    assert sorted(r.n_tokens for r in rows) == sorted(len(library.encode(t, add_special_tokens=False).ids) for t in texts)
    assert sorted(r.n_bytes for r in rows) == sorted(len(t.encode()) for t in texts)
    answers = got.select("steps", token_counts.tokens_in_prefix("steps", F.lit(6)).alias("six"),
                         token_counts.longest_prefix("steps", F.lit(3)).alias("three")).collect()
    for r in answers:
        counts = token_counts.counts_of(r.steps)
        assert r.six == counts[min(6, len(counts) - 1)] and counts[r.three] <= 3 and (counts[r.three + 1:] > 3).all()
    assert token_counts.prefix_counts(spark.createDataFrame([], DOCS), path).count() == 0


def test_pieces_encode_as_whole_texts():
    path = P.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    mine = token_binary.Encoder(open(path, "rb").read())
    for seed in range(1500):
        t = mixture(seed)
        assert mine.encode([t], None)[0] == np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_token_files_round_trip(spark, docs_of):
    path, vocabulary = scratch_path(spark, "tests", unique=True), P.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(vocabulary)
    token_binary.write_tokens(docs_of(AWKWARD), path, vocabulary, end_id=1)
    got = sorted(token_binary.with_crc32(token_binary.read_tokens(spark, path)).collect(), key=lambda r: r.start)
    want = sorted(AWKWARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, (key, text) in zip(got, want, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        assert (r.key, r.start, r.n_tokens, r.ids_crc32) == (key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    meta = token_binary.read_metadata(spark, path)
    assert sorted(r.start for r in meta.collect()) == [r.start for r in got]
    assert "tokens:array" not in meta._jdf.queryExecution().toString()
    empty = scratch_path(spark, "tests", unique=True)
    token_binary.write_tokens(spark.createDataFrame([], DOCS), empty, vocabulary)
    assert token_binary.read_tokens(spark, empty).count() == 0


def test_token_files_are_laid_out_for_selective_reads(spark, docs_of):
    import glob

    import pyarrow.parquet as pq

    from courtline.session import local_path
    path = scratch_path(spark, "tests", unique=True)
    token_binary.write_tokens(docs_of(AWKWARD), path, P.path("word_bpe_49k.json"))
    columns = [pq.ParquetFile(f).metadata.row_group(0).column(c) for f in glob.glob(local_path(path) + "/*.parquet") for c in range(5)]
    for c in columns:
        assert c.has_offset_index and c.has_column_index
        if c.path_in_schema.startswith("tokens"):
            assert "RLE_DICTIONARY" in c.encodings
        elif c.path_in_schema in ("part_start", "n_tokens"):
            assert "DELTA_BINARY_PACKED" in c.encodings


def plain_fingerprint(text, k=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_fingerprints_match_the_definition():
    for t in [None, "", " ", "a", "A b C", "a b c d", "x " * 3000, "One two THREE four five six é É", *map(mixture, range(200))]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_fingerprint_is_spark_xxhash64(spark):
    assert spark.sql("SELECT xxhash64('a b c d')").first()[0] % 2 ** 64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def plain_groups(prints, radius):
    """Smallest index reachable over links, by brute force."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if bin(a ^ b).count("1") <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def test_links_meet_every_pair_within_the_radius(spark, monkeypatch):
    r = random.Random(3)
    seeds = [r.getrandbits(64) for _ in range(12)]
    prints = seeds + [s ^ sum(1 << b for b in r.sample(range(64), n)) for s in seeds for n in (1, 2, 3, 4, 4, 4, 5, 5, 6)]
    for block in (2048, 3):  # with buckets cut into blocks and without
        monkeypatch.setattr(simhash, "BLOCK", block)
        signed = [(p - 2 ** 64 if p >= 2 ** 63 else p,) for p in prints]
        links = simhash.fingerprint_links(spark.createDataFrame(signed, "fp long").distinct(), 4)
        got = {(row.a % 2 ** 64, row.b % 2 ** 64) for row in links.collect()}
        assert all(bin(a ^ b).count("1") <= 4 for a, b in got)
        order = sorted(set(prints))
        want = plain_groups(order, 4)
        label = list(range(len(order)))
        for _ in order:
            for a, b in got:
                i, j = order.index(a), order.index(b)
                label[i] = label[j] = min(label[i], label[j])
        assert label == want


def test_simhash_groups(spark, docs_of):
    base = " ".join(f"w{i}" for i in range(300))
    near = base.replace("w150 ", "changed ")
    rows = [(10, base), (3, near), (7, base), (8, "something else entirely is here now"), (9, None), (2, ""), (11, " "), (None, base)]
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.simhash_groups(docs_of(rows)).collect()}
    assert len(got) == len(rows)
    prints = [plain_fingerprint(t) for _, t in rows]
    for i, (key, _) in enumerate(rows):
        same = [rows[j][0] for j in range(len(rows)) if plain_groups(prints, 4)[j] == plain_groups(prints, 4)[i]]
        assert got[key, f"{prints[i]:016x}"] == min(k for k in same if k is not None)
    assert simhash.simhash_groups(spark.createDataFrame([], DOCS)).count() == 0


def test_representatives_keep_one_row_of_each_group(docs_of):
    docs = docs_of(AWKWARD + [(5, None), (0, "One word")])
    got = simhash.representatives(docs)
    assert got.columns == docs.columns
    prints = [plain_fingerprint(t) for _, t in AWKWARD]
    assert got.count() == len(set(plain_groups(sorted(set(prints)), 4)))
    kept = {r.doc_id: r.text for r in got.collect()}
    assert kept[0] == "One word" and 4 not in kept and 1 in kept and 2 not in kept


def test_language_by_held_out_rows(spark, docs_of):
    words = {"aa": "the and with this from that which", "bb": "der die und nicht mit auf eine", "cc": "que los para una con por esto"}
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(w.split()) for _ in range(12)), lang, "s") for i, (lang, w) in enumerate(list(words.items()) * 40)]
    docs = docs_of(rows + [(900, None, "aa", "s"), (901, "123 .. 5", "bb", "s"), (902, "", None, "s"), (903, "nicht mit", None, None)])
    out = langid.held_out(F.col("doc_id"), 4, 2)
    model = langid.train(docs.filter(~out))
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert model.languages == ["aa", "bb", "cc"]
    held = [(i, lang) for i, _, lang, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].lang_pred == lang for i, lang in held) >= 0.95 * len(held) > 20
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "bb"]
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = langid.train(spark.createDataFrame([], DOCS))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}


def plain_bayes(rows, text):
    """Naive Bayes over the same n-grams, written out per language; None for und."""
    import math
    from collections import Counter
    if not text or not any(c.isalpha() for c in text):
        return None
    size, seen = 1 << langid.BUCKET_BITS, {}
    for t, language in rows:
        if t is not None and language is not None:
            seen.setdefault(language, []).append(t)
    mine = Counter(int(b) for g in langid.grams(text) for b in g)
    odds = {}
    for language, texts in seen.items():
        c = Counter(int(b) for t in texts for g in langid.grams(t) for b in g)
        total = sum(c.values()) + langid.SMOOTHING * size
        odds[language] = math.log(len(texts) / sum(map(len, seen.values()))) + sum(
            n * math.log((c[b] + langid.SMOOTHING) / total) for b, n in mine.items())
    best = max(sorted(odds), key=odds.get)
    return best, 1 / sum(math.exp(o - odds[best]) for o in odds.values())


@pytest.mark.parametrize("block", [512, 3])
def test_languages_by_plain_bayes(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    r = random.Random(2)
    names = [f"l{i}" for i in range(8)]
    alphabet = {x: "".join(r.sample("abcdefghijklmnoprstuvwz", 9)) for x in names}
    rows = [(i, " ".join("".join(r.choices(alphabet[x], k=4)) for _ in range(r.randrange(2, 9))), x) for i, x in enumerate(names * 6)]
    rows += [(100, None, "l1"), (101, "no language", None), (102, "", "l2"), (None, "null key", "l3"), (103, "123 ²½①", "l4")]
    docs = docs_of(rows)
    model = langid.train(docs)
    got = {x.doc_id: (x.lang_pred, x.score) for x in langid.identify(docs, model).collect()}
    assert len(model.blocks) == -(-8 // block)
    for key, text, _ in rows:
        want = plain_bayes([(t, x) for _, t, x in rows], text)
        assert got[key][0] == (want[0] if want else "und") == model.predict(text)[0]
        assert got[key][1] == pytest.approx(want[1] if want else 0.0, rel=1e-3)


def test_any_number_of_languages(spark, docs_of):
    docs = docs_of([(i, f"word{i} wörter{i % 7} text", f"x{i % 2000}") for i in range(4000)])
    model = langid.train(docs)
    assert sum(len(b.languages) for b in model.blocks) == 2000 and len(model.blocks) == 4
    got = langid.identify(docs.limit(50), model).collect()
    assert len(got) == 50 and all(r.lang_pred.startswith("x") and 0 < r.score <= 1 for r in got)
    assert langid.identify(docs.limit(0), model).count() == 0
    odd = docs_of([(1, "² ½ ① 42"), (2, "½a"), (3, "日"), (4, None), (None, "_")])
    assert {r.doc_id: r.lang_pred == "und" for r in langid.identify(odd, model).collect()} == {1: True, 2: False, 3: False, 4: True, None: True}
