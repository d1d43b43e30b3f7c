"""Ranked search, WARC transactions and whitening against plain versions."""
import base64
import gzip
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtline.llm import ranked, warc, whitening
from courtline.session import scratch_path
from tests.llm.conftest import AWKWARD

ITEMS = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- ranked search ------------------------------------------------------------

def plain_search(docs, items, k=20):
    """Every score of the contract, sorted; (item row, item, rank, doc, score)."""
    bags = [Counter(TERM.findall((t or "").translate(LOWER))) for _, t in docs]
    n_docs, total = sum(1 for b in bags if b), sum(sum(b.values()) for b in bags)
    df = Counter(t for b in bags for t in b)
    out = []
    for at, (item, text) in enumerate(items):
        found = []
        for (doc, _), b in zip(docs, bags):
            n = sum(b.values())
            m = 75 + (25 * n * n_docs) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 12 * m))
                        for t in TERM.findall((text or "").translate(LOWER)) if b[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(at, item, i + 1, f[3], -f[0]) for i, f in enumerate(sorted(found, key=lambda f: f[:3])[:k])]
    return out


def searched(docs, items, **options):
    got = ranked.search(docs, items, **options).collect()
    return sorted([(r.item_id, r.rank, r.doc_id, r.score) for r in got], key=str)


def expected(docs, items, k=20):
    return sorted([r[1:] for r in plain_search(docs, items, k)], key=str)


def some_documents(seed=3, n=150):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(r.choices(vocabulary, weights=[60 / (j + 1) for j in range(60)], k=r.randrange(0, 60)))) for i in range(n)]
    docs += [(1000 + i, docs[5][1]) for i in range(30)] + [(2000, docs[7][1].upper()), (2001, docs[9][1].replace(" ", ", --"))]
    return docs, vocabulary, r


@pytest.mark.parametrize("shard, terms", [(20_000, 1_000_000), (7, 1_000_000), (20_000, 12)])
def test_search_by_brute_force(spark, docs_of, monkeypatch, shard, terms):
    monkeypatch.setattr(ranked, "SHARD_DOCS", shard)
    docs, vocabulary, r = some_documents()
    items = [(i, " ".join(r.choices(vocabulary, k=r.randrange(1, 12)))) for i in range(12)]
    items += [(50, docs[5][1]), (51, "w0 w0 w0"), (52, "unknown words"), (53, None), (54, ""), (None, "w1 W2"), (51, "w3;w4")]
    got = searched(docs_of(docs), spark.createDataFrame(items, ITEMS).withColumn("q", F.lit(1)).withColumn("rank", F.lit(2)), most_terms=terms)
    assert got == expected(docs, items)


def test_search_of_awkward_rows(spark, docs_of):
    items = [(1, "One word here"), (2, "naïve 日本語 CAFÉ café"), (3, "lorem ipsum ipsum"), (4, "null 🙂 key")]
    got = searched(docs_of(AWKWARD), spark.createDataFrame(items, ITEMS))
    assert got == expected(AWKWARD, items)


def test_search_of_empty_tables(spark, docs_of):
    items = spark.createDataFrame([(1, "a word")], ITEMS)
    for docs, asked in ((docs_of(AWKWARD).limit(0), items), (docs_of(AWKWARD), items.limit(0)), (docs_of([(1, " ")]), items)):
        got = ranked.search(docs, asked)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_search_reads_only_what_it_needs():
    """Lists are read from the top, and reading ends before all of them are read where the best are known."""
    r = np.random.default_rng(2)
    size = 4000
    n = r.integers(20, 400, size)
    docs, terms, tfs = [], [], []
    for term in range(8):
        some = r.choice(size, 1500, replace=False)
        docs.append(some), terms.append(np.full(1500, term)), tfs.append(r.integers(1, 9, 1500))
    star = np.arange(10)  # ten documents that hold everything, often
    for term in range(8):
        docs.append(star), terms.append(np.full(10, term)), tfs.append(np.full(10, 90 + term))
    doc, term, tf = (np.concatenate(x).astype(np.int64) for x in (docs, terms, tfs))
    doc, at = np.unique(np.stack([doc, term]), axis=1, return_index=True)[0], np.unique(np.stack([doc, term]), axis=1, return_index=True)[1]
    doc, term, tf = doc[0], doc[1], tf[at]
    weights = np.full(8, 3000, np.int64)
    shard = ranked.Shard(n, doc, term, tf, weights, size, int(n.sum()))
    asked, times = np.arange(8), np.ones(8, np.int64)
    found, score, read = shard.best(asked, times, 5)
    m = 75 + (25 * n * size) // int(n.sum())
    plain = np.zeros(size, np.int64)
    np.add.at(plain, doc, 3000 * ((10 ** 9 * tf) // (1000 * tf + 12 * m[doc])))
    best = np.sort(plain)[-5:]
    assert sorted(score.tolist())[-5:] == best.tolist() and all(plain[f] == s for f, s in zip(found, score))
    assert read < len(doc)
    assert not len(shard.best(asked, times, 5, bar=int(best[-1]) + 1)[0])


def test_terms_follow_the_pattern():
    r = random.Random(1)
    signs = [chr(c) for c in range(160)] + ["é", "ß", "日", " ", " ", "🙂"]
    for _ in range(300):
        text = "".join(r.choices(signs, k=40))
        assert [t.decode() for t in ranked.terms_of(text.encode())] == TERM.findall(text.translate(LOWER))


# -- WARC ---------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def archive(spark, pages, **options):
    path = scratch_path(spark, "tests", "warc", unique=True)
    warc.write_warc(pages, path, **options)
    return path, warc.read_warc(spark, path)


def plain_pages(rows, least=0):
    first = {}
    for i, (key, _, html) in enumerate(rows):
        body = (html or "").encode()
        rank = (key is None, key or 0)
        if len(body) >= least and (body not in first or rank < first[body][0]):
            first[body] = (rank, key)
    out, done = [], set()
    for key, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        is_first = body not in first or ((key is None, key or 0) == first[body][0] and body not in done)
        if is_first:
            done.add(body)
        out.append((key, len(body), digest, "response" if is_first else "revisit", None if is_first else first[body][1]))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a/5", "<p>same</p>"), (3, "http://a/3", "<p>same</p>"), (9, "http://a/9", "<p>same</p>"), (3, "http://a/3", "<p>same</p>"),
    (1, None, None), (2, "http://a/2", ""), (None, "http://a/n", "<b>null key</b>"), (None, None, "<b>null key</b>"),
    (10, "http://a/10\r\nX: y", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (11, "http://a/11", "\r\n\r\n"), (12, "http://a/12", "Ünï 日本語 🙂\x00\x01"), (13, "http://a/13", "x" * 300_000), (14, "u", "\r\n"),
]


@pytest.mark.parametrize("least, size", [(0, 16 << 20), (5, 1000)])
def test_pages_come_back_from_archives(spark, least, size):
    pages = spark.createDataFrame(ROWS, PAGES)
    for name in ("row", "key", "n", "same", "digest", "payload", "record_id", "type", "first_row"):
        pages = pages.withColumn(name, F.lit("clash"))
    _, records = archive(spark, pages, least_revisit_bytes=least, archive_bytes=size)
    nested = warc.captures(records)
    got = sorted([tuple(r) for r in warc.page_captures(nested).collect()], key=str)
    assert got == plain_pages(ROWS, least)
    texts = Counter(r.response.payload.decode() for r in nested.collect() if r.response.type == "response")
    assert set(texts) == {h or "" for _, _, h in ROWS}
    assert nested.filter("n_request != 1 OR n_response != 1 OR n_metadata != 1").count() == 0
    assert warc.further_records(records).count() == 0


@pytest.mark.parametrize("most", [500_000, 10])
def test_every_row_repeated(spark, monkeypatch, most):
    """A payload held by a third of all rows takes the way of the hot ones, broadcast or shuffled."""
    monkeypatch.setattr(warc, "MOST_BROADCAST_REVISITS", most)
    rows = [(i, f"u{i}", "<p>hot</p>" if i % 3 else f"<p>{i}</p>") for i in range(1500)]
    _, records = archive(spark, spark.createDataFrame(rows, PAGES))
    assert sorted([tuple(r) for r in warc.page_captures(warc.captures(records)).collect()], key=str) == plain_pages(rows)


def test_empty_tables_give_no_captures(spark):
    _, records = archive(spark, spark.createDataFrame([], PAGES))
    assert records.count() == 0 and warc.captures(records).count() == 0
    assert warc.page_captures(warc.captures(records)).columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def record(kind, name, block=b"", *lines):
    head = [b"WARC/1.0", b"warc-type: " + kind, *([b"WARC-Record-ID: " + name] if name else []), *lines, b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_transactions_over_archives_and_chains(spark, tmp_path):
    """Ties of either side, over steps, in other archives, gzipped; further and lone records; ids that nobody has."""
    def tie(x):
        return b"WARC-Concurrent-To: " + x

    http = b"Content-Type: application/http; msgtype=response"
    one = record(b"warcinfo", b"<w>", b"software: x\r\n") + record(b"response", b"<r1>", b"HTTP/1.1 200 OK\r\n\r\nbody", http) \
        + record(b"request", b"<q1>", b"GET /", tie(b"<r1>")) + record(b"response", b"<r2>", b"HTTP/1.1 200 OK\r\nno end", http, tie(b"<q2>"))
    two = record(b"request", b"<q2>", b"GET /2") + record(b"metadata", b"<m1>", b"a: b", tie(b"<q1>")) \
        + record(b"metadata", b"<m1>", b"a: b", tie(b"<q1>")) + record(b"metadata", b"<m0>", b"c: d", b"WARC-Concurrent-To: <r1>", tie(b"<q1>"))
    three = record(b"request", b"<q3>", b"GET /3", tie(b"<gone>")) + record(b"metadata", b"<m3>", b"e: f", tie(b"<gone>")) \
        + record(b"resource", b"<s>", b"plain") + record(b"metadata", None, b"g: h", b"X-Long: a", b" folded")
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.warc").write_bytes(one)
    (tmp_path / "two.warc.gz").write_bytes(gzip.compress(two))
    (tmp_path / "three.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in (three[:len(three) // 2], three[len(three) // 2:])))
    records = warc.read_warc(spark, f"file:{tmp_path}")
    got = {}
    for r in warc.captures(records).collect():
        name = [p and p.record_id for p in (r.request, r.response, r.metadata)]
        got[tuple(n if not n or not n.startswith("row:") else "row" for n in name)] = (r.n_request, r.n_response, r.n_metadata)
    assert got == {("<q1>", "<r1>", "<m0>"): (1, 1, 2), ("<q2>", "<r2>", None): (1, 1, 0), ("<q3>", None, "<m3>"): (1, 0, 1),
                   (None, "<s>", None): (0, 1, 0), (None, None, "row"): (0, 0, 1)}
    further = warc.further_records(records).collect()
    assert [(r.record_id, r.payload) for r in further] == [("<m1>", b"a: b")]
    bodies = {r.record_id: (r.http_header, bytes(r.payload)) for r in records.filter("type = 'response'").collect()}
    assert bodies == {"<r1>": ("HTTP/1.1 200 OK\r\n\r\n", b"body"), "<r2>": ("HTTP/1.1 200 OK\r\nno end", b"")}


@pytest.mark.parametrize("data", [b"no archive", record(b"response", b"<r>", b"body")[:-8], b"WARC/1.1\r\nWARC-Type: x\r\n\r\n",
                                  gzip.compress(record(b"response", b"<r>"))[:-4]])
def test_broken_archives_are_errors(data):
    with pytest.raises(ValueError):
        list(warc.records_of(data))


# -- whitening ----------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_whitening(rows, k=16):
    sound = [(key, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for key, v in rows
             if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in sound}), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    c = fit - sums / n
    e, u = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(-e)[:k]
    dev = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums)) for _, x in sound]
    return sound, n, dev, e[order], u[:, order], np.array([(np.array(x) - sums / n) @ u[:, order] / np.sqrt(e[order]) for _, x in sound]), e.sum()


def test_whitening_by_brute_force(spark):
    r = np.random.default_rng(5)
    rows = [(i, (r.normal(size=24) * np.geomspace(3, 0.05, 24)).tolist()) for i in range(400)]
    rows += [(500 + i, rows[7][1]) for i in range(200)] + [(900, rows[8][1]), (900, rows[8][1]), (None, rows[9][1])]
    odd = [(700, None), (701, [float("nan")] + [1.0] * 23), (702, [1.0] * 23 + [None]), (703, [float("-inf")] + [0.0] * 23), (704, [])]
    df = spark.createDataFrame([(k, v, 0) for k, v in rows + odd], VECTORS)
    for name in ("x", "key", "n", "i", "v", "component"):
        df = df.withColumn(name, F.lit("clash"))
    got = whitening.whiten(df).collect()
    sound, n, dev, e, u, white, trace = plain_whitening(rows)
    assert len(got) == len(sound) * 16
    table = Counter((r.vec_id, r.component) for r in got)
    assert table == Counter((k, c) for k, _ in sound for c in range(1, 17))
    by = {(r.vec_id, r.component): r for r in got}
    sign = {c: np.sign(by[0, c].whitened * white[0, c - 1]) for c in range(1, 17)}
    for i, (key, _) in enumerate(sound):
        for c in range(1, 17):
            r_ = by[key, c]
            assert r_.n == n and r_.deviation == dev[i]
            assert abs(r_.whitened * sign[c] - white[i, c - 1]) < 1e-9
            assert abs(r_.explained - e[c - 1] / trace) < 1e-12 and r_.identity_error < 1e-9


def test_whitening_of_degenerate_tables(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame([(k, v, 0) for k, v in rows], VECTORS))

    assert run([]).count() == 0 and run([]).columns[:3] == ["vec_id", "component", "n"]
    assert run([(1, [1.0, 2.0])] * 3).count() == 0  # one distinct vector has no variance
    assert run([(1, None), (2, []), (3, [None])]).count() == 0
    flat = run([(1, [0.0, 1.0, 5.0]), (2, [1.0, 1.0, 5.0]), (3, [2.0, 1.0, 5.0])]).collect()
    assert [(r.component, r.n) for r in flat] == [(1, 3)] * 3 and {round(r.explained, 12) for r in flat} == {1.0}
    two = run([(i, [float(i), float(i * i % 7)]) for i in range(20)] + [(100 + i, [float(i)]) for i in range(4)]).collect()
    assert {(r.vec_id >= 100, r.component, r.n) for r in two} == {(False, 1, 20), (False, 2, 20), (True, 1, 4)}
    far = run([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])]).collect()
    assert len(far) == 3 and all(r.deviation is None for r in far if r.vec_id < 3)  # beyond 63 bits
    assert all(r.component == 1 for r in far)  # the other variance is rounding beside it


@pytest.mark.parametrize("values", [[1] * 30 + [0.5] * 10, [5] * 3 + [4] * 20 + [1e-3] * 5, [1, 1, 1], [7], [1e10, 1, 1e-9, 0],
                                    list(np.geomspace(1, 1e-11, 40))])
def test_contours_find_all_eigenpairs(values):
    r = np.random.default_rng(3)
    q, _ = np.linalg.qr(r.normal(size=(len(values), len(values))))
    a = q @ np.diag(np.array(values, float)) @ q.T
    a = (a + a.T) / 2
    e, u = whitening.top_eigenpairs(a, 16)
    true = np.linalg.eigvalsh(a)[::-1]
    expected = [x for x in true[:16] if x > 1.1e-12 * true[0]]
    assert len(e) == len(expected) and np.allclose(e, expected, rtol=1e-9, atol=1e-14 * true[0])
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12 and np.abs(a @ u - u * e).max() < 1e-12 * true[0]


def test_inertia_counts_eigenvalues():
    r = np.random.default_rng(4)
    for d in (1, 2, 3, 20):
        a = r.normal(size=(d, d))
        a = a + a.T
        e = np.linalg.eigvalsh(a)
        diagonal, off = whitening.tridiagonal(a)
        for shift in r.normal(size=20) * 3:
            assert whitening.inertia(diagonal, off, shift) == (e > shift).sum()
