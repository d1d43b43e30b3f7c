"""Vectors, benchmark windows, mixing, sharding, toxicity, secrets and the pipeline against plain versions."""
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtline.llm import components, cover_tree, decontaminate, langid, mixing, secrets, sharding, toxicity
from tests.llm.conftest import AWKWARD, DOCS

VECTORS = "vec_id long, embedding array<float>, label int"


def test_components_by_brute_force(spark):
    r = random.Random(1)
    links = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    got = {x.node: x.root for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {n: n for pair in links for n in pair}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: label[n] for n in linked}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_neardup(rows, cosine=0.9):
    sound = {i: np.array(v, float) for i, (_, v) in enumerate(rows)
             if v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)}
    link = {i: [j for j in sound if j != i and len(sound[i]) == len(sound[j]) and
                sound[i] @ sound[j] / np.linalg.norm(sound[i]) / np.linalg.norm(sound[j]) >= cosine] for i in sound}
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in link.get(todo.pop(), []) if j not in seen]
            seen.update(new)
            todo += new
        keys = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(keys) if keys else None
        out.append((key, len(link.get(i, [])), least, key is not None and key == least))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [4096, 16])
def test_vectors_by_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(cover_tree, "CHUNK", chunk)
    r = np.random.default_rng(7)
    centres = r.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + r.normal(size=8) * (0.05 + 0.1 * (i % 4))).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200, rows[0][1]), (200, rows[0][1]), (None, rows[0][1]), (201, None), (202, []), (203, [0.0] * 8), (None, None),
             (204, [float("nan")] + [1.0] * 7), (205, [float("inf")] + [1.0] * 7), (206, [None] + [1.0] * 7), (207, rows[0][1][:7]),
             (208, (np.array(rows[3][1]) * 1e-30).tolist()), (209, (np.array(rows[5][1]) * 1e30).tolist())]
    rows = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for k, v in rows]
    df = spark.createDataFrame([(k, v, 0) for k, v in rows], VECTORS).withColumn("v", F.lit("clash")).withColumn("id", F.lit(1))
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in cover_tree.neardup(df).collect()]
    assert sorted(got, key=str) == plain_neardup(rows)


def test_no_vectors(spark):
    assert cover_tree.neardup(spark.createDataFrame([], VECTORS)).count() == 0
    assert cover_tree.neardup(spark.createDataFrame([(1, None, 0)], VECTORS)).collect()[0][:4] == (1, 0, 1, True)


def test_cover_tree_levels_cover():
    x = cover_tree.unit(np.random.default_rng(2).normal(size=(300, 5)))
    t = cover_tree.Tree(x)
    for n in range(len(t.centre)):
        d = np.sqrt(np.maximum(0, 2 - 2 * x[t.points[n]] @ x[t.centre[n]]))
        assert d.max() <= t.radius[n] + cover_tree.SLACK
        if len(t.children[n]):
            assert sorted(p for c in t.children[n] for p in t.points[c]) == sorted(t.points[n])
            assert max(t.radius[c] for c in t.children[n]) < t.radius[n] and t.centre[n] in [t.centre[c] for c in t.children[n]]


def words_of(text):
    return [w for w in (text or "").lower().replace("\n", " ").replace("\t", " ").split(" ") if w.strip()]


def plain_matches(docs, items, least=0.8):
    from collections import Counter
    out = {}
    for key, text in docs:
        w = words_of(text)
        for item, body in items:
            b = words_of(body)
            if not b:
                continue
            k = min(5, len(b))
            whole = Counter(" ".join(b[i:i + k]) for i in range(len(b) - k + 1))
            for start in range(max(1, len(w) - len(b) + 1)):
                here = w[start:start + len(b)]
                mine = Counter(" ".join(here[i:i + k]) for i in range(len(here) - k + 1))
                both = sum((mine & whole).values())
                s = both / max(1, sum((mine | whole).values()))
                if s >= least and s > out.get((key, item), (0, 0))[0]:
                    out[key, item] = (s, start)
    return {(k, i, s) for (k, i), (s, _) in out.items()}


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_benchmark_windows_by_brute_force(spark, docs_of, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST_ANCHORS", most)
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([50, 30, 60, 12, 3, 1])]
    items += [(6, items[0][1]), (7, None), (8, "  "), (None, "a null item with enough words in it")]
    edit = lambda t, at: " ".join("XX" if j == at else w for j, w in enumerate(t.split()))
    fill = lambda n: " ".join(word() for _ in range(n))
    docs = [(1, f"{fill(40)} {items[0][1]}\n{fill(9)}"), (2, f"{fill(10)} {edit(items[2][1], 30)} {fill(90)}"), (3, items[1][1][:-4]),
            (4, f"{fill(20)} {items[4][1].upper()} {fill(5)}"), (5, fill(300)), (6, edit(edit(items[0][1], 10), 30)), (7, None), (8, ""),
            (9, f"{items[1][1]} {items[3][1]}"), (None, items[3][1]), (9, f"{items[1][1]} {items[3][1]}"),
            (10, "x a null item with enough words in it"), (11, f"{items[1][1]} inserted".replace(" ", " more ", 1))]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit("clash")).withColumn("size", F.lit(9))
    got = decontaminate.matches(docs_of(docs), table).collect()
    assert {(x.doc_id, x["item"], x.similarity) for x in got} == plain_matches(docs, items)
    clean = decontaminate.decontaminated(docs_of(docs), table)
    assert sorted(x.doc_id for x in clean.collect()) == sorted(k for k, _ in docs if k not in {p for p, _, _ in plain_matches(docs, items)})
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.matches(docs_of(docs), none).count() == 0
    assert decontaminate.matches(spark.createDataFrame([], DOCS), table).count() == 0


def test_benchmark_search_runs_no_python(spark, docs_of):
    plan = decontaminate.matches(docs_of(AWKWARD), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string"))
    assert "Python" not in plan._jdf.queryExecution().toString() and "Arrow" not in plan._jdf.queryExecution().toString()


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Water filling, round by round, as the contract words it."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        left, free = total - sum(full.values()), [s for s in names if s not in full]
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return full | share
        full |= {s: most * sizes[s] for s in over}


def test_mixture(spark, docs_of):
    r = random.Random(8)
    rows = [(i, " ".join("w" for _ in range(r.randrange(1, 400))), "en", f"s{i % 7}") for i in range(300)]
    rows += [(900, "tiny", "en", "z"), (901, None, None, None), (902, "a b", "en", None), (902, "a b", "en", None), (903, "", "en", "s1"),
             (None, "no key here", "en", "s2"), (904, None, "en", "empty source")]
    mixed, pieces = mixing.mix(docs_of(rows))
    got = mixed.collect()
    assert len(got) == len(rows)
    size = {}
    for _, t, _, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    want, by = plain_targets(size), {}
    for (s, z) in size.items():
        mine = [x for x in got if x.source_size == z and abs(x.target - want[s]) < 1e-6 * max(1, want[s])]
        assert mine, s
        by[s] = sum(x.taken for x in mine) if list(size.values()).count(z) == 1 else None
    for s, t in by.items():
        assert t is None or abs(t - want[s]) <= max(2 * mixing.BLOCK_WORDS, 1), (s, t, want[s])
    assert all(0 <= x.taken <= 3 * x["size"] for x in got)
    again = mixing.mix(docs_of(rows[::-1]).repartition(5))[0].collect()
    key = lambda x: (str(x.doc_id), x["size"], x.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    slots = [x.slot for x in pieces.select("slot").distinct().collect()]
    assert len(slots) <= 1.05 * sum(size.values()) / mixing.BLOCK_WORDS + 70
    empty, none = mixing.mix(spark.createDataFrame([], DOCS))
    assert empty.count() == 0 and none.count() == 0
    wordless, _ = mixing.mix(docs_of([(1, None), (2, " ")]))
    assert [x.taken for x in wordless.collect()] == [0, 0]


def test_mixture_takes_every_word_it_owes(spark, docs_of):
    r = random.Random(12)
    rows = [(i, " ".join("w" for _ in range(500)), "en", "hot") for i in range(200)]
    rows += [(1000 + i, " ".join("w" for _ in range(r.randrange(1, 50))), "en", f"s{i % 400}") for i in range(800)]
    mixed, pieces = mixing.mix(docs_of(rows).withColumn("of", F.col("source")))
    source = {i: s for i, _, _, s in rows}
    size, taken, target = {}, {}, {}
    for x in mixed.collect():
        s = source[x.doc_id]
        size[s] = size.get(s, 0) + x["size"]
        taken[s], target[s] = taken.get(s, 0) + x.taken, x.target
    assert sum(z < 100 for z in size.values()) > 300
    assert {s: t - int(np.floor(target[s] + 0.5)) for s, t in taken.items()} == dict.fromkeys(size, 0)
    got = pieces.collect()
    assert len({(x.source_no, x["rank"]) for x in got}) == len({x.slot for x in got})


def test_schedule_is_spread_evenly(spark):
    sources = spark.createDataFrame([("a", 0, 50.0), ("b", 1, 30.0), ("c", 2, 20.0)], "source string, source_no int, target double")
    rows = sorted(mixing.slots(spark, sources, 2000).collect(), key=lambda x: x.slot)
    seen = [0, 0, 0]
    for i, x in enumerate(rows):
        assert x.slot == i and x["rank"] == seen[x.source_no]
        seen[x.source_no] += 1
        assert all(abs(n - (i + 1) * p) < 4 for n, p in zip(seen, (0.5, 0.3, 0.2)))


def test_shards(spark, docs_of):
    rows = AWKWARD + [(100 + i, f"text {i % 50}") for i in range(3000)]
    got = sharding.shard_documents(docs_of(rows), sharding.tree(16)).collect()
    assert len(got) == len(rows) and {x.law for x in got} == {"key"}
    slots = {}
    for x in got:
        slots.setdefault(x.shard, []).append(x.slot)
    assert sorted(slots) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(120 < len(s) < 270 for s in slots.values())
    want = sorted((str(k), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows)
    assert sorted((str(x.doc_id), x["size"], x.text_crc32) for x in got) == want
    moved = [x for x in got if x.grown_shard != x.shard]
    assert {x.grown_shard for x in moved} == {16} and 100 < len(moved) < 280
    shard = {}
    assert all(shard.setdefault(x.doc_id, x.shard) == x.shard for x in got)
    assert sharding.shard_documents(spark.createDataFrame([], DOCS), sharding.tree(16)).count() == 0


def test_moves_stay_in_subtrees_whose_weight_changes(spark):
    ids = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    old = sharding.tree(16)
    heavier = sharding.Node("root", children=(old.children[0], sharding.Node("r1", children=(
        old.children[1].children[0], sharding.Node("r1/k1", children=tuple(
            sharding.Node(c.name, 3.0 if c.shard == 15 else 1.0, shard=c.shard) for c in old.children[1].children[1].children))))))
    for x in ids.select(sharding.shard_of(F.col("k"), old).alias("a"), sharding.shard_of(F.col("k"), heavier).alias("b")).collect():
        into = range(8, 16) if x.a < 8 else range(12, 16) if x.a < 12 else (15,)
        assert x.a == x.b or x.b in into
    with pytest.raises(ValueError):
        sharding.shard_of(F.lit("x"), sharding.Node("root", children=(sharding.Node("s", 0.0, shard=0),)))


def toxic_corpus():
    r = random.Random(9)
    good = ["the", "quiet", "river", "runs", "past", "green", "fields", "towards", "small", "towns", "every", "morning", "people", "walk",
            "idle", "stride", "scarce", "mortar", "losing", "trace"]
    bad = ["idiot", "moron", "scumbag", "loser"]
    rows, labels = [], []
    for i in range(400):
        text = [r.choice(good) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            text[r.randrange(40)] = r.choice(bad)
            text[r.randrange(40)] = r.choice(bad)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_restores_and_scores(spark, docs_of):
    rows, labels = toxic_corpus()
    table = spark.createDataFrame(labels + [(1000, 1, None), (None, 1, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs_of(rows + AWKWARD), table.filter(~langid.held_out(F.col("doc_id"), 5, 0)))
    scorer = toxicity.Scorer(model)
    plain = "the quiet river runs past every small town"
    hidden = ["1d10t", "i d i o t", "i.d.i.o.t", "idiooooot", "m0r0n", "l0$er", "SCUMBAG!!!", "l-o-s-e-r", "m.0.r.0.n", "idi0t,"]
    for h in hidden:
        assert scorer.score(f"{plain} {h} towards fields") >= 0.5, h
    for clean in [plain, "", None, "a a a a a", "42 $$$ ### 1999", "green!!! fields??? t0wards", "x" * 5000, AWKWARD[7][1]]:
        assert scorer.score(clean) < 0.5, clean
    got = {x.doc_id: x.score for x in toxicity.score(docs_of(rows), model).collect()}
    held = [(i, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i] >= 0.5) == bool(t) for i, t in held) >= 0.97 * len(held) > 50
    kept = toxicity.keep_clean(docs_of(rows + AWKWARD), model)
    assert kept.columns == docs_of(rows).columns and kept.count() == 300 + len(AWKWARD)
    assert toxicity.score(docs_of(AWKWARD), model).count() == len(AWKWARD)


def test_toxicity_without_labels(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs_of(AWKWARD), none)
    assert model.lexicon == {} and toxicity.keep_clean(docs_of(AWKWARD), model).count() == len(AWKWARD)
    empty = toxicity.learn(spark.createDataFrame([], DOCS), none)
    assert toxicity.score(spark.createDataFrame([], DOCS), empty).count() == 0


def test_every_obfuscation_of_the_lattice_reaches_it():
    texts = [t for _, t in toxic_corpus()[0]] + ["what a stupid clown with trash and an ass", "stupid clown", "trash ass"] * 40
    restorer = toxicity.Restorer(toxicity.char_model(toxicity.trigram_counts(texts)))
    hidden = {"stuupid": "stupid", "iiddiioott": "idiot", "mmoorroonn": "moron", "(lown": "clown", "+rash": "trash", "|diot": "idiot",
              "@$$": "ass", "i/d/i/o/t": "idiot", "i,d,i,o,t": "idiot", "i\td\ti\to\tt": "idiot", "i\nd\ni\no\nt": "idiot",
              "i   d   i   o   t": "idiot", "ii dd ii oo tt": "idiot", "i|d|i|o|t": "idiot", "i*d*i*o*t": "idiot", "@ $ $": "ass",
              "((lown)": "clown", "m . 0 . r . 0 . n": "moron", "(i d i o t)": "idiot", "idiot!": "idiot"}
    for h, word in hidden.items():
        assert word in restorer.restored(f"walks towards {h} fields"), (h, restorer.restored(h))


def test_viterbi_finds_the_likeliest_string():
    """Against enumeration of all paths through small lattices."""
    from itertools import product
    model = toxicity.char_model(toxicity.trigram_counts([t for _, t in toxic_corpus()[0]]))
    restorer = toxicity.Restorer(model)
    for stretch in ("1d10t", "l0$er", "m00ron", "sc!!"):
        lattice = restorer.lattice(stretch, False)

        def cost(path):
            total, a, b = sum(p for _, p in path), toxicity.OTHER, toxicity.BREAK
            for out, _ in [*path, (" ", 0.0)]:
                if out:
                    c = toxicity.BREAK if out == " " else toxicity._SYMBOL.get(out, toxicity.OTHER)
                    total, a, b = total + model[a, b, c], b, c
            return total
        best = max(product(*lattice), key=cost)
        assert restorer.decode(lattice) == "".join(o for o, _ in best)


def test_assigned_values_are_findings_whatever_their_form():
    cases = {'password = "hunter2" and more': "hunter2", "token: correcthorsebatterystaple next": "correcthorsebatterystaple",
             "pwd='a b c!' x": "a b c!", "secret=p$s&w~rd!%?x, then": "p$s&w~rd!%?x", "api_key=abc": "abc",
             'export API-KEY="ab\\"cd" x': 'ab\\"cd', "{'password': 'open sesame'}": "open sesame", "auth=x": "x",
             "password=0123456789abcdef01 x": "0123456789abcdef01", 'token = "0123456789abcdef"': "0123456789abcdef"}
    for text, value in cases.items():
        got = secrets.spans(text)
        assert [text[a:b] for a, b in got] == [value], text
        assert secrets.rule_label(text, *got[0]) == 1, text
    both = "x9y8z7w6v5u4t3:password:abc 0123456789abcdef"
    assert [both[a:b] for a, b in secrets.spans(both)] == ["x9y8z7w6v5u4t3", "abc", "0123456789abcdef"]
    assert secrets.spans("password hunter2, token ring; the secret is out") == []


def test_secret_scan(spark, docs_of):
    r = random.Random(6)
    hexed = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    key = lambda: "AKIA" + "".join(r.choice("ABCDEFGHIJ0123456789") for _ in range(16))
    forms = [lambda: (f'token = "{hexed(40)}"', 1), lambda: (f"password={hexed(18)}", 1), lambda: (key(), 1),
             lambda: (f"{r.randrange(200)}.{r.randrange(100, 255)}.{r.randrange(100, 255)}.{r.randrange(100, 255)}", 0),
             lambda: (f"an.other.{r.randrange(99)}@mail{r.randrange(9)}.example.com", 0), lambda: (f"/usr/lib/x86/part{r.randrange(999)}", 0)]
    rows, want = [], {}
    for i in range(240):
        text, label = forms[i % 6]()
        rows.append((i, f"some words stand before {text} and some behind it"))
        want[i] = label
    found = secrets.scan(docs_of(rows + AWKWARD), train_on=~langid.held_out(F.col("key"), 5, 0)).collect()
    held = [x for x in found if x.doc_id in want and zlib.crc32(str(x.doc_id).encode()) % 5 == 0]
    assert len(held) > 30 and all(x.secret == bool(want[x.doc_id]) for x in held)
    texts = dict(rows)
    assert all(texts[x.doc_id][x.start:x.start + x.length] == x.value for x in found if x.doc_id in texts)
    assert secrets.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_long_runs_of_signs_score_in_linear_time():
    """Runs of any sign inside, before, behind and without words: same evidence as without them, and no blow-up."""
    import time

    model = toxicity.Model(toxicity.char_model(toxicity.trigram_counts([t for _, t in toxic_corpus()[0]])),
                           {f: 1.0 for f in toxicity.features("blorptwit")})
    scorer = toxicity.Scorer(model)
    clean, toxic = scorer.score("a word"), scorer.score("blorptwit")
    assert toxic > clean
    for sign in "-.#*!|_@,=~":
        for n in (1, 2, 3, 60, 5000):
            run = sign * n
            began = time.process_time()
            assert scorer.score(f"a{run}b") == clean and scorer.score(run) == clean
            if n > 3:
                assert scorer.score(f"{run} blorptwit {run}") == toxic, (sign, n)
            assert scorer.score(f"{run}.,{run} {sign} " * 2) == clean
            assert time.process_time() - began < 5, (sign, n)


def test_lattices_without_a_lexicon_word_need_no_decoding():
    """The trie test never says no where decoding finds a feature."""
    r = random.Random(4)
    words = ["blorp", "twit", "zapp", "oo", "moon", "abba", "llama"]
    lexicon = {f: 1.0 for w in words for f in toxicity.features(w)}
    model = toxicity.char_model(toxicity.trigram_counts([" ".join(r.choices(words, k=50))]))
    every, gated = toxicity.Restorer(model), toxicity.Restorer(model, toxicity.Beginnings(lexicon))
    signs = "blorptwizamn" + "01!@*# .-_"
    for _ in range(3000):
        base = r.choice(words + ["".join(r.choices(signs, k=6))])
        text = "".join(c * r.choice((1, 1, 1, 2)) if r.random() < 0.8 else r.choice(signs) for c in base) + r.choice(["", " x", "!!"])
        hits = [{f for w in x.restored(text) for f in toxicity.features(w) if f in lexicon} for x in (every, gated)]
        assert hits[0] == hits[1], text
        scorer = toxicity.Scorer(toxicity.Model(model, lexicon, 0.0))
        assert scorer.score(text) == pytest.approx(1 / (1 + np.exp(-min(30, len(hits[0]))))), text


def plain_description(text, start, end, table, known):
    """The features of a finding, counted one by one."""
    import math
    value = text[start:end]
    shares = [value.encode("latin-1", "replace").count(c) / len(value) for c in set(value.encode("latin-1", "replace"))]
    kind = lambda c: "digit" if c.isdigit() else "upper" if c.isupper() else "lower" if c.islower() else "other"
    kinds = [kind(c) for c in value]
    pairs = [table[min(ord(a), 127) if ord(a) < 256 else 63][min(ord(b), 127) if ord(b) < 256 else 63] for a, b in zip(value, value[1:])]
    at, covered = 0, 0
    while at < len(value):
        fits = [n for n in range(3, 13) if at + n <= len(value) and value[at:at + n].lower() in known]
        covered += max(fits, default=0)
        at += max(fits, default=1)
    return [len(value), -sum(p * math.log2(p) for p in shares), *[kinds.count(k) / len(value) for k in ("digit", "upper", "lower", "other")],
            sum(a != b for a, b in zip(kinds, kinds[1:])) / len(value), sum(pairs) / len(pairs) if pairs else 0.0, covered / len(value),
            value.count("/"), value.count("."), value.count("@")]


def test_findings_are_described_as_by_a_plain_count():
    r = random.Random(8)
    table = np.log(np.random.default_rng(1).random((128, 128)))
    known = frozenset(["word", "some", "here", "secret", "abc"])
    for _ in range(300):
        text, start, end, _ = secrets.planted("some words é stand here and abc there are", r, sorted(known))
        got = secrets.describe(text, start, end, table, known)
        assert got[:12] == pytest.approx(plain_description(text, start, end, table, known)), text
        left = [w for w in text[max(0, start - 40):start].split()]
        assert sum(got[-secrets.NEIGHBOURS:]) == (1.0 if left else 0.0) and len(got) == len(secrets.FEATURES)


def test_secrets_are_told_from_words_behind_the_same_names(spark, docs_of):
    """Held-out planted truth, and sentences in which a secret's name is followed by a word."""
    r = random.Random(9)
    vocabulary = ["".join(r.choices("aeinorst", k=r.randrange(3, 9))) for _ in range(300)]
    prose = [(i, " ".join(r.choices(vocabulary, k=60))) for i in range(150)]
    words_ = ["password: please", "token: example", "api_key = changeme", "secret: never", 'password = "required"', "token = none"]
    sure = [f'token = "{"".join(r.choices("0123456789abcdef", k=40))}"', "password=hT7k2Lq9Zx!4", "AKIA" + "".join(r.choices("ABCDEFG0123456789", k=16)),
            'api_key: "Zk3vQ8s1Lw0pT6yB2nM4"', "secret = 9f8e7d6c5b4a39281706f5e4"]
    rows = prose + [(1000 + i, f"some words before {t} and behind") for i, t in enumerate(words_)] \
        + [(2000 + i, f"some words before {t} and behind") for i, t in enumerate(sure)]
    docs = docs_of(rows + AWKWARD)
    found = {x.doc_id: x for x in secrets.scan(docs).collect() if x.doc_id and x.doc_id >= 1000}
    assert len(found) == len(words_) + len(sure)
    assert [k for k, x in found.items() if x.secret != (k >= 2000)] == []
    # precision and recall on planted findings that the forest has not seen
    src = docs.select(F.col("doc_id").alias("key"), "text")
    table, known = secrets.transition_counts(src), secrets.dictionary(src)
    model = secrets.train(secrets.planted_findings(src.filter("key % 3 <> 0"), table, known))
    held = secrets.classify(secrets.planted_findings(src.filter("key % 3 = 0"), table, known), model).select("label", "score").toPandas()
    said = held["score"] >= 0.5
    assert (held["label"][said] == 1).mean() > 0.9 and said[held["label"] == 1].mean() > 0.85
