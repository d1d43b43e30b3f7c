"""The corpus pipeline, stage by stage, against plain versions."""
import random
import zlib

import corpus_pipeline
from courtline.llm import toxicity
from courtline.llm.common import stored
from tests.llm.conftest import AWKWARD, DOCS
from tests.llm.test_relations import plain_matches, plain_targets, toxic_corpus
from tests.llm.test_texts import plain_fingerprint, plain_groups


def test_pipeline(spark, tmp_area):
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(30))) for i in range(3)]
    toxic, labels = toxic_corpus()
    rows = [(i, t, "en", f"s{i % 4}") for i, t in toxic]
    rows += [(k, t, None, None) for k, t in AWKWARD]
    rows += [(500 + i, f"{' '.join(word() for _ in range(60))} {items[i][1]} {word()}", "en", "s1") for i in range(3)]
    base = " ".join(word() for _ in range(300))
    rows += [(600 + i, base if i < 3 else base + f" {word()}", "en", "s2") for i in range(5)]
    docs = spark.createDataFrame([(*x, None) for x in rows], DOCS)
    docs.write.parquet(f"{tmp_area}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_area}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_area}/benchmark.parquet")

    out, steps = spark.read.parquet(f"{tmp_area}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, out, tmp_area), name)
        steps[name] = out.collect()
        if name != "sharding":
            assert out.columns == docs.columns, name

    model = toxicity.learn(docs, spark.read.parquet(f"{tmp_area}/labels.parquet"))
    scorer = toxicity.Scorer(model)
    clean = [x for x in rows if scorer.score(x[1]) < 0.5]
    key = lambda x: str((x[0], x[1]))
    assert sorted(map(key, steps["toxicity"])) == sorted(map(key, clean))
    assert {i for i, _, t in labels if not t} <= {x[0] for x in clean}

    prints = [plain_fingerprint(t) for _, t, _, _ in clean]
    group, best = plain_groups(prints, 4), {}
    for g, x in zip(group, clean):
        if g not in best or (x[0] is None, x[0] or 0) < (best[g][0] is None, best[g][0] or 0):
            best[g] = x
    got = steps["simhash_neardup"]
    # Of rows that share the smallest id any may stay.
    assert sorted(str(x.doc_id) for x in got) == sorted(str(x[0]) for x in best.values())

    bad = {k for k, _, _ in plain_matches([(x.doc_id, x.text) for x in got], items)}
    assert bad == {500, 501, 502}
    kept = steps["decontamination"]
    assert sorted(map(key, kept)) == sorted(key(x) for x in got if x.doc_id not in bad)

    size, taken = {}, {}
    for x in kept:
        size[x.source] = size.get(x.source, 0) + len((x.text or "").split())
    copies = {}
    for x in steps["source_mixing"]:
        taken[x.source] = taken.get(x.source, 0) + len(x.text.split())
        copies[key(x)] = copies.get(key(x), 0) + 1
    assert max(copies.values()) <= 3 and set(copies) <= set(map(key, kept))
    longest = {s: max(len((x.text or "").split()) for x in kept if x.source == s) for s in size}
    for s, target in plain_targets(size).items():
        assert abs(taken.get(s, 0) - target) <= longest[s] + 130, s

    last = steps["sharding"]
    want = sorted((str(x.doc_id), len(x.text.encode()) + 1, zlib.crc32(x.text.encode())) for x in steps["source_mixing"])
    assert sorted((str(x.doc_id), x["size"], x.text_crc32) for x in last) == want
    for s in {x.shard for x in last}:
        slots = sorted(x.slot for x in last if x.shard == s)
        assert slots == list(range(len(slots)))
    again = corpus_pipeline.run(spark, tmp_area).collect()
    assert sorted((str(x.doc_id), x.shard) for x in again) == sorted((str(x.doc_id), x.shard) for x in last)


def test_no_source_is_rounded_away(spark, docs_of, tmp_area):
    rows = [(i, " ".join(["w"] * 10), "en", "ab"[i % 2]) for i in range(80)] + [(900, " ".join(["long"] * 1000), "en", "c")]
    got = [x.source for x in corpus_pipeline.mix_sources(spark, docs_of(rows), tmp_area).collect()]
    assert got.count("c") == 1
    assert (10 * got.count("a"), 10 * got.count("b")) == (1130, 450)


def test_stages_of_empty_tables(spark, tmp_area):
    """No documents, labels or items: every stage gives no rows, with its columns."""
    docs = spark.createDataFrame([], DOCS)
    docs.write.parquet(f"{tmp_area}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_area}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_area}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tmp_area)
        assert out.count() == 0, name
        if name != "sharding":
            assert out.columns == docs.columns, name
    assert corpus_pipeline.run(spark, tmp_area).count() == 0
