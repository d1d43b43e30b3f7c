"""The registered training-data queries: one per operator, with the parameters of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.llm import cover_tree, decontaminate, langid, mixing, ranked, secrets, sharding, simhash, token_binary, token_counts
from courtline.llm import toxicity, warc, whitening
from courtline.llm.common import ship, table
from courtline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return run
    return deco


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_token_binary")
def op1(spark, sf_dir):
    path = scratch_path(spark, "llm", "tokens", unique=True)
    token_binary.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=1)
    return token_binary.with_crc32(token_binary.read_tokens(spark, path)).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@register("op2_embedding_neardup")
def op2(spark, sf_dir):
    return cover_tree.neardup(table(spark, sf_dir, "embeddings"), cosine=0.9)


@register("op3_toxicity")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~langid.held_out(F.col("doc_id"), 5, 0))
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.learn(docs, labels))
    return scored.select("doc_id", langid.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op4_decontamination", decontaminate.ORACLE)
def op4(spark, sf_dir):
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col("item").alias("item_id"), "start", "similarity")


@register("op5_simhash_neardup")
def op5(spark, sf_dir):
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), k=4, radius=4)


@register("op6_source_mixing")
def op6(spark, sf_dir):
    mixed, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@register("op7_language_id")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out(F.col("doc_id"), 4, 2))
    model = langid.train(docs.filter(~F.col("held_out")))
    return langid.identify(docs, model, keep=("doc_id", "held_out"))


@register("op8_token_counts")
def op8(spark, sf_dir):
    counts = token_counts.prefix_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@register("op9_secret_scan")
def op9(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"), train_on=~langid.held_out(F.col("key"), 5, 0))
    return found.select("doc_id", "start", "length", "label", "score", "secret")


@register("op10_sharding")
def op10(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"), sharding.tree(16))


@register("op11_ranked_search", ranked.ORACLE)
def op11(spark, sf_dir):
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


@register("op12_warc", warc.ORACLE)
def op12(spark, sf_dir):
    path = scratch_path(spark, "llm", "archives", unique=True)
    warc.write_warc(table(spark, sf_dir, "pages"), path, least_revisit_bytes=0)
    return warc.page_captures(warc.captures(warc.read_warc(spark, path)))


@register("op13_whitening")
def op13(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"), k=16)
