"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

All stages but the last return the columns of documents.  Parameters are those
of the registered queries of the same operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtline.llm import decontaminate, mixing, sharding, simhash, toxicity
from courtline.llm.common import ship, stored, table

SHARDS = 16


def clean_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that score 0.5 or more as toxic go.  Learns from all labelled rows of what it is given.

    Null and empty texts score the base rate and stay; repeated rows and rows
    with null ids are kept or go each by its text; an empty table, or labels
    without a toxic row, lets everything through.
    """
    ship(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of each group of near copies the document with the smallest id stays, once where rows repeat.

    Null ids come after all others.  Null, empty and blank texts have
    fingerprint zero, so they are one group, with texts whose fingerprint is
    within its distance.  An empty table stays empty.
    """
    ship(spark)
    return simhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that contain a benchmark item, by words at 0.8 of its weighted shingles or more, go.

    Null and empty texts contain nothing and stay, as do null and empty items
    without effect; repeated rows go or stay together; empty tables take nothing out.
    """
    ship(spark)
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: every document as often as the mix takes it, in whole copies (its taken words over its size, rounded).

    A tape is cut within one document at most, and only there does rounding
    differ from the words taken, by half that document's size at most.  Where it
    is all that a source gives and would be rounded away, one copy stays.
    Documents that the mix does not take are out.
    """
    ship(spark)
    mixed, _ = mixing.mix(docs)
    # Halves round up; a document without words is never taken.
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0).cast("int")
    mixed = stored(mixed.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("copy").alias("_copy"),
                                copies.alias("_copies"), "source_no", "taken").filter("taken > 0"), "mix-copies")
    kept, cut = mixed.filter("_copies > 0"), mixed.filter("_copies = 0")  # at most one cut document a source
    alone = cut.join(kept.select("source_no").distinct(), "source_no", "left_anti").withColumn("_copies", F.lit(1))
    mixed = kept.unionByName(alone).drop("source_no", "taken")
    same = Window.partitionBy("doc_id", "_text").orderBy("source")
    numbered = docs.withColumn("_text", F.xxhash64("text")).withColumn("_same", F.row_number().over(same) - 1)
    joined = numbered.join(mixed, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_text").eqNullSafe(F.col("_hash"))
                           & (F.col("_same") == F.col("_copy")))
    return joined.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*[docs[c] for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: a shard and a slot for every document, repeated rows included.

    A null id is a key like any other, a null text counts as empty, and an
    empty table gives no rows.  The columns are those of the operator.
    """
    ship(spark)
    return sharding.shard_documents(docs, sharding.tree(SHARDS))


STAGES = [
    ("toxicity", clean_toxic),
    ("simhash_neardup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("source_mixing", mix_sources),
    ("sharding", shard),
]

# Learned scores, fingerprints and hash draws are not for SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
