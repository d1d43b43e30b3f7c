import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def shipped(spark):
    from courtline.llm.common import ship
    ship(spark)


@pytest.fixture()
def docs_of(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source) rows, with extra columns of awkward names."""
    def make(rows):
        full = [(*r, *("en", "s")[len(r) - 2:], None)[:5] if len(r) < 5 else r for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in ("id", "key", "row", "fp", "size", "score", "shard", "start", "w", "label", "h", "taken", "held_out"):
            df = df.withColumn(name, F.lit("clash"))
        return df
    return make


LONG = "lorem ipsum dolor sit amet " * 40_000

AWKWARD = [
    (1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "One word"), (4, "One word"), (None, "null key here now"),
    (None, "null key here now"), (5, LONG), (6, "Ünïcödé — naïve 日本語 テスト 🙂 café"), (None, None),
    # Long runs of blanks and of signs, alone and around words.
    (7, "tabs" + "\t" * 500 + " after"), (8, "\n" * 5000 + "lines"), (9, "a" + "-" * 5000 + "b"), (10, "# " * 2000), (11, "#" * 5000),
    (12, "x" + "*" * 3000 + "y " + ".," * 3000 + " z" + "!" * 4000), (13, "|---" * 1500 + "|"), (14, " " * 3000 + "spaces " + "\u2003" * 100 + " em"),
    (15, "_" * 4000 + "@" * 4000),
]
