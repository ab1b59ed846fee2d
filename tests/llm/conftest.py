import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (id, text) or (id, text, lang) rows."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Texts that any operator must stand: null, empty, blank, marks, one letter, other scripts, very long, a tie, repeated rows.
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "!!! ???"), (5, "a"), (6, "日本語 の 文章 です"), (7, "word " * 30_000), (8, "same text here for two rows now"),
    (9, "same text here for two rows now"), (9, "same text here for two rows now"), (None, "no id at all in this row"), (10, "é" * 9 + " 😀 \x00 nul"),
]


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ODD)
