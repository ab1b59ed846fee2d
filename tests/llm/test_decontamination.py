"""Benchmark passages against a plain scan and against SQL."""

import brute
import pytest
from conftest import ODD
from harness import compare
from pyspark.sql import functions as F

from viewtally.llm import decontamination as dc
from viewtally.llm.checks import SQL
from viewtally.llm.queries import QUERIES

ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven"), (2, "short item"), (2, "second passage"), (3, ""), (4, None),
    (5, "wörd wörd wörd"), (6, "a a a a a a a a a a a a"),
]
TEXTS = [
    "zero ONE, two three-four five six seven; eight nine ten eleven twelve", "one two three four five six seven eight nine", "A short item, and a second passage!",
    "short  Item", "wörd wörd wörd wörd x", "a " * 25, "item short", "nothing here", "short item" * 3,
]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_query_equals_check(spark, sf_dir, con):
    assert compare(QUERIES["op3_decontamination"](spark, sf_dir), con.cursor(), SQL["op3_decontamination"]) == []


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_equals_plain_scan(make_docs, benchmark, block_bytes):
    docs = make_docs(list(enumerate(TEXTS)))
    rows = {r.doc_id: r for r in dc.find_contamination(docs, benchmark, block_bytes=block_bytes).collect()}
    for i, text in enumerate(TEXTS):
        assert (rows[i].n_words, rows[i].n_hit, list(rows[i].item_ids)) == brute.contamination(text, ITEMS), text
        inside = [w for s in rows[i].hit_spans for w in brute.words(text[s.start : s.end])]
        assert len(inside) == rows[i].n_hit


def test_windows_that_items_share_or_repeat(spark, make_docs):
    """Items with equal windows, in equal and other blocks, one window often in one item, and many short items."""
    many = "one two three four five six seven eight nine ten " * 40
    items = [(1, many), (2, many), (3, "ten one two three four five six seven eight nine"), *[(i, f"item{i % 7} x") for i in range(10, 60)]]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = ["a " + many, "item3 X, item3", "nine ten one two three four five six seven eight nine", "é item3 y"]
    docs = make_docs(list(enumerate(texts)))
    for block_bytes in (1 << 20, 2500):
        rows = {r.doc_id: r for r in dc.find_contamination(docs, benchmark, block_bytes=block_bytes).collect()}
        for i, text in enumerate(texts):
            assert (rows[i].n_words, rows[i].n_hit, list(rows[i].item_ids)) == brute.contamination(text, items), text


def test_windows_take_little_memory():
    import pickle

    text = " ".join(f"w{i * 7919 % 100_003}" for i in range(100_000))
    windows = dc.Windows([("1", text)], 10)
    assert len(windows.tables[10][0]) == 99_991
    assert len(pickle.dumps(windows)) < len(text) + 24 * 100_000 + (2 << 20)


def test_removal_of_documents_and_spans(make_docs, benchmark):
    docs = make_docs(list(enumerate(TEXTS))).withColumn("n_hit", F.lit("mine"))
    clean = dc.remove_contaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [1, 6, 7, 8]
    cut = {r.doc_id: r for r in dc.remove_contaminated(docs, benchmark, spans=True).collect()}
    assert cut[0].text == "zero  twelve" and cut[2].text == "A , and a !" and cut[7].text == "nothing here" and cut[0].n_hit == "mine"


def test_odd_rows_and_empty_tables(spark, odd, benchmark):
    clashing = odd.withColumn("N_HIT", F.lit("mine"))
    rows = dc.find_contamination(clashing, benchmark).collect()
    assert len(rows) == len(ODD)
    assert {r.doc_id: r.n_words for r in rows if r.doc_id in (1, 2, 3, 4, 5, 7)} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 1, 7: 30_000}
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.remove_contaminated(odd, none).count() == len(ODD)
    assert dc.find_contamination(odd.where("doc_id < 0"), benchmark).count() == 0
