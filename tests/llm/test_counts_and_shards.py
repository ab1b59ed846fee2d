"""Length tables and placements against plain versions."""

from collections import Counter

import pytest
from conftest import ODD
from harness import compare
from pyspark.sql import functions as F

from viewtally.llm import bpe, sharding, token_counts
from viewtally.llm.checks import SQL
from viewtally.llm.queries import QUERIES, SHARD_NAMES, VOCABULARY_FILE


def plain_table(lengths):
    n = len(lengths)
    return {
        limit: (
            docs, sum(x >= limit for x in lengths), sum(x for x in lengths if x >= limit), sum(min(x, limit) for x in lengths),
            pytest.approx(sum(x <= limit for x in lengths) / n),
        )
        for limit, docs in Counter(lengths).items()
    }


def told(rows):
    return {r.context_limit: (r.docs, r.docs_from, r.tokens_from, r.truncated_tokens, r.covered) for r in rows}


def test_query_equals_plain_table(spark, sf_dir, documents):
    counted = bpe.count_tokens(documents, bpe.load_vocabulary(VOCABULARY_FILE)).select("n_tokens").collect()
    assert told(QUERIES["op4_token_counts"](spark, sf_dir).collect()) == plain_table([r.n_tokens for r in counted])


def test_blocks_groups_and_limits_between(spark):
    lengths = [0, 0, 1, 5, 5, 1023, 1024, 1025, 5000, 5000, 10**9]
    counted = spark.createDataFrame([("a", x) for x in lengths] + [(None, 3), (None, 4096), ("a", None)], "source string, n_tokens long")
    by = token_counts.length_table(token_counts.length_histogram(counted, by=["source"]), by=["source"])
    rows = by.collect()
    assert told([r for r in rows if r.source == "a"]) == plain_table(lengths)
    assert told([r for r in rows if r.source is None]) == plain_table([3, 4096])
    cut = token_counts.truncated_totals(token_counts.length_histogram(counted.where("source = 'a'")), [4, 2000])
    assert {r.context_limit: (r.tokens, r.docs_cut) for r in cut.collect()} == {
        limit: (sum(min(x, limit) for x in lengths), sum(x > limit for x in lengths)) for limit in (4, 2000)
    }


def test_no_documents(spark):
    none = spark.createDataFrame([], "n_tokens long")
    assert token_counts.length_table(token_counts.length_histogram(none)).count() == 0


def test_placement_equals_check(spark, sf_dir, con):
    assert compare(QUERIES["op5_sharding"](spark, sf_dir), con.cursor(), SQL["op5_sharding"]) == []


def test_table_is_even_and_changes_little():
    names = SHARD_NAMES[:10]
    full, less = sharding.lookup_table(names, 9973), sharding.lookup_table(names[:-1], 9973)
    sizes = Counter(full).values()
    assert max(sizes) - min(sizes) <= 1
    moved = sum(a != b for a, b in zip(full, less, strict=True) if a != 9)
    assert moved < 0.1 * 9973
    for bad in (["a", "a"], []):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 11)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 12)


def test_odd_rows_are_placed_natively(odd):
    frame = sharding.place(odd.withColumn("SLOT", F.lit("mine")), SHARD_NAMES)
    assert [c for c in frame.columns if c.lower() == "slot"] == ["slot"]
    assert frame.count() == len(ODD)
    assert frame.where("doc_id = 9").select("shard").distinct().count() == 1
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not [n for n in ("Python", "Pandas", "Arrow") if n in plan]
    assert sharding.place(odd.where("doc_id < 0"), SHARD_NAMES).count() == 0


def test_groups_of_any_name(spark):
    rows = spark.createDataFrame([("a", 1, 2), ("b", 1, 3), ("b", 5, 1)], "block string, length long, docs long")
    table = token_counts.length_table(rows, by=["block"])
    assert table.columns == ["block", "context_limit", "docs", "docs_from", "tokens_from", "truncated_tokens", "covered"]
    got = sorted((r[0], r.context_limit, r.docs_from, r.tokens_from) for r in table.collect())
    assert got == [("a", 1, 2, 2), ("b", 1, 4, 8), ("b", 5, 1, 5)]
