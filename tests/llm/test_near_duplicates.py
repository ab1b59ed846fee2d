"""Near duplicates against all pairs, and the sketch against the similarity it estimates."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import ODD
from pyspark.sql import functions as F

from viewtally.llm import near_duplicates as nd
from viewtally.llm.components import connected_components
from viewtally.llm.queries import QUERIES
from viewtally.llm.textarrays import text_chunks
from viewtally.session import BATCH_BYTES, BATCH_KEY


def sets_of(texts):
    out = []
    for _, _, raw, offsets in text_chunks(pa.array(texts)):
        owners, elements, weights, _ = nd.shingles(raw, offsets, 5)
        for i in range(len(offsets) - 1):
            at = np.flatnonzero(owners == i)
            order = np.argsort(elements[at])
            out.append((elements[at][order].astype(np.int64), weights[at][order].astype(np.int32)))
    return out


def varied(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def test_similarity_equals_its_definition():
    rng = random.Random(2)
    for _ in range(40):
        words = varied(rng, 60, 6)
        other = edited(rng, words, rng.randrange(6)) + words[: rng.randrange(30)]
        a, b = " ".join(words), " ".join(other)
        (s, w), (t, v) = [sorted_by_unsigned(x) for x in sets_of([a, b])]
        assert nd.probability_jaccard(s, w, t, v) == pytest.approx(brute.probability_jaccard(brute.shingles(a), brute.shingles(b)))


def sorted_by_unsigned(pair):
    order = np.argsort(pair[0])
    return pair[0][order], pair[1][order]


def test_registers_estimate_the_similarity():
    rng = random.Random(4)
    words = varied(rng, 300) * 2
    texts = [" ".join(words), " ".join(edited(rng, words, 12)), " ".join(words[:300])]
    for _, _, raw, offsets in text_chunks(pa.array(texts)):
        owners, elements, weights, _ = nd.shingles(raw, offsets, 5)
        won = nd.registers(owners, elements, weights, 3, 4096)
    for i, j in ((0, 1), (0, 2), (1, 2)):
        exact = brute.probability_jaccard(brute.shingles(texts[i]), brute.shingles(texts[j]))
        assert (won[i] == won[j]).mean() == pytest.approx(exact, abs=0.04)


@pytest.mark.parametrize("similarity", [0.8, 0.82])
def test_filter_by_registers_loses_next_to_nothing_of_what_bands_find(similarity):
    rng = np.random.default_rng(6)
    equal = rng.random((100_000, nd.BANDS * nd.ROWS), dtype=np.float32) < similarity + (1 - similarity) / 256
    banded = equal.reshape(-1, nd.BANDS, nd.ROWS).all(axis=2).any(axis=1)
    lost = banded & (equal.mean(axis=1) < nd.SIMILARITY - nd.MARGIN)
    assert lost.sum() <= 0.0002 * len(equal) and banded.mean() > 0.996


def test_query_equals_all_pairs(spark, sf_dir, documents):
    got = {r.doc_id: r.class_id for r in QUERIES["op7_near_duplicates"](spark, sf_dir).collect()}
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert got == brute.near_classes(rows)


def test_groups_chains_and_shared_passages(make_docs):
    rng = random.Random(9)
    rows, base, passage = [], varied(rng, 120), varied(rng, 40)
    rows += [(len(rows) + i, " ".join(edited(rng, base, rng.randrange(3)))) for i in range(150)]  # a large group of near copies
    rows += [(len(rows) + i, " ".join(base).upper() + " !") for i in range(30)]  # copies but for case and marks
    rows += [(len(rows) + i, " ".join(passage + varied(rng, 30))) for i in range(80)]  # one passage, else different
    chain = varied(rng, 150)
    for _ in range(12):
        rows.append((len(rows), " ".join(chain)))
        chain = edited(rng, chain, 3)
    rng.shuffle(rows)
    got = {r.doc_id: r.class_id for r in nd.near_duplicates(make_docs(rows).repartition(4)).collect()}
    assert got == brute.near_classes(rows)


def test_blocks_join_what_any_pair_between_groups_joins(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 4)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, 64).astype(np.uint8)
    # registers agree inside three kinds; sets are alike only for neighbours on a line of each kind
    words = [rng.integers(0, 1 << 40, 400 + 4 * 30).astype(np.uint64) for _ in range(3)]
    kinds = [base, base[::-1].copy(), rng.integers(0, 256, 64).astype(np.uint8)]

    def packed(i):
        own = np.sort(words[i % 3][4 * i : 4 * i + 90])
        return bytearray(own.view(np.uint8).reshape(-1, 8)[:, :6].tobytes())

    group = lambda i: 100 + i // 6 * 3 + i % 3
    rows = [(b, b, i, group(i), bytearray(kinds[i % 3].tobytes()), packed(i), None) for b in (0, 1) for i in range(30) if i % 9 != 6]
    members = spark.createDataFrame(rows, "bucket long, band int, node long, root long, sketch binary, s binary, w binary")
    told = nd.joining_links(members, 0.7, 8).collect()
    root = {r[3]: r[3] for r in rows}

    def find(pairs):
        at = dict(root)
        for x, y in pairs:
            x, y = at[x], at[y]
            at = {k: min(x, y) if v in (x, y) else v for k, v in at.items()}
        return at

    def alike(i, j):
        a, b = ({bytes(packed(k)[n : n + 6]) for n in range(0, 540, 6)} for k in (i, j))
        return i % 3 == j % 3 and len(a & b) / len(a | b) >= 0.7

    nodes = sorted({r[2] for r in rows})
    every = [(group(i), group(j)) for i in nodes for j in nodes if i < j and alike(i, j)]
    assert find((r.x, r.y) for r in told) == find(every) and 1 < len(set(find(every).values())) < len(root)


def test_neighbours_tell_one_good_pair_a_member_and_bucket(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 256, 64).astype(np.uint8)
    rows = [(b, b, i, i // 2, bytearray((base if i % 3 else base[::-1].copy()).tobytes())) for b in (0, 1) for i in range(30)]
    members = spark.createDataFrame(rows, "bucket long, band int, node long, root long, sketch binary")
    told = nd.neighbours(members, 0.9, 8, 8, 0).collect()
    assert len({r.b for r in told}) > 20 and len(told) <= 2 * 30
    assert all(r.x == r.a // 2 and r.y == r.b // 2 and r.x != r.y and bool(r.a % 3) == bool(r.b % 3) and r.agreeing == 1.0 for r in told)


def test_texts_are_compared_whatever_their_ids(make_docs):
    long = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    rows = [
        (2, long), (2, "quite another text of the same id with words of its own"), (4, long + " eighteen"), (None, long), (None, "no id here but words enough to see"),
        (None, "No id here, but words enough to see!"), (7, "NO ID HERE but words enough to see"), (8, long.upper()), (8, None),
    ]
    docs = make_docs(rows)
    got = sorted((r.doc_id, r.text_id, r.class_id) for r in nd.near_duplicates(docs).fillna(-1).collect())
    assert got == sorted([(2, 2, 2), (2, 2, 2), (4, 4, 2), (-1, 2, 2), (-1, 7, 7), (-1, 7, 7), (7, 7, 7), (8, 2, 2), (8, 8, 8)])
    kept = sorted(((r.doc_id, r.text) for r in nd.one_of_each(docs).collect()), key=str)
    assert kept == sorted([rows[0], rows[1], rows[6], rows[8]], key=str)


def test_one_of_each_keeps_columns_and_one_of_repeated_rows(make_docs):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "A b c d e f g"), (None, "x y z"), (None, "x y z"), (3, "!")]
    docs = make_docs(rows).withColumns({"digest": F.lit(1), "a.b": F.lit("z"), "root": F.lit(None).cast("int")})
    out = nd.one_of_each(docs)
    assert out.columns == docs.columns and out.schema["digest"].dataType == docs.schema["digest"].dataType
    assert sorted(((r.doc_id, r.text, r["a.b"]) for r in out.collect()), key=str) == sorted([(1, "A b c d e f g", "z"), (None, "x y z", "z"), (3, "!", "z")], key=str)


def test_odd_rows(odd):
    rows = nd.near_duplicates(odd.withColumn("class_id", F.lit(7))).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: r.class_id for r in rows}
    assert got == {None: None, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 8, 9: 8, 10: 10}
    assert nd.near_duplicates(odd.where("doc_id < 0")).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 50), (100, 51), (60, 60), (7, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 51: 50, 100: 50}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_without_words_need_no_second_pass_of_digests(make_docs):
    texts = [None, "", " .,;-\t\n", "_", "a", "Z!", "7", "é", "\x7f", "\x80", "中", "\U0001f600", "@[`{/:"]
    docs = make_docs(list(enumerate(texts)))
    out = nd.one_of_each(docs)
    # rows alone in their class, and those that repeat: one exchange serves both
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 2
    assert sorted(r.doc_id for r in out.collect()) == list(range(len(texts)))
    digest = nd.word_digests(docs.select("doc_id", F.col("text").alias("t")), text="t", name="d")
    wordless = {r.doc_id for r in digest.where("d IS NULL").collect()}
    assert wordless == {r.doc_id for r in docs.where(~F.coalesce(F.col("text").rlike(nd.SOME_WORD), F.lit(False))).collect()}


def batch_bytes(df):
    """Bytes of each batch that Spark hands to the workers of one task."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["n"])

    return [r.n for r in df.coalesce(1).mapInArrow(sizes, "n long").collect()]


def test_batches_for_python_are_bounded_by_bytes_not_rows(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.rpad(F.concat(F.lit("w"), F.col("id")), 5000, " abcd").alias("text"))
    before = spark.conf.get(BATCH_KEY, None)
    try:
        spark.conf.unset(BATCH_KEY)
        assert max(batch_bytes(rows)) > 7 * BATCH_BYTES  # what Spark does by itself: all rows at once
        nd.one_of_each(rows)
        got = batch_bytes(rows)
        assert sum(got) >= 3000 * 5000 and max(got) < 2 * BATCH_BYTES
        spark.conf.set(BATCH_KEY, "12345678")
        nd.word_digests(rows, text="text", name="d")
        assert spark.conf.get(BATCH_KEY) == "12345678"  # a session's own bound stays
    finally:
        spark.conf.unset(BATCH_KEY) if before is None else spark.conf.set(BATCH_KEY, before)


def test_small_batches_change_nothing(spark, make_docs):
    rng = random.Random(5)
    base = [varied(rng, 60) for _ in range(12)]
    docs = make_docs([(i, " ".join(edited(rng, base[i % 12], i % 4))) for i in range(240)])
    before = spark.conf.get(BATCH_KEY, None)
    got = []
    try:
        for bound in ("64m", "2k"):
            spark.conf.set(BATCH_KEY, bound)
            found = sorted(map(tuple, nd.near_duplicates(docs).collect()))
            got.append((found, sorted(map(tuple, nd.one_of_each(docs).collect()))))
    finally:
        spark.conf.unset(BATCH_KEY) if before is None else spark.conf.set(BATCH_KEY, before)
    assert got[0] == got[1] and 12 <= len(got[0][1]) < 240
