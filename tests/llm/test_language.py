"""Language identification against a plain coder, and held-out accuracy."""

import brute
import pytest
from conftest import ODD
from pyspark.sql import functions as F

from viewtally.llm import language
from viewtally.llm.queries import QUERIES

TRAINING = [
    ("en", "the cat sat on the mat and the dog ran off to the hill"), ("en", "this is the way that they went there"),
    ("de", "die katze sitzt auf der matte und der hund läuft weg"), ("de", "das ist der weg den sie gegangen sind"),
]


@pytest.fixture(scope="module")
def model(make_docs):
    rows = [(i, t, lang) for i, (lang, t) in enumerate(TRAINING)]
    return language.fit_language_model(make_docs(rows + [(98, None, "en"), (99, "no language known", None)]))


def test_code_lengths_are_exact(model, make_docs):
    texts = ["the hill", "der hund", "zzz ÿ", "t", "the cat sat on the mat and the dog ran off to the hill" * 3]
    got = {r.doc_id: r for r in language.identify_language(make_docs(list(enumerate(texts))), model).collect()}
    for i, text in enumerate(texts):
        bits = brute.language_bits(TRAINING, text)
        best = min(sorted(bits), key=lambda k: bits[k])
        assert got[i].bits_per_byte == pytest.approx(bits[best] / len(text.encode()), rel=1e-5)
        assert got[i].lang_pred == best
        assert got[i].score == pytest.approx(1 / sum(2 ** (bits[best] - b) for b in bits.values()), abs=1e-4)


def test_odd_rows(model, odd):
    frame = language.identify_language(odd.withColumn("Score", F.lit(1)), model)
    assert [c.lower() for c in frame.columns].count("score") == 1
    rows = {r.doc_id: r for r in frame.collect()}
    assert frame.count() == len(ODD)
    for i in (1, 2, 3, 4):
        assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
    assert rows[1].bits_per_byte is None and rows[7].lang_pred in ("en", "de")


def test_nothing_learned(make_docs, odd):
    model = language.fit_language_model(make_docs([(1, "text", None), (2, None, "en")]))
    assert model is None
    rows = language.identify_language(odd, model).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}


def test_blocks_of_languages_give_the_same(spark, make_docs, odd):
    """More languages than one model holds, a tie between two of them, and odd texts."""
    spoken = [(f"l{i:02d}", f"{chr(97 + i) * 3} the {chr(98 + i)}at") for i in range(20)] + [("l99", "aaa the bat")]
    docs = make_docs([(i, t, lang) for i, (lang, t) in enumerate(spoken)])
    asked = odd.unionAll(docs).select("doc_id", "text")
    results = []
    for block in (40, 7, 1):
        learned = language.fit_language_model(docs, block=block)
        rows = language.identify_language(asked, learned).collect()
        results.append(sorted((str(r.doc_id), str(r.text), r.lang_pred, round(r.score, 6), r.bits_per_byte and round(r.bits_per_byte, 3)) for r in rows))
        assert language.learned_letters(learned) == language.learned_letters(language.fit_language_model(docs))
    assert results[0] == results[1] == results[2]
    assert {r[2] for r in results[0] if r[1] == "aaa the bat"} == {"l00"}


def test_groups_are_bounded_for_each_language(make_docs):
    docs = make_docs([(1, "abcdefgh" * 50, "long"), (2, "xyz", "short")])
    learned = language.fit_language_model(docs, max_grams=4)
    assert {r.l: r["count"] for r in learned.counts.groupBy("l").count().collect()} == {"long": 4, "short": 3}


def test_held_out_accuracy(spark, sf_dir, documents):
    rows = QUERIES["op10_language"](spark, sf_dir).join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r.lang == r.lang_pred for r in rows)
    assert len(rows) >= 20 and right / len(rows) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)
