"""Toxicity and quality: learning rule, held-out accuracy, odd rows."""

import random

import numpy as np
import pytest
from conftest import ODD
from pyspark.sql import functions as F

from viewtally.llm import quality, toxicity
from viewtally.llm.queries import QUERIES


def plain_ftrl(rows, labels, epochs):
    """One coordinate after another, in a dictionary."""
    z, n, seen = {}, {}, {}
    for row in rows:
        for f in row:
            seen[f] = seen.get(f, 0) + 1

    def weight(f):
        l1 = 0.0 if f == "bias" else toxicity.L1
        own = z.get(f, 0.0)
        return 0.0 if abs(own) <= l1 else -(own - np.sign(own) * l1) / ((toxicity.BETA + n.get(f, 0.0) ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(epochs):
        for row, label in zip(rows, labels, strict=True):
            row = [f for f in row if seen[f] >= toxicity.MIN_TEXTS] + ["bias"]
            w = {f: weight(f) for f in row}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for f in row:
                before = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - ((before + g * g) ** 0.5 - before**0.5) / toxicity.ALPHA * w[f]
                n[f] = before + g * g
    return {f: weight(f) for f in z if weight(f)}


def test_learning_rule():
    rng = random.Random(1)
    rows = [sorted(rng.sample(range(60), 12)) for _ in range(300)]
    labels = [int(3 in r or 7 in r) for r in rows]
    model = toxicity.ftrl([np.array(r) for r in rows], labels, 3)
    wanted = plain_ftrl(rows, labels, 3)
    assert model.bias == pytest.approx(wanted.pop("bias"), rel=1e-6)
    assert dict(zip(model.features.tolist(), model.weights.tolist(), strict=True)) == pytest.approx(wanted, rel=1e-4)


@pytest.fixture(scope="module")
def told(make_docs, spark):
    """Texts of invented words; label 1 has two of twenty marked words."""
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(900):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, 120))]
        bad = i % 5 == 0
        if bad:
            for _ in range(2):
                words[rng.randrange(len(words))] = f"bad{rng.randrange(20)}"
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    labels += [(None, 1, 1), (3, None, None), (10**6, 1, 1)]
    return make_docs(rows).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_of_held_out_rows(told):
    docs, labels = told
    model = toxicity.fit_toxicity(docs, labels.where("doc_id % 4 <> 2 OR doc_id IS NULL"))
    assert 0 < len(model.features) < 2000
    rows = toxicity.score_toxicity(docs, model).where("doc_id % 4 = 2").collect()
    wrong = sum((r.score >= 0.3) != (r.doc_id % 5 == 0) for r in rows)
    assert wrong / len(rows) <= 0.05


def auc(rows):
    good, bad = [r.score for r in rows if r.y], [r.score for r in rows if not r.y]
    return np.mean([(a > b) + (a == b) / 2 for a in good for b in bad])


@pytest.mark.parametrize("name,label,least", [("op1_toxicity", "toxic", 0.85), ("op8_quality", "quality", 0.95)])
def test_queries_on_held_out_rows(spark, name, label, least):
    folder = "/root/testdata/sf0.1"
    rows = QUERIES[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = rows.where("held_out").select("score", "predicted", F.col(label).alias("y")).collect()
    assert auc(rows) >= least
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_odd_rows(told, odd):
    docs, labels = told
    toxic = toxicity.fit_toxicity(docs, labels)
    good = quality.fit_quality(docs, labels.withColumn("quality", F.col("doc_id").cast("int") % 2))
    for scored in (toxicity.score_toxicity(odd.withColumn("SCORE", F.lit(2)), toxic), quality.score_quality(odd, good)):
        rows = scored.collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
        assert len({r.score for r in rows if r.doc_id in (8, 9)}) == 1
    assert toxicity.score_toxicity(odd.where("doc_id < 0"), toxic).count() == 0


def test_nothing_learned(told, odd):
    docs, labels = told
    none = labels.where("doc_id < 0")
    assert {r.score for r in toxicity.score_toxicity(odd, toxicity.fit_toxicity(docs, none)).collect()} == {0.5}
    assert {r.score for r in quality.score_quality(odd, quality.fit_quality(docs, none)).collect()} == {0.5}


def test_votes_are_exact_cosines():
    rng = np.random.default_rng(8)
    counts = rng.integers(0, 5, (60, quality.TERMS)).astype(np.float32)
    labels = (np.arange(60) % 3 > 0).astype(np.int64)
    model = quality.build(counts, labels, np.array([20.0, 40.0]))
    near = model.vectors @ model.vectors[0]
    assert near[0] == pytest.approx(1) and near.argmax() == 0
    assert model.directions.shape == (quality.TERMS, quality.DIMENSIONS)
