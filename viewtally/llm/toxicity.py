"""Toxicity of texts: logistic regression over hashed word n-grams and skip-grams.

Features are single words, neighbouring words and pairs with one or two words
between them, hashed to ``2 ** BITS`` numbers; each counts once in a text. The
weights are learned by FTRL-proximal: every coordinate has its own learning rate
from its own gradients, and the L1 term keeps weights at zero until they have
earned more than it, so that the model is a short list of numbers to broadcast.

Training takes a bounded sample of the labelled rows by a hash of their id; their
features are found in parallel, and one task goes over the ``SAMPLE`` rows in the
order of the hash. Scoring is one pass over all whole texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtally.llm.textarrays import LOWER, map_text, mix, quoted, row_sums, span_hashes, words

BITS = 20
SKIPS = (1, 2, 3)
SAMPLE = 10_000
MIN_TEXTS = 3
EPOCHS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 0.0

_STEP = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class LinearModel:
    """Weights of some features, and of what every text has."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def text_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different features of all texts of a chunk, and where each text's begin (one end more)."""
    raw = LOWER[raw]
    starts, ends, rows = words(raw, offsets)
    hashes = span_hashes(raw, starts, ends)
    found, owners = [hashes], [rows]
    for gap in SKIPS:
        n = max(len(hashes) - gap, 0)
        same = rows[:n] == rows[gap:]
        pair = mix(hashes[:n] * _STEP + hashes[gap:] + np.uint64(gap))
        found.append(pair[same])
        owners.append(rows[:n][same])
    keys = np.concatenate(owners).astype(np.uint64) << np.uint64(BITS) | np.concatenate(found) >> np.uint64(64 - BITS)
    keys = np.unique(keys)
    cut = np.searchsorted(keys, np.arange(len(offsets), dtype=np.uint64) << np.uint64(BITS))
    return (keys & np.uint64((1 << BITS) - 1)).astype(np.int64), cut


def ftrl(rows: Sequence[np.ndarray], labels: Sequence[int], epochs: int = EPOCHS) -> LinearModel:
    """FTRL-proximal over the rows in the order given.

    The bias has no L1 term. Features of fewer than ``MIN_TEXTS`` rows are passed over.
    """
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    l1 = np.full(size, L1)
    l1[-1] = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        return np.where(np.abs(own) <= l1[at], 0.0, -(own - np.sign(own) * l1[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    texts = np.zeros(size - 1, np.int32)
    for features in rows:
        texts[features] += 1
    rows = [features[texts[features] >= MIN_TEXTS] for features in rows]
    for _ in range(epochs):
        for features, label in zip(rows, labels, strict=True):
            at = np.append(features, size - 1)
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            rate = (np.sqrt(n[at] + gradient * gradient) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - rate * w
            n[at] += gradient * gradient
    every = weights(np.arange(size))
    kept = np.flatnonzero(every[:-1])
    return LinearModel(kept, every[kept].astype(np.float32), float(every[-1]))


def labelled_sample(docs: DataFrame, labels: DataFrame, *, id: str, text: str, label: str, sample: int) -> DataFrame:
    """(k, t, y): texts and labels 0 or 1 of about ``sample`` rows, by a hash ``k`` of their id.

    Rows without an id, a text or a label are not used; of several labels of
    one id the largest counts. The labels of the sample are bounded by
    ``sample`` and therefore broadcast.
    """
    known = labels.select(F.col(quoted(id)).alias("id"), F.col(quoted(label)).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    n = known.count()
    share = min(1.0, sample / max(n, 1))
    chosen = known.withColumn("k", F.xxhash64("id")).where(F.pmod("k", F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    own = docs.select(F.col(quoted(id)).alias("id"), F.col(quoted(text)).cast("string").alias("t")).where("t IS NOT NULL")
    return own.join(F.broadcast(chosen), "id").select("k", "t", "y")


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE
) -> LinearModel:
    """Learn from about ``sample`` labelled rows; without any the model gives 0.5 everywhere."""
    rows = labelled_sample(docs, labels, id=id, text=text, label=label, sample=sample)
    results = T.StructType([T.StructField("features", T.ArrayType(T.IntegerType()))])

    def worker():
        def featured(raw, offsets):
            found, cut = text_features(raw, offsets)
            return [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(found, pa.int32()))]

        return featured

    featured = map_text(rows, "t", results, worker, keep=["k", "y"])

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.assign(size=part["features"].map(len)).sort_values(["k", "y", "size"], kind="stable")
        model = ftrl([np.asarray(x, np.int64) for x in part["features"]], part["y"].tolist())
        return pd.DataFrame({"feature": np.append(model.features, -1), "weight": np.append(model.weights, model.bias).astype(float)})

    learned = featured.groupBy(F.lit(0).alias("all")).applyInPandas(learn, "feature long, weight double")
    # 2 ** BITS + 1 rows at most, sorted here: range partitions would make Spark learn twice
    got = sorted(learned.collect(), key=lambda r: r["feature"])
    if not got:
        return LinearModel(np.zeros(0, np.int64), np.zeros(0, np.float32), 0.0)
    features = np.array([r["feature"] for r in got[1:]], np.int64)
    return LinearModel(features, np.array([r["weight"] for r in got[1:]], np.float32), got[0]["weight"])


def score_toxicity(docs: DataFrame, model: LinearModel, *, text: str = "text", score: str = "score", keep: Sequence[str] | None = None) -> DataFrame:
    """Append the probability of each whole text; null and empty texts get that of the bias alone.

    Repeated rows get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def worker():
        model = shared.value
        dense = np.zeros(1 << BITS)
        dense[model.features] = model.weights

        def scored(raw, offsets):
            found, cut = text_features(raw, offsets)
            return [1 / (1 + np.exp(-np.clip(row_sums(dense[found], cut) + model.bias, -700, 700)))]

        return scored

    return map_text(docs, text, T.StructType([T.StructField(score, T.DoubleType())]), worker, keep=keep)


def with_decision(scored: DataFrame, held_out: Column, threshold: float, id: str = "doc_id") -> DataFrame:
    """(id, held_out, score, predicted)."""
    return scored.select(id, held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
