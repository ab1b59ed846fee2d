"""Quality of texts by a vote of the nearest labelled texts in a latent space.

A text becomes counts of hashed terms: groups of three bytes, groups of three
kinds of bytes (upper and lower case, digit, mark, space), kinds of whole
words, and words that repeat the one before (counted ``REPEAT`` times, since
their letters look like those of any text). Counts are damped, weighted by
rarity, and projected on the strongest singular directions of a labelled sample.
The vectors of that sample are broadcast; every text is compared with all of
them by exact cosine products, a block of texts at a time, and its nearest
neighbours vote with their similarity.

The sample has about ``SAMPLE`` texts of each label, so the broadcast holds
``2 * SAMPLE`` short vectors and the ``DIMENSIONS`` directions, whatever the
corpus. A neighbour's vote counts as much as the rows of its label that it
stands for.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtally.llm.textarrays import LOWER, map_text, mix, quoted, span_hashes, words

TERMS = 2048
DIMENSIONS = 48
SAMPLE = 1200
NEIGHBOURS = 25
REPEAT = 10

_KIND = np.full(256, 3, np.uint8)
_KIND[ord("a") : ord("z") + 1] = 0
_KIND[128:] = 0
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2
_KIND[[9, 10, 13, 32]] = 4


@dataclass
class LatentModel:
    rarity: np.ndarray  # of each term
    directions: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # labelled texts x dimensions, of length one
    labels: np.ndarray
    weights: np.ndarray  # of each label's votes


def term_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of term counts for each text of a chunk."""
    n = len(offsets) - 1
    rows = np.repeat(np.arange(n), np.diff(offsets))
    found, owners = [], []
    for salt, symbols in ((1, raw), (2, _KIND[raw])):
        wide = symbols.astype(np.uint64)
        groups = wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:]
        inside = rows[:-2] == rows[2:]
        found.append(groups[inside] | np.uint64(salt << 32))
        owners.append(rows[:-2][inside])
    starts, ends, own = words(raw, offsets)
    hashes = span_hashes(LOWER[raw], starts, ends)
    again = (hashes[1:] == hashes[:-1]) & (own[1:] == own[:-1])
    found.append(np.full(REPEAT * int(again.sum()), 3 << 32, np.uint64))
    owners.append(np.repeat(own[1:][again], REPEAT))
    first = _KIND[raw[starts]].astype(np.uint64) << np.uint64(8) | _KIND[raw[ends - 1]]
    found.append(first | np.minimum(ends - starts, 20).astype(np.uint64) << np.uint64(16) | np.uint64(4 << 32))
    owners.append(own)
    at = np.concatenate(owners) * TERMS + (mix(np.concatenate(found)) % np.uint64(TERMS)).astype(np.int64)
    return np.bincount(at, minlength=n * TERMS).reshape(n, TERMS).astype(np.float32)


def _damped(counts: np.ndarray) -> np.ndarray:
    """Shares of the terms, with square roots to keep frequent ones from ruling."""
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def build(counts: np.ndarray, labels: np.ndarray, population: np.ndarray) -> LatentModel | None:
    """The model of some labelled rows; ``population`` has the rows of each label that they stand for."""
    if not len(labels):
        return None
    damped = _damped(counts)
    seen = (counts > 0).sum(axis=0)
    rarity = np.log((1 + len(labels)) / (1 + seen)) + 1
    weighted = (damped * rarity).astype(np.float64)
    values, vectors = np.linalg.eigh(weighted.T @ weighted)
    directions = vectors[:, np.argsort(-values, kind="stable")[:DIMENSIONS]]
    present = np.bincount(labels, minlength=2)
    return LatentModel(rarity, directions, _unit(weighted @ directions), labels, population / np.maximum(present, 1))


def fit_quality(
    docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> LatentModel | None:
    """Learn from about ``sample`` rows of each label; without any the model is None.

    Rows without an id, a text or a label of 0 or 1 are not used; of several
    labels of one id the largest counts. Where ids repeat in ``docs``, the first
    four times ``sample`` texts by hash of the id are learned from.
    """
    known = labels.select(F.col(quoted(id)).alias("id"), F.col(quoted(label)).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    sizes = dict(known.groupBy("y").count().collect())
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for y, n in sizes.items() for x in (y, min(1.0, sample / n))])
    chosen = known.withColumn("k", F.xxhash64("id")).where(F.pmod("k", F.lit(1 << 30)) / F.lit(float(1 << 30)) < share[F.col("y")])
    own = docs.select(F.col(quoted(id)).alias("id"), F.col(quoted(text)).cast("string").alias("t")).where("t IS NOT NULL")
    rows = own.join(F.broadcast(chosen), "id").select("k", "t", "y")
    results = T.StructType([T.StructField("c", T.BinaryType())])

    def worker():
        return lambda raw, offsets: [[row.tobytes() for row in term_counts(raw, offsets)]]

    got = map_text(rows, "t", results, worker, keep=["k", "y"]).orderBy("k", "c").limit(4 * sample).collect()
    counts = np.frombuffer(b"".join(r["c"] for r in got), np.float32).reshape(len(got), TERMS)
    population = np.array([sizes.get(y, 0) for y in (0, 1)], np.float64)
    return build(counts, np.array([r["y"] for r in got], np.int64), population)


def score_quality(
    docs: DataFrame, model: LatentModel | None, *, text: str = "text", score: str = "score", neighbours: int = NEIGHBOURS, keep: Sequence[str] | None = None
) -> DataFrame:
    """Append the weighted share of label 1 among the nearest labelled texts of each whole text.

    A text without terms (null, empty, too short) is as near to all of them and
    gets the share of label 1 in what the model stands for; without a model
    every score is 0.5. Among equally near texts all at the edge vote. Repeated
    rows get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def worker():
        model = shared.value

        def scored(raw, offsets):
            if model is None:
                return [np.full(len(offsets) - 1, 0.5)]
            vectors = _unit((_damped(term_counts(raw, offsets)) * model.rarity) @ model.directions)
            near = np.round(vectors @ model.vectors.T, 6)
            k = min(neighbours, near.shape[1])
            edge = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
            votes = np.where(near >= edge[:, None], np.maximum(near, 1e-6), 0.0) * model.weights[model.labels]
            return [(votes * model.labels).sum(axis=1) / votes.sum(axis=1)]

        return scored

    return map_text(docs, text, T.StructType([T.StructField(score, T.DoubleType())]), worker, keep=keep)
