"""Approximate nearest neighbours by collision counting.

Each of ``projections`` random directions keeps the projected vectors of a block
sorted. A query looks at the window around its own projection; the windows widen
step by step (virtual rehashing: the same arrays serve every width). A vector
inside at least ``threshold`` of the windows is verified: its exact distance is
computed. With a window of ``width`` times the radius, vectors within the radius
pass the threshold in some 19 of 20 cases, and a query ends once its k-th
verified distance is no more than the radius.

Vectors and queries are cut into blocks, and every pair of a vector block and a
query block is one task; the k best of each are merged. Of equal vectors only
the k + 1 smallest ids are indexed, because others cannot be among the k nearest
of any query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtally.llm.textarrays import quoted

K = 10
PROJECTIONS = 96
THRESHOLD = 0.7
WIDTH = 2.45
GROWTH = 1.3
VECTOR_ROWS = 20_000
QUERY_ROWS = 4_000
SEED = 7


class Index:
    """Sorted projections of the rows of a matrix."""

    def __init__(self, vectors: np.ndarray, projections: int):
        self.vectors = vectors
        directions = np.random.default_rng(SEED).standard_normal((vectors.shape[1], projections))
        self.directions = directions
        projected = (vectors @ directions).T
        self.order = np.argsort(projected, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(projected, self.order, axis=1)

    def nearest(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances of the verified vectors; ``own`` (-1: none) is left out."""
        n = len(self.vectors)
        at = query @ self.directions
        lows, highs, radii = self._windows(at, k)
        hits = np.zeros(n, np.int32)
        wanted = np.ceil(THRESHOLD * len(at))
        open_ = np.ones(n, bool)
        if own >= 0:
            open_[own] = False
        rows, distances = np.zeros(0, np.int64), np.zeros(0)
        before_low = before_high = None
        for level, radius in enumerate(radii):
            low, high = lows[:, level], highs[:, level]
            if before_low is None:
                parts = [o[a:b] for o, a, b in zip(self.order, low, high, strict=True)]
            else:
                parts = [o[a:b] for o, a, b in zip(self.order, low, before_low, strict=True)]
                parts += [o[a:b] for o, a, b in zip(self.order, before_high, high, strict=True)]
            before_low, before_high = low, high
            hits += np.bincount(np.concatenate(parts), minlength=n).astype(np.int32)
            new = np.flatnonzero(open_ & (hits >= wanted))
            if len(new):
                open_[new] = False
                rows = np.concatenate([rows, new])
                distances = np.concatenate([distances, np.sqrt(((self.vectors[new] - query) ** 2).sum(axis=1))])
            if len(rows) >= k and np.partition(distances, k - 1)[k - 1] <= radius:
                break
        return rows, distances

    def _windows(self, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window bounds of each projection for growing radii; the last window holds everything."""
        far = max(float(np.abs(self.values[:, [0, -1]] - at[:, None]).max()), 1e-300)
        near = max(far * 1e-3, 1e-300)
        steps = int(np.ceil(np.log(far / near) / np.log(GROWTH))) + 1
        half = near * GROWTH ** np.arange(steps)
        half = np.append(half, max(half[-1], far) * 2)
        lows = np.stack([np.searchsorted(v, x - half, "left") for v, x in zip(self.values, at, strict=True)])
        highs = np.stack([np.searchsorted(v, x + half, "right") for v, x in zip(self.values, at, strict=True)])
        return lows, highs, np.append(half[:-1] * 2 / WIDTH, np.inf)


def usable(vector: Column) -> Column:
    """No null, no null or non-finite component, not empty and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest_vectors(
    vectors: DataFrame,
    is_query: Column,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    projections: int = PROJECTIONS,
    vector_rows: int = VECTOR_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest vectors found for each query, by Euclidean distance.

    Queries are the rows that ``is_query`` names; a query never finds its own
    row. Ties go to the smaller id. Rows without an id or a usable vector take no
    part; vectors of another length than the query's are no candidates. Repeated
    rows of one id count once.
    """
    own = vectors.select(
        F.col(quoted(id)).cast("long").alias("id"), F.col(quoted(vector)).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("q"),
    ).where(F.col("id").isNotNull() & usable(F.col("v")))
    own = own.groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q")).withColumn("d", F.size("v"))
    same = W.partitionBy(F.xxhash64("v"), "v").orderBy("id")
    rows = own.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1).select("id", "v", "d")
    queries = own.where("q").select("id", "v", "d")
    parts = max(1, -(-own.count() // vector_rows))
    askers = max(1, -(-queries.count() // query_rows))

    def dealt(df: DataFrame, own_parts: int, other_parts: int, names: tuple[str, str]) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.lit(own_parts)).cast("int").alias(names[0])
        return df.select("*", block, F.explode(F.sequence(F.lit(0), F.lit(other_parts - 1))).alias(names[1]))

    left = dealt(rows, parts, askers, ("part", "asker"))
    right = dealt(queries, askers, parts, ("asker", "part"))
    schema = T.StructType(
        [T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())]
    )

    def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            rows = rows.sort_values("id", kind="stable")
            ids = rows["id"].to_numpy()
            index = Index(np.stack(rows["v"].to_numpy()).astype(np.float64), projections)
            for query, v in zip(queries["id"], queries["v"], strict=True):
                at = int(np.searchsorted(ids, query))
                at = at if at < len(ids) and ids[at] == query else -1
                found, distances = index.nearest(np.asarray(v, np.float64), at, k)
                best = np.lexsort((ids[found], distances))[:k]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[found[best]], "score": distances[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    keys = ["part", "asker", "d"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, schema)
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
