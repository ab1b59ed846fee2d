"""Nearest vectors against all distances."""

import numpy as np
from pyspark.sql import functions as F

from viewtally.llm import nearest
from viewtally.llm.queries import QUERIES


def exact(rows, queries, k=10):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], float)
    out = {}
    for q in queries:
        distances = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((ids, distances)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(distances[i])) for i in order]
    return out


def told(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, wanted):
    return sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in wanted.items()) / sum(map(len, wanted.values()))


def test_query_recall_and_scores(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    wanted = exact(rows, [i for i, _ in rows if i % 100 == 0])
    got = told(QUERIES["op6_nearest_vectors"](spark, sf_dir))
    assert set(got) == set(wanted) and all(len(got[q]) == 10 for q in got)
    assert recall(got, wanted) >= 0.95
    vectors = dict(rows)
    for q, found in got.items():
        assert found == sorted(found, key=lambda x: (x[1], x[0]))
        for i, score in found:
            assert abs(score - np.linalg.norm(np.array(vectors[q], float) - np.array(vectors[i], float))) < 1e-12


def test_blocks_give_the_same_neighbours(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(16)]) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    wanted = exact(rows, range(0, 600, 20))
    for vector_rows, query_rows in ((10_000, 10_000), (150, 7)):
        got = told(nearest.nearest_vectors(frame, F.col("vec_id") % 20 == 0, vector_rows=vector_rows, query_rows=query_rows))
        assert recall(got, wanted) >= 0.95


def test_ties_copies_and_unusable_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(40)] + [(40, [1.0, 2.0, 3.5]), (41, None), (42, [0.0, 0.0, 0.0]), (43, [1.0, None, 3.0])]
    rows += [(44, [float("nan"), 1.0, 1.0]), (45, [float("inf"), 1.0, 1.0]), (46, [1.0, 2.0]), (None, same), (47, []), (5, same)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("mine"))
    got = told(nearest.nearest_vectors(frame, F.col("vec_id").isin(0, 5, 40, 41, 46)))
    assert [i for i, _ in got[0]] == list(range(1, 11))
    assert [i for i, _ in got[5]] == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert got[40] == [(i, 0.5) for i in range(10)]
    assert 41 not in got and 46 not in got
    few = told(nearest.nearest_vectors(frame.where("vec_id IN (0, 40)"), F.col("vec_id") == 0))
    assert few == {0: [(40, 0.5)]}
    assert nearest.nearest_vectors(frame.where("vec_id < 0"), F.col("vec_id") == 0).count() == 0
