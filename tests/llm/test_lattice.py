import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewtally.llm import queries
from viewtally.llm.lattice import NEAR, Tables, near_duplicate_vectors, nearest_points

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.9):
    """(vec_id, n_links, component_id, kept) from all pairs."""
    fine = [i for i, (c, v) in enumerate(rows) if c is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(rows)
    for i, j in itertools.combinations(fine, 2):
        a, b = np.array(rows[i][1], np.float64), np.array(rows[j][1], np.float64)
        if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
            links[i] += 1
            links[j] += 1
            root[find(j)] = find(i)
    least = {}
    for i in fine:
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    out = []
    for i, (c, _) in enumerate(rows):
        component = least[find(i)] if i in set(fine) else c
        out.append((c, links[i], component, c == component))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(c, None if v is None else [None if x is None else float(x) for x in v], 1) for c, v in rows], SCHEMA)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def clusters(seed, sizes, dim=24, spread=0.15):
    rng = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        centre = rng.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            rows.append(np.float32(centre + spread * rng.standard_normal(dim) / np.sqrt(dim)).tolist())
    order = rng.permutation(len(rows)).tolist()
    return [(i * 3, rows[k]) for i, k in enumerate(order)]


def test_nearest_point_of_the_lattice():
    points = np.random.default_rng(1).normal(0, 2, (300, 8))
    got = nearest_points(points)
    doubled = (got * 2).astype(int)
    assert (np.ptp(doubled % 2, axis=1) == 0).all() and (got.sum(axis=1) % 2 == 0).all()  # points of the lattice
    around = got[:, None] + np.concatenate([NEAR, (NEAR[:, None] + NEAR[None]).reshape(-1, 8)])[None]
    assert (((points[:, None] - around) ** 2).sum(-1).min(axis=1) >= ((points - got) ** 2).sum(-1) - 1e-9).all()


def test_probed_cells_are_homes_of_the_nearest_neighbours():
    hashed = Tables(3, 2, 2.4, 4)
    unit = np.random.default_rng(2).standard_normal((50, 16))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    cells = hashed.cells(unit)
    assert cells.shape == (50, 3, 5)
    assert all(len(set(c)) == 5 for c in cells.reshape(-1, 5).tolist())
    moved = unit.copy()
    directions, _ = hashed._draw(16)
    points = (unit @ directions).reshape(50, 3, 2, 8)
    for n, t in itertools.product(range(50), range(3)):
        rests = points[n, t] - nearest_points(points[n, t])
        # a step towards the neighbour that is nearest in either block enters one of the probed cells
        block, near = np.unravel_index((rests @ NEAR.T).argmax(), (2, 240))
        target = points.reshape(50, -1)[n].copy()
        target[(t * 2 + block) * 8 : (t * 2 + block) * 8 + 8] = (points[n, t, block] - rests[block]) + NEAR[near]
        moved[n] = np.linalg.lstsq(directions.T, target, rcond=None)[0]
        if np.allclose(moved[n] @ directions, target):
            assert hashed.cells(moved[n : n + 1])[0, t, 0] in cells[n, t]


@pytest.mark.parametrize("slot", [4, 1024])
def test_links_and_components(spark, slot):
    rows = clusters(slot, [60, 25, 9, 3, 3, 2, *[1] * 60], spread=0.25)
    assert found(near_duplicate_vectors(frame(spark, rows), slot=slot, tables=12, probes=8)) == brute(rows)


def test_copies_scaled_copies_and_bad_vectors(spark):
    rows = clusters(3, [20, 1, 1], spread=0.1)
    rows += [(1000 + i, rows[0][1]) for i in range(40)]
    rows += [(2000 + i, [x * 10.0**i for x in rows[0][1]]) for i in range(5)]
    rows += [(7, None), (8, []), (10, [0.0] * 24), (11, [float("nan")] * 24), (13, [None, 1.0]), (14, [float("inf")] * 24), (None, rows[0][1])]
    rows += [(16, [1.0, 2.0]), (17, [2.0, 4.0]), (17, [2.0, 4.0]), (19, rows[1][1])]
    assert found(near_duplicate_vectors(frame(spark, rows), slot=8, tables=12, probes=8)) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert found(near_duplicate_vectors(frame(spark, []))) == []
    rows = clusters(4, [5, 1])
    df = frame(spark, rows).withColumns({"node": F.lit(1), "cell": F.lit("x"), "hash": F.lit(0), "a.b": F.lit(2)})
    assert found(near_duplicate_vectors(df, tables=12, probes=8)) == brute(rows)


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(400):  # pairs of a cosine of exactly 0.9 or a little more
        x, z = rng.standard_normal((2, 64))
        x /= np.linalg.norm(x)
        z -= (z @ x) * x
        rows += [(2 * i, x), (2 * i + 1, 0.901 * x + np.sqrt(1 - 0.901**2) * z / np.linalg.norm(z))]
    got = near_duplicate_vectors(frame(spark, rows)).agg(F.sum("n_links")).first()[0]
    assert 0.94 <= got / 800 <= 1


def test_query_links_what_all_pairs_link(spark, sf_dir):
    got = queries.op13_near_vectors(spark, sf_dir)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert found(got) == brute(rows)
