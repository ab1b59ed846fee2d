"""Top lists and running sums that no single task computes over a whole group."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from viewtally.operators import distributions, rankings
from viewtally.operators.distributions import threshold_curve
from viewtally.operators.rankings import topn_per_group


def ranked(rows, n):
    out = []
    for g in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == g]
        for r in own:
            place = 1 + sum((x[1] is not None) and (r[1] is None or x[1] > r[1]) for x in own)
            if place <= n:
                out.append((*r, place))
    return sorted(out, key=str)


def random_rows(seed, size=400):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "b", None]), rng.choice([None, 1, 2, 3, 5, 8, rng.randrange(100)]), i) for i in range(size)]


@pytest.mark.parametrize("n", [1, 3, 50, 1500])
def test_tied_ranks(spark, n):
    rows = random_rows(n) + [("tied", 7, 1000 + i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v int, id long")
    top = topn_per_group(df, ["g"], "v", n, ties="keep")
    assert top.columns == ["g", "v", "id", "rank"]
    assert sorted((tuple(r) for r in top.collect()), key=str) == ranked(rows, n)
    assert topn_per_group(df, ["g"], "v", n, ties="keep", rank=None).columns == ["g", "v", "id"]


def test_lists_longer_than_spark_limits(spark, monkeypatch):
    monkeypatch.setattr(rankings, "SPARK_LIMIT", 2)
    rows = [(g, v, i) for g, v, i in random_rows(5) if v is not None]
    top = topn_per_group(spark.createDataFrame(rows, "g string, v int, id long").repartition(7), ["g"], "v", 20, tie_break=["id"])
    want = []
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:20]
        want += [(*r, k) for k, r in enumerate(own, 1)]
    assert sorted((tuple(r) for r in top.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("by", [[], ["kind"]])
def test_curve_over_several_blocks(spark, monkeypatch, by):
    monkeypatch.setattr(distributions, "CURVE_BLOCK", 4)
    rng = random.Random(2)
    rows = [(f"u{u}", f"v{u % 3}", rng.choice(["x", "y", None])) for u in range(40) for _ in range(rng.randrange(1, 30))]
    got = threshold_curve(spark.createDataFrame(rows, "user string, video string, kind string"), ["user", "video"], by, user="user")
    want = []
    for kind in {r[2] for r in rows} if by else {()}:
        own = Counter((r[0], r[1]) for r in rows if not by or r[2] == kind)
        for n in set(own.values()):
            low = [k for k, c in own.items() if c <= n]
            head = (kind,) if by else ()
            want.append((*head, n, len({u for u, _ in low}), sum(own[k] for k in low), len({u for u, _ in own}), sum(own.values())))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert got.select(F.max("n")).first()[0] > 8
