"""Periods and levels by bits and by user against plain counts of distinct users."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from viewtally.functions.periods import PERIODS, period_label
from viewtally.operators.rollups import period_rollup, rollup_all


def log(spark, n=600):
    """Days around turns of month and year, some rows without day, user or key."""
    rng = random.Random(3)
    starts = [date(2023, 1, 28), date(2023, 12, 27), date(2024, 2, 26), date(2024, 1, 1)]
    rows = [
        (
            rng.choice([None, "a", "b"]), rng.choice([None, *[f"u{i}" for i in range(9)]]),
            None if rng.random() < 0.05 else rng.choice(starts) + timedelta(rng.randrange(9)),
            rng.choice([None, 1, 2, 30]), rng.choice([None, True, False]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "k string, userId string, day date, seconds bigint, good boolean")


def same(got, wanted):
    assert got.columns == wanted.columns
    key = lambda rows: sorted(map(str, rows))
    assert key(got.collect()) == key(wanted.collect())


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_periods_equal_distinct_users(spark, keys):
    df = log(spark)
    got = period_rollup(df, "day", "userId", PERIODS, keys, sums={"seconds": F.col("seconds")}, users={"good_users": F.col("good")})
    wanted = None
    for p in PERIODS:
        counted = df.groupBy(F.lit(p).alias("period"), period_label("day", p).alias("start"), *keys).agg(
            F.count("userId").alias("pv"), F.count_distinct("userId").alias("uv"), F.sum("seconds").alias("seconds"),
            F.count_distinct(F.when(F.col("good"), F.col("userId"))).alias("good_users"),
        )
        wanted = counted if wanted is None else wanted.unionAll(counted)
    same(got, wanted)


def rows_shuffled(df):
    """Rows that the exchanges of a plan that has run have written, by stage."""
    plan, found, left = df._jdf.queryExecution().executedPlan(), [], []
    left.append(plan)
    while left:
        node = left.pop()
        name = node.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        if name == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            left.append(node.plan())
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return found


def test_days_of_a_user_are_one_row(spark):
    """31 days of each of 2,000 users: a row a user and task leaves a shuffle, not one for each day."""
    df = spark.range(0, 2000 * 31, 1, 4).select((F.col("id") % 2000).cast("string").alias("userId"), F.expr("date_add(date'2024-01-01', cast(floor(id / 2000) as int))").alias("day"))
    counted = period_rollup(df, "day", "userId", ["day", "week", "month"])
    assert len(counted.collect()) == 31 + 5 + 1
    assert max(rows_shuffled(counted)) <= 2 * 4 * 2000


@pytest.mark.parametrize("levels", [[[], ["k"], ["k", "day"]], [["k"], ["day"]], [["k", "day"]], [["k"]]])
def test_levels_equal_distinct_users(spark, levels):
    df = log(spark)
    got = rollup_all(df, levels, "userId", sums={"seconds": F.col("seconds")})
    finest = list(dict.fromkeys(c for level in levels for c in level))
    named = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in finest})
    wanted = None
    for level in levels:
        keyed = [(F.col(c) if c in level else F.lit("All")).alias(c) for c in finest]
        counted = named.groupBy(*keyed).agg(F.count("*").alias("pv"), F.count_distinct("userId").alias("uv"), F.sum("seconds").alias("seconds"))
        wanted = counted if wanted is None else wanted.unionAll(counted)
    same(got, wanted)


def test_repeated_rows_of_levels_are_not_shuffled(spark):
    """All pairs of 300 users and 40 keys: no shuffle writes more than these pairs."""
    df = spark.range(0, 300 * 40, 1, 1).select((F.col("id") % 300).cast("string").alias("userId"), F.expr("cast(floor(id / 300) as string)").alias("k"), F.expr("cast(id % 300 % 7 as string)").alias("j"))
    counted = rollup_all(df, [[], ["j"], ["j", "k"]], "userId")
    assert len(counted.collect()) == 1 + 7 + 7 * 40
    assert max(rows_shuffled(counted)) <= 300 * 40
