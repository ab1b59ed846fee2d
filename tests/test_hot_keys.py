"""Rows of frequent keys are spread over the partitions of a join."""

import pytest
from pyspark.sql import functions as F

from viewtally.operators._keys import hot_keys, left_join_known, left_join_spread
from viewtally.operators.enrich import dim_enrich

ROWS = 20000


@pytest.fixture
def shuffled(spark):
    """Shuffled joins whose partitions nothing splits afterwards."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in keep.items():
        spark.conf.set(k, v)


def frames(spark):
    # 60 % of all rows on one key, 10 % without a key, the rest on rare ones
    part = F.col("id") % 10
    key = F.when(part < 6, F.lit(-1)).when(part < 9, F.col("id"))
    fact = spark.range(ROWS).select("id", (F.col("id") * 7).alias("other"), key.alias("k"))
    side = spark.range(-1, ROWS, 2).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    return fact, side


def largest(df):
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    return max(sizes)


def test_one_key_with_most_rows_is_split(shuffled):
    fact, side = frames(shuffled)
    assert [r["k"] for r in hot_keys(fact, ["k"]).collect()] == [-1]
    share = ROWS / 8
    assert largest(left_join_known(fact, side, ["k"])) > 4 * share
    spread = left_join_spread(fact, side, ["k"])
    assert largest(spread) < 1.5 * share
    assert sorted(map(str, spread.select("id", "k", "v").collect())) == sorted(map(str, left_join_known(fact, side, ["k"]).select("id", "k", "v").collect()))


def test_enrich_spread_equals_plain(shuffled):
    fact, side = frames(shuffled)
    dim = side.withColumnRenamed("k", "code")
    plain = dim_enrich(fact, dim, {"k": "code"}, {"label": "v"}, default="none")
    spread = dim_enrich(fact, dim, {"k": "code"}, {"label": "v"}, default="none", spread=True)
    assert spread.columns == plain.columns
    assert plain.exceptAll(spread).count() == 0 and spread.count() == ROWS


def test_odd_inputs(shuffled):
    fact, side = frames(shuffled)
    assert left_join_spread(fact.limit(0), side, ["k"]).count() == 0
    assert left_join_spread(fact, side.limit(0), ["k"]).where("v IS NULL").count() == ROWS
    only_keys = fact.select("k")
    assert left_join_spread(only_keys, side, ["k"]).count() == ROWS
    nulls = fact.withColumn("k", F.lit(None).cast("long"))
    assert left_join_spread(nulls, side, ["k"]).where("v IS NULL").count() == ROWS
