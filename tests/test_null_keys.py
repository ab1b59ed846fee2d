"""Rows with null keys are spread over the partitions of a join."""

from pyspark.sql import functions as F

from viewtally.operators._keys import left_join_known
from viewtally.operators.enrich import dim_enrich


def test_null_keys_do_not_meet_in_one_partition(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        fact = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 70).alias("k"))
        side = spark.range(0, 70, 10).select(F.col("id").alias("k"), F.lit("x").alias("v"))
        joined = left_join_known(fact, side, ["k"])
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert joined.count() == 4000 and joined.where("v IS NOT NULL").count() == 400
        assert len(sizes) == 8 and max(sizes) < 2 * 4000 / 8, sizes
        dim = side.withColumnRenamed("k", "code")
        out = dim_enrich(fact, dim, {"k": "code"}, {"label": "v"}, default="none")
        assert out.groupBy("label").count().orderBy("label").collect() == [("none", 3600), ("x", 400)]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
