"""Reports with several counts of one log read it once."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from viewtally.operators.qos import qos_explode
from viewtally.sources.schemas import QOS_DOCUMENT


def scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


# the detail log of the test tables is itself a join of two files
@pytest.mark.parametrize(
    "name, most", [("live_categories", 2), ("search_funnel", 1), ("daily_activity_levels", 1), ("details_and_plays_per_period", 3)]
)
def test_each_log_is_read_once(spark, sf_dir, name, most):
    assert scans(queries()[name](spark, sf_dir)) <= most


def test_quality_rows_sort_no_log(spark, sf_dir):
    """The least player type is found among few rows; what holds a user is grouped by hash."""
    plan = queries()["quality_rows"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    sorted_ = [line for line in plan.splitlines() if "SortAggregate" in line]
    assert len(sorted_) == 2 and not any("userId" in line for line in sorted_)


def test_texts_without_a_whole_object_are_not_parsed(spark):
    texts = ["{", '{"userId":"u"', "", "[]", "null", "x", None, '{"userId":"u"} x', '{"userId":1}', '{"playRate":"x"}', '[{"userId":"a"']
    df = spark.createDataFrame([(t,) for t in texts], "jsonLog string")
    kept = qos_explode(df, broken="keep")
    assert "Contains(jsonLog" in kept._jdf.queryExecution().executedPlan().toString()
    parsed = F.from_json("jsonLog", QOS_DOCUMENT.replace("struct<", "struct<_broken:string,", 1), {"columnNameOfCorruptRecord": "_broken"})
    wanted = df.select(parsed.alias("d")).select(F.coalesce("d.userId", F.lit("")).alias("u"), F.expr("coalesce(d._broken is null and d is not null, false)").alias("ok"))
    got = kept.select("userId", F.col("playCode").isNull())
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))
    assert qos_explode(df).count() == wanted.where("ok").count()
