"""A stream that ends gives the batch result; late rows are dropped."""

from pyspark.sql import functions as F

from viewtally.streaming.online import online_average, pv_uv_stream, start_day_sink

SCHEMA = "userId string, t string, online bigint"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).withColumn("datetime", F.to_timestamp("t")).drop("t")


def run(spark, tmp_path, batches, make):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    schema = frame(spark, []).schema
    for i, batch in enumerate(batches):
        frame(spark, batch).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        start_day_sink(make(stream), sink, str(tmp_path / "cp"), available_now=True).awaitTermination()
    return spark.read.parquet(sink)


EVENTS = [(f"u{i % 7}", f"2024-01-01 {10 + i // 30:02d}:{(i * 2) % 60:02d}:00", i) for i in range(120)]
CLOSE = [("z", "2024-01-03 00:00:00", 0)]  # moves the watermark past all windows


def before_close(df):
    return {tuple(r) for r in df.where(F.col("start") < "2024-01-02").collect()}


def test_online_average(spark, tmp_path):
    got = run(spark, tmp_path, [EVENTS, CLOSE, CLOSE], lambda s: online_average(s, "datetime"))
    assert before_close(got) == before_close(online_average(frame(spark, EVENTS), "datetime"))


def test_hourly_users(spark, tmp_path):
    got = run(spark, tmp_path, [EVENTS, CLOSE, CLOSE], lambda s: pv_uv_stream(s))
    assert before_close(got) == before_close(pv_uv_stream(frame(spark, EVENTS), exact=True))


def test_exact_users(spark, tmp_path):
    got = run(spark, tmp_path, [EVENTS, CLOSE, CLOSE], lambda s: pv_uv_stream(s, exact=True))
    assert before_close(got) == before_close(pv_uv_stream(frame(spark, EVENTS), exact=True))


def test_late_row_is_dropped(spark, tmp_path):
    late = [("late", "2024-01-01 10:00:00", 9)]
    got = run(spark, tmp_path, [EVENTS, CLOSE, late, CLOSE], lambda s: online_average(s, "datetime"))
    assert before_close(got) == before_close(online_average(frame(spark, EVENTS), "datetime"))
