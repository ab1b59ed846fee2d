"""Reports that also run on a stream; here on the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming.online import online_average, pv_uv_stream
from .registry import report


@report("online_five_minutes", "ST1")
def online(t):
    samples = t.login.select(F.date_trunc("second", "datetime").alias("ts"), F.col("k").alias("online"))
    return online_average(samples)


@report("hourly_counts_as_stream", "ST2")
def hourly(t):
    return pv_uv_stream(t.login.select("userId", "datetime", "log_type"), ["log_type"], exact=True)
