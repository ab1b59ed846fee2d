"""Counters that run on a stream as well as on a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators._keys import as_list, Key


def _watermarked(df: DataFrame, ts: str, late: str) -> DataFrame:
    return df.withWatermark(ts, late) if df.isStreaming else df


def online_average(
    samples: DataFrame, ts: str = "ts", value: str = "online", every: str = "5 minutes", late: str = "10 minutes",
    keys: Key | Sequence[Key] = (),
) -> DataFrame:
    """Mean of the online samples per tumbling window: (start, end, average, samples)."""
    grouped = _watermarked(samples, ts, late).groupBy(F.window(ts, every), *as_list(keys))
    out = grouped.agg(F.avg(value).alias("average"), F.count(value).alias("samples"))
    rest = [c for c in out.columns if c not in ("window", "average", "samples")]
    return out.select(
        F.col("window.start").alias("start"), F.col("window.end").alias("end"), *rest, "average", "samples"
    )


def pv_uv_stream(
    events: DataFrame,
    keys: Sequence[str] = (),
    user: str = "userId",
    ts: str = "datetime",
    every: str = "1 hour",
    late: str = "2 hours",
    exact: bool = False,
    error: float = 0.01,
) -> DataFrame:
    """Plays and users per window: (start, keys, pv, uv).

    State per window is one sketch by default. ``exact=True`` counts exactly,
    the same on a stream as on a table (``exact_counts``).
    """
    if exact:
        return exact_counts(events, keys, user, ts, every, late)
    watermarked = _watermarked(events, ts, late)
    users = F.approx_count_distinct(user, error)
    out = watermarked.groupBy(F.window(ts, every), *keys).agg(F.count(user).alias("pv"), users.alias("uv"))
    return out.select(F.col("window.start").alias("start"), *keys, "pv", "uv")


def exact_counts(
    events: DataFrame, keys: Sequence[str] = (), user: str = "userId", ts: str = "datetime", every: str = "1 hour", late: str = "2 hours"
) -> DataFrame:
    """Exact plays and users per window: (start, keys, pv, uv).

    Two aggregations one after the other, both with state: plays per window,
    keys and user, then plays and users per window and keys. A window leaves the
    first when the watermark has passed its end, and then the second, so the
    state is one number for each user of an open window, spread over tasks by
    user as well. Rows later than ``late`` are dropped, as any watermark does.
    Rows without a user count in neither number, but their window appears.
    """
    per_user = _watermarked(events, ts, late).groupBy(F.window(ts, every), *keys, F.col(user).alias("_user")).agg(F.count(F.lit(1)).alias("_n"))
    named = F.col("_user").isNotNull()
    out = per_user.groupBy("window", *keys).agg(
        F.coalesce(F.sum(F.when(named, F.col("_n"))), F.lit(0)).cast("bigint").alias("pv"), F.count_if(named).alias("uv")
    )
    return out.select(F.col("window.start").alias("start"), *keys, "pv", "uv")


def start_day_sink(stream: DataFrame, path: str, checkpoint: str, day: str = "day", available_now: bool = False) -> StreamingQuery:
    """Append finished windows to a table partitioned by day, exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(day) if day in stream.columns else writer
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
