"""Distributions and data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.counts import pv_uv
from ..operators.distributions import count_histogram, event_gaps, threshold_curve
from ..operators.rollout import variants_per_key
from .registry import report


def major():
    return S.major_version("apkVersion").alias("version")


def _starts(t):
    return t.play.where(F.col("event").isin("startplay", "playview"))


@report("plays_per_user_and_video", "D1", "A4")
def plays(t):
    return count_histogram(_starts(t), ["userId", "videoSid"], [major()], total="total")


@report("plays_per_user_and_video_by_type", "D2")
def plays_by_type(t):
    return count_histogram(_starts(t), ["userId", "videoSid"], ["contentType", major()], total="total")


@report("play_threshold_curve", "D3", "A7")
def curve(t):
    return threshold_curve(_starts(t), ["userId", "videoSid"], [major()], user="userId")


@report("play_threshold_curve_by_type", "D4", "A7")
def curve_by_type(t):
    return threshold_curve(_starts(t), ["userId", "videoSid"], ["contentType", major()], user="userId")


@report("long_watch_sums", "D5")
def long_sums(t):
    watched = t.play.where(F.col("duration").isNotNull() & (F.col("event") != "startplay"))
    return count_histogram(
        watched, ["userId", "videoSid"], ["contentType", major()], value=F.sum("duration"), having=F.col("_n") > 10800,
        n="duration", total="total",
    )


def _spread(log, unit):
    units = log.where(F.col("duration") >= 0).groupBy(S.duration_in("duration", unit).alias("duration")).agg(F.count(F.lit(1)).alias("n"))
    return units.withColumn("total", units.agg(F.sum("n").alias("s")).scalar())


@report("vod_duration_spread", "D6", "J10")
def vod(t):
    return _spread(t.play.where(F.col("event") != "startplay"), "m")


@report("live_duration_spread", "D7")
def live(t):
    return _spread(t.livelog, "q")


@report("use_duration_spread", "D8")
def use(t):
    return _spread(t.home, "h")


@report("on_duration_by_version", "D9")
def on_duration(t):
    return pv_uv(t.home, [major(), S.duration_in("duration", "m").alias("duration")])


@report("enter_times_by_version", "D9")
def enter_times(t):
    return count_histogram(t.home, "userId", ["day", major()], n="times")


@report("pseudo_users", "D10", "J9")
def pseudo_users(t):
    parts = ["apkVersion", "productModel", "promotionChannel"]
    combos = t.play.where(F.col("userId").isNotNull()).select("userId", F.concat_ws("/", *parts).alias("combination")).distinct()
    several = combos.groupBy("userId").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("userId")
    hit = combos.join(several, "userId", "left_semi").groupBy("combination").agg(F.count(F.lit(1)).alias("n"))
    return hit.withColumn("total", several.agg(F.count(F.lit(1)).alias("c")).scalar())


@report("combinations_per_user", "D11")
def combinations(t):
    return variants_per_key(t.play, "userId", ["apkVersion", "productModel", "promotionChannel"])


@report("names_per_video", "D12")
def names(t):
    return variants_per_key(t.play.where(F.col("videoName").isNotNull()), "videoSid", ["videoName"])


@report("plays_of_ambiguous_videos", "D13")
def ambiguous(t):
    several = names(t).where(F.col("n") > 1).select("videoSid")
    return t.play.join(several, "videoSid", "left_semi").agg(F.count(F.lit(1)).alias("n"))


@report("gaps_of_same_video", "D14", "W6")
def gaps(t):
    known = t.play.where(F.col("userId").isNotNull())
    between = event_gaps(known, ["userId", "videoSid"], "datetime")
    return between.groupBy("gap_seconds").agg(F.sum("times").alias("n"))


@report("counts_of_any_key", "D15")
def any_key(t):
    return pv_uv(t.play, ["episodeSid", "flag"], null_user="count")
