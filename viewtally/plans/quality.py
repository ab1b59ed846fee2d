"""Play quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.counts import pv_uv
from ..operators.enrich import dim_enrich
from ..operators.qos import qos_codes, qos_explode, qos_outcome, qos_topn
from .registry import report


def tries(t):
    """One row per try; unreadable documents are gone."""
    return qos_explode(t.qos, keep=("day", "apkVersion", "datetime"))


@report("codes_per_day", "Q1")
def per_day(t):
    return qos_codes(qos_explode(t.qos, broken="keep", keep=("day",)), ["day", "playCode"])


@report("codes_per_video_and_source", "Q2", "J10")
def per_video(t):
    return qos_codes(
        tries(t), ["videoSid", "videoSource", "playCode"],
        {"source_total": ["videoSid", "videoSource"], "total": []},
    )


@report("codes_per_source", "Q3")
def per_source(t):
    return qos_codes(tries(t), ["videoSource", "playCode"], {"source_total": ["videoSource"], "total": []})


@report("codes_per_source_and_type", "Q4")
def per_type(t):
    return qos_codes(tries(t), ["videoSource", "playCode", "contentType"], {"source_total": ["videoSource", "contentType"]})


@report("codes_per_video_with_title", "Q5")
def with_title(t):
    counted = qos_codes(
        tries(t), ["videoSid", "videoSource", "playCode", "contentType"], {"source_total": ["videoSid", "videoSource", "contentType"]}
    )
    return dim_enrich(counted, t.program, {"videoSid": "sid"}, {"title": "title"}, default=F.col("videoSid"))


@report("codes_of_top_videos", "Q6", "W4")
def top_videos(t):
    plays = pv_uv(t.play3, ["contentType", "videoSid"], where=F.col("event") == "startplay")
    return qos_topn(
        tries(t), plays, ["contentType"], "videoSid", ["contentType", "videoSid", "videoSource", "playCode"], "pv", 5,
        {"source_total": ["videoSid", "videoSource"]},
    )


@report("codes_of_top_episodes", "Q7", "W1")
def top_episodes(t):
    plays = pv_uv(t.play3, ["contentType", "episodeSid"], where=F.col("event") == "startplay")
    return qos_topn(
        tries(t), plays, ["contentType"], "episodeSid", ["contentType", "episodeSid", "playCode"], "pv", 3, ties="keep"
    )


@report("failures_of_top_episodes", "Q8", "W5")
def top_failures(t):
    rows = tries(t)
    ranked = rows.groupBy("videoSource", "episodeSid").agg(F.count(F.lit(1)).alias("tries"))
    failed = rows.where(F.col("playCode") != 200)
    return qos_topn(failed, ranked, ["videoSource"], "episodeSid", ["videoSource", "episodeSid", "playCode"], "tries", 5)


@report("codes_of_listed_videos", "Q9")
def listed_videos(t):
    return qos_codes(tries(t).where(F.col("videoSid").isin("v1", "v5", "v8")), ["videoSid", "playCode"])


@report("users_of_listed_videos", "Q10")
def listed_users(t):
    return pv_uv(tries(t).where(F.col("videoSid").isin("v1", "v5", "v8")), [], uv="users").select("users")


@report("quality_users_per_version", "Q11")
def per_version(t):
    return pv_uv(tries(t), ["playCode", "apkVersion"], null_user="count").drop("pv")


@report("play_users_per_version", "Q12")
def play_users(t):
    return pv_uv(t.play3, ["apkVersion"], null_user="count").drop("pv")


@report("sources_per_content_class", "Q13")
def content_class(t):
    kind = F.when(F.col("contentType").isin("movie", "tv", "zongyi", "comic", "jilu", "kids"), "long").when(
        F.col("contentType").isin("hot", "xiqu", "mv"), "short"
    ).otherwise("others")
    return pv_uv(tries(t).withColumn("content_class", kind), ["content_class", "videoSource"], null_user="count")


@report("outcomes_by_hour", "Q14", "A17")
def outcomes(t):
    return qos_outcome(tries(t).where(F.col("videoSource") == "s1"), [F.hour("datetime").alias("hour")])


@report("codes_of_two_days", "Q15")
def two_days(t):
    picked = tries(t).where(F.col("day").isin([F.lit(d).cast("date") for d in ("2024-01-05", "2024-01-06")]))
    return qos_codes(picked, ["videoSid", "videoSource", "day", "playCode"])
