"""Live channels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.counts import funnel_join, pv_uv, pv_uv_duration, users_where
from ..operators.enrich import dim_enrich
from ..operators.live import occupancy
from ..operators.qos import qos_codes
from ..operators.rankings import topn_per_group
from ..operators.rollups import period_rollup
from .quality import tries
from .registry import report


def _live(t):
    return t.livelog.where(F.col("liveType") == "live")


def _is_start():
    return F.col("event") == "startplay"


@report("carousel_totals", "L1")
def carousel(t):
    out = pv_uv_duration(_live(t).where(F.col("sourceType") == "carousel"), ["day"], low=0, high=36000)
    return out.withColumn("plays_per_user", F.col("pv") / F.nullif("uv", F.lit(0))).withColumn(
        "minutes_per_user", F.col("duration") / 60 / F.nullif("uv", F.lit(0))
    )


def _top(name, row, source, order):
    @report(name, row, "W3")
    def run(t):
        counted = pv_uv(_live(t).where((F.col("sourceType") == source) & _is_start()), [F.col("channelSid").alias("channel")])
        return topn_per_group(counted, [], order, 10, tie_break=["channel"])


_top("top_carousel_by_users", "L1", "carousel", "uv")
_top("top_carousel_by_plays", "L1", "carousel", "pv")
_top("top_telecast_by_users", "L4", "telecast", "uv")
_top("top_telecast_by_plays", "L4", "telecast", "pv")
_top("top_webcast_by_users", "L5", "webcast", "uv")
_top("top_webcast_by_plays", "L5", "webcast", "pv")


@report("carousel_subscriptions", "L2")
def subscriptions(t):
    return pv_uv(t.livelog, ["day"], where=(F.col("sourceType") == "carousel") & (F.col("liveType") == "vod"))


@report("carousel_switches", "L3")
def switches(t):
    return pv_uv(t.livelog, ["day"], where=(F.col("sourceType") == "carousel") & (F.col("event") == "switchchannel"))


@report("webcast_tree", "L6")
def webcast_tree(t):
    tree = F.substring_index("pathMain", "*", -1).alias("tree")
    return pv_uv_duration(_live(t).where(F.col("sourceType") == "webcast"), [tree], low=0, high=36000, dur_users="dur_users")


@report("live_categories", "L7", "J2")
def categories(t):
    named = dim_enrich(_live(t), t.livemenu, {"liveMenuCode": "menu_code"}, {"category": "menu_name"}, default="other")
    play, view, known = _is_start(), F.col("event") == "switchchannel", F.col("userId").isNotNull()
    counted = users_where(
        named, ["day", "category"], {"play_user": play, "view_user": view},
        rows={"play_num": play & known, "view_num": view & known, "starts": play},
        sums={"duration": F.when(F.col("duration").between(0, 36000), F.col("duration"))},
    )
    return counted.where("starts > 0").drop("starts")


@report("live_channels", "L8")
def channels(t):
    named = dim_enrich(_live(t), t.livemenu, {"liveMenuCode": "menu_code"}, {"category": "menu_name"}, default="other")
    watched = F.col("event") == "switchchannel"
    return pv_uv_duration(named, ["day", "sourceType", "category", "channelSid"], dur_rows=watched, low=10, high=36000)


@report("live_starts_per_minute", "L9")
def per_minute(t):
    return pv_uv(_live(t), ["channelSid", F.date_trunc("minute", "datetime").alias("minute")], where=_is_start(), uv="users")


@report("live_occupancy", "L10", "U46")
def live_occupancy(t):
    watched = _live(t).where(F.col("event") == "switchchannel")
    return occupancy(watched, "datetime", "duration", ["sourceType", "channelSid"], low=10, high=36000)


@report("live_source_types", "L11", "J1")
def source_types(t):
    plays = pv_uv_duration(_live(t), ["day", "sourceType"], low=0, high=36000, dur_users="dur_users")
    switched = pv_uv(_live(t), ["day", "sourceType"], where=F.col("event") == "switchchannel", uv="uv_switch").drop("pv")
    return funnel_join([plays, switched], ["day", "sourceType"], how="left")


@report("live_source_types_by_hour", "L12", "A16")
def by_hour(t):
    return pv_uv(_live(t), [F.hour("datetime").alias("hour"), "sourceType"], where=_is_start()).drop("pv")


@report("live_per_period", "L13")
def per_period(t):
    viewed = _live(t).where(F.col("duration").isNull() | F.col("duration").between(0, 54000))
    return period_rollup(viewed, "day", "userId", sums={"duration": F.col("duration")})


@report("live_quality_codes", "L14")
def quality_codes(t):
    return pv_uv(tries(t), ["videoSource", "contentType", "playCode"], pv="n")


@report("live_quality_counts", "L14")
def quality_counts(t):
    return qos_codes(tries(t), ["contentType", "playCode"], {"type_total": ["contentType"]})
