"""Channel, entrance and classification plays."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import values as V
from ..operators.counts import START_EVENTS, play_duration, pv_uv
from ..operators.enrich import dim_enrich
from ..operators.quality import flood_filter
from .registry import report



def started():
    return F.col("event").isin(*START_EVENTS)


@report("classification_plays", "C2", "A1", "F1")
def classification_plays(t):
    return pv_uv(t.play, ["main_category", "second_category"], where=started())


@report("classification_plays_by_day", "C1")
def classification_by_day(t):
    known = started() & F.col("main_category").isNotNull()
    return pv_uv(t.play, ["day", "main_category", "second_category"], where=known)


@report("classification_of_channel", "C3")
def classification_of_channel(t):
    return pv_uv(t.play, ["second_category"], where=started() & (F.col("main_category") == "movie"))


def _subject_channel(t):
    """Content type of the play; a subject's own type wins over the program's."""
    plays = dim_enrich(t.play, t.subject, {"subjectCode": "subject_code"}, {"_subject": "subject_content_type_name"})
    plays = dim_enrich(plays, t.program, {"videoSid": "sid"}, {"_program": "content_type_name"}, trim=True)
    return plays.withColumn("channel", F.coalesce("_subject", "_program", "contentType"))


@report("entrance_plays", "C4", "C6", "J5")
def entrance_plays(t):
    return play_duration(_subject_channel(t), ["channel", "entryType"], avg="avg_duration", digits=0)


@report("entrance_plays_short", "C5")
def entrance_plays_short(t):
    return play_duration(t.play, ["contentType", "entryType"], avg="avg_duration", digits=0)


def _labelled(t):
    label = F.when(F.col("flag") == "3x", P.entrance_3x("pathMain")).otherwise(P.entrance_2x("path"))
    return t.play.withColumn("source", label)


@report("history_plays_by_video", "C7")
def history_by_video(t):
    return pv_uv(_labelled(t), ["videoSid", "contentType", "source"], where=started() & (F.col("source") == "历史"), null_user="count")


@report("source_plays_and_time", "C8", "A3")
def source_time(t):
    return play_duration(_labelled(t), ["contentType", "source"])


@report("source_plays_one_version", "C9")
def source_one_version(t):
    return play_duration(
        _labelled(t).where(F.col("apkVersion") == "3.1.4"), ["contentType", "source"], avg="avg_duration"
    )


@report("channel_plays", "C10", "J1")
def channel_plays(t):
    prefix = F.regexp_extract("subjectCode", "^([a-z]+)", 1)
    channel = F.when(F.col("subjectCode").isNotNull(), prefix).otherwise(F.col("contentType"))
    return pv_uv(t.play.withColumn("channel", channel), ["channel"], where=started())


@report("channel_plays_by_day", "C11")
def channel_by_day(t):
    return pv_uv(t.play, ["day", "contentType"], where=started())


@report("channel_durations", "C12")
def channel_durations(t):
    return play_duration(t.play, ["day", "contentType"], avg="avg_duration", dur_users="dur_users", how="inner")


@report("channel_visits", "C13")
def channel_visits(t):
    return pv_uv(t.visit, ["day", "contentType"], where=F.col("event") == "enter")


@report("channel_visit_durations", "C14", "F2", "F3")
def visit_durations(t):
    """Bound of ten hours, but three for music and kids."""
    bound = F.when(F.col("contentType").isin("mv", "kids"), 10800).otherwise(36000)
    kept = t.visit.where((F.col("event") != "exit") | (F.col("duration") <= bound))
    return play_duration(
        kept, ["contentType"], start=F.col("event") == "enter", dur_rows=F.col("event") == "exit", high=None,
        avg="avg_duration", dur_users="dur_users",
    )


@report("collect_tab_plays", "C15", "F13")
def collect_tabs(t):
    rules = [(f"%{tab}%", tab) for tab in V.COLLECT_TABS]
    plays = t.play.where(F.col("pathMain").contains("collect")).withColumn(
        "tab", P.classify_path(F.coalesce("pathMain", F.lit("")), rules, V.COLLECT_OTHER)
    )
    return play_duration(plays, ["tab", "day"], dur_rows=~started(), avg="avg_duration")


@report("collected_videos", "C16")
def collected(t):
    return pv_uv(t.visit, ["videoSid"], where=F.col("event") == "view")


@report("history_plays", "C17")
def history_plays(t):
    return play_duration(t.play.where(F.col("pathMain").contains("history")), ["day"], avg="avg_duration")


def _kids(frame):
    levels = P.kids_levels_3x("pathMain")
    return frame.select("*", levels[0].alias("kids"), levels[1].alias("group"), levels[2].alias("tab")).where("kids IS NOT NULL")


@report("kids_tab_plays", "C18", "U11")
def kids_tabs(t):
    return pv_uv(_kids(t.play), ["group", "tab"], where=started(), null_user="count")


@report("kids_tab_plays_calm", "C19")
def kids_tabs_calm(t):
    calm = flood_filter(_kids(t.play), ["userId", "group", "tab"], limit=3)
    return pv_uv(calm, ["group", "tab"], where=started())


@report("kids_tab_views", "C20")
def kids_views(t):
    return pv_uv(_kids(t.play), ["group", "tab"], where=F.col("event") == "selfend", null_user="count")


@report("kids_tab_views_named", "C21")
def kids_views_named(t):
    names = t.livemenu.select(F.concat(F.lit("A"), F.substring("menu_code", 5, 1)).alias("code"), F.col("menu_name").alias("name"))
    named = dim_enrich(_kids(t.play), names, {"tab": "code"}, {"name": "name"}, default=F.col("tab"))
    return pv_uv(named, ["group", "name"], where=F.col("event") == "selfend")


@report("match_plays", "C22")
def match_plays(t):
    rules = [("%sports*horizontal%", "体育首页"), ("%sports*League%", "联赛"), ("%sports*horizontal*collect%", "收藏")]
    plays = t.play.withColumn("place", P.classify_path("pathMain", rules))
    return play_duration(plays.where(F.col("place").isNotNull()), ["videoSid", "place"], avg="avg_duration")


@report("sports_users", "C23")
def sports_users(t):
    vod = t.play.where(F.col("contentType") == "sports").select("userId")
    live = t.livelog.where(F.col("liveMenuCode") == "menu1").select("userId")
    return vod.unionByName(live).distinct().agg(F.count("userId").alias("users"))
