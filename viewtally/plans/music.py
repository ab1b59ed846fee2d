"""Music channel."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import paths as P
from ..operators.counts import play_duration, pv_uv
from ..operators.enrich import dim_enrich
from .channels import started
from .registry import report


def _music(t):
    return t.play.where(F.col("pathMain").contains("mv*"))


# Areas and places of the music home page, first match wins.
AREAS = [
    ("%mv_collection", "mine"), ("%mv_station", "station"), ("%mvRecommendHomePage%", "recommendation"),
    ("%mvTopHomePage%", "top"), ("%mvCategoryHomePage%", "classification"), ("%mv*function%", "entrance"),
    ("%mv-search%", "entrance"),
]
PLACES = [
    ("%mv_collection", "All"), ("%mv_station", "All"), ("%mvRecommendHomePage%", "All"), ("%mvTopHomePage%", "All"),
    ("%site_mvstyle%", "style"), ("%site_mvarea%", "area"), ("%site_mvyear%", "year"), ("%mv-search%", "search"),
    ("%mv*function*site_hotsinger%", "singer"), ("%mv*function*site_mvsubject%", "mvsubject"),
    ("%mv*function*site_concert%", "concert"),
]


@report("music_plays_by_chart", "V1")
def by_chart(t):
    chart = F.regexp_extract("pathMain", r"mv_category\*(\w+)", 1)
    plays = _music(t).withColumn("source", chart).where(F.col("source") != "")
    return play_duration(plays, ["videoSid", "source"], low=1, dur_users="dur_users")


@report("music_video_plays", "V2")
def video(t):
    return pv_uv(_music(t), ["videoSid"], where=started())


@report("music_area_plays", "V3", "F13")
def areas(t):
    plays = t.play.withColumn("area", P.classify_path("pathMain", AREAS, "other")).withColumn(
        "location", P.classify_path("pathMain", PLACES, "other")
    )
    return play_duration(
        plays.where(F.col("area") != "other"), ["area", "location"], null_dur="zero", dur_users="dur_users",
    )


@report("music_recommended", "V4")
def recommended(t):
    plays = _music(t).withColumn("kind", F.when(F.col("pathSpecial").startswith("subject"), "topic").otherwise("program"))
    plays = plays.withColumn("code", F.when(F.col("kind") == "topic", F.col("subjectCode")).otherwise(F.col("videoSid")))
    counted = play_duration(plays, ["kind", "code"], dur_users="dur_users")
    titled = dim_enrich(counted, t.program, {"code": "sid"}, {"_p": "title"}, guard=F.col("kind") == "program")
    titled = dim_enrich(titled, t.subject, {"code": "subject_code"}, {"_s": "subject_name"}, guard=F.col("kind") == "topic")
    return titled.withColumn("title", F.coalesce("_p", "_s", "code")).drop("_p", "_s")


def _omnibus(t):
    return t.play.withColumn("omnibus", P.subject_code_3x("pathSpecial")).where(F.col("omnibus").isNotNull())


@report("omnibus_plays", "V5")
def omnibus(t):
    counted = play_duration(_omnibus(t), ["omnibus"])
    return dim_enrich(counted, t.subject, {"omnibus": "subject_code"}, {"name": "subject_name"})


@report("omnibus_plays_by_entrance", "V6", "J17")
def omnibus_entrance(t):
    plays = _omnibus(t).withColumn("home", P.music_home_location("pathMain"))
    plays = plays.select("*", F.col("home.area").alias("area"), F.col("home.location").alias("location"))
    codes = t.livemenu.select(
        F.lit("function").alias("area"), F.when(F.col("menu_code") == "menu1", "site_concert").when(F.col("menu_code") == "menu2", "site_hotsinger").alias("location"), "menu_name"
    )
    named = dim_enrich(plays, codes, ["area", "location"], {"entrance": "menu_name"}, null_safe=["location"])
    return play_duration(named, ["entrance", "omnibus"])


@report("singer_plays", "V7", "J16")
def singers(t):
    """Total per singer and split by entrance, side by side."""
    plays = dim_enrich(_music(t), t.program, {"videoSid": "sid"}, {"singer": "title"})
    plays = dim_enrich(plays, t.subject, {"subjectCode": "subject_code"}, {"topic": "subject_name"})
    plays = plays.withColumn("singer", F.coalesce("singer", "topic", "videoSid"))
    split = play_duration(plays, ["singer", "entryType"], avg="avg_duration")
    whole = play_duration(plays, ["singer"], avg="avg_duration").withColumn("entryType", F.lit("All"))
    return split.unionByName(whole)


@report("music_position_clicks", "V8")
def positions(t):
    return pv_uv(t.home, [F.lit("mv").alias("channel"), "accessArea", "locationIndex"], where=F.col("event") == "click", null_user="count")


def _tabs(t):
    return t.play.withColumn("m", P.music_tabs("pathMain")).select("*", "m.entry", "m.tab", "m.item").where(F.col("entry") != "")


@report("music_tab_plays", "V9", "U14")
def tab_plays(t):
    return play_duration(_tabs(t), ["entry", "tab", "item"], avg="avg_duration")


@report("music_tab_views", "V10")
def tab_views(t):
    return pv_uv(_tabs(t), ["entry", "tab", "item"], where=F.col("event") == "selfend", null_user="count")


@report("music_videos_by_source", "V11")
def videos_by_source(t):
    return play_duration(_tabs(t), ["videoSid", "tab"])


@report("music_videos", "V12")
def videos(t):
    return play_duration(_music(t), ["videoSid"], low=1)
