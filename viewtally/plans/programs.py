"""Programs, subjects, recommendations and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import scalars as S
from ..operators.counts import play_duration, pv_uv
from ..operators.enrich import dim_enrich
from ..operators.rankings import topn_per_group
from .channels import started
from .registry import report


@report("video_plays_of_channel", "P1")
def videos(t):
    return pv_uv(t.play, ["contentType", "videoSid"], where=started())


@report("top_videos_of_channel", "P1", "W2")
def top_videos(t):
    return topn_per_group(videos(t), ["contentType"], "pv", 5, tie_break=["videoSid"])


@report("top_videos_with_ties", "W1")
def top_with_ties(t):
    return topn_per_group(videos(t), ["contentType"], "uv", 3, ties="keep")


@report("video_plays", "P2", "SNK5")
def video_plays(t):
    return pv_uv(t.play, ["day", "contentType", "videoSid"], where=started())


@report("episode_plays", "P3")
def episode_plays(t):
    return pv_uv(t.play, ["contentType", "episodeSid"], where=started() & F.col("episodeSid").isNotNull())


@report("cartoons_and_songs", "P4")
def cartoons(t):
    kinds = P.classify_path("pathMain", [("%kids_anim%", "donghua"), ("%mv_category%", "song")])
    plays = t.play.withColumn("kind", kinds).where(F.col("kind").isNotNull())
    return pv_uv(plays, ["kind", "videoSid"], where=started())


def _subject_plays(t):
    return t.play.where(started() & F.col("subjectCode").isNotNull()).withColumn(
        "channel", F.regexp_extract("subjectCode", "^([a-z]+)", 1)
    )


@report("subject_plays", "P5")
def subject_plays(t):
    return pv_uv(_subject_plays(t), ["channel", "subjectCode"])


@report("top_subjects_of_channel", "P5", "W2")
def top_subjects(t):
    return topn_per_group(subject_plays(t), ["channel"], "pv", 3, tie_break=["subjectCode"])


@report("channel_subject_plays", "P6")
def channel_subject_plays(t):
    return pv_uv(_subject_plays(t), ["channel"])


def _with_subject(frame, t, valid="dim_invalid_time"):
    return dim_enrich(frame, t.subject, {"subjectCode": "subject_code"}, {"channel": "subject_content_type_name"}, valid_col=valid)


@report("channel_subject_plays_by_dim", "P7")
def channel_subject_by_dim(t):
    return pv_uv(_with_subject(t.play.where(started() & F.col("subjectCode").isNotNull()), t), ["channel", "day"])


@report("channel_subject_plays_all_versions", "P8")
def channel_subject_all(t):
    """All versions of the dimension, not only its current rows."""
    plays = _with_subject(t.play.where(started()), t, valid=None)
    return pv_uv(plays.where(F.col("channel").isNotNull()), ["channel"])


@report("channel_subject_views", "P9")
def channel_subject_views(t):
    views = _with_subject(t.visit.where(F.col("event").isin("enter", "view")), t)
    return pv_uv(views.where(F.col("channel").isNotNull()), ["channel", "day"])


_SOURCES = [("home*classification%", "classification"), ("home*my_tv%", "my_tv"), ("home*recommendation%", "recommendation"), ("%search%", "search")]


@report("subject_plays_by_source", "P10")
def subject_by_source(t):
    plays = _subject_plays(t).withColumn("source", P.classify_path("pathMain", _SOURCES, "other"))
    return pv_uv(plays, ["subjectCode", "source"])


@report("subject_views_by_source", "P11")
def subject_views_by_source(t):
    source = P.classify_path("path", [("home-hotrecommend%", "hotrecommend"), ("home-tv%", "tv"), ("home-movie%", "movie")], "other")
    return pv_uv(t.visit.withColumn("source", source), ["subjectCode", "source"], null_user="count")


@report("guess_you_like_plays", "P12")
def guess_you_like(t):
    branches = [("pathSub", "guessyoulike%", "guess"), ("pathMain", "%recommendation%", "recommendation"), ("pathMain", "%taste%", "taste")]
    kinds = F.array(*[F.when(F.col(c).like(p), F.lit(k)) for c, p, k in branches])
    plays = t.play.withColumn("kind", F.explode(F.filter(kinds, lambda k: k.isNotNull())))
    return play_duration(plays, ["kind"])


@report("similar_plays", "P13")
def similar(t):
    return play_duration(t.play.where(F.col("pathSub").like("%similar%")), ["contentType"], avg="avg_duration")


@report("home_recommendation_videos", "P14")
def home_recommendation(t):
    shaped = (F.col("pathMain").contains("recommendation") & (P.path_length("pathMain") == 2)) | (
        F.col("path").contains("hotrecommend") & P.path_length("path").between(4, 5)
    )
    return pv_uv(t.play, ["videoSid"], where=started() & shaped, null_user="count")


@report("content_type_plays", "P15")
def content_types(t):
    return pv_uv(t.play, ["flag", "contentType"], where=started())


@report("content_type_details", "P16")
def content_details(t):
    return pv_uv(t.visit, ["contentType"], where=F.col("event") == "view")


@report("videos_found_by_search", "P17")
def found_by_search(t):
    plays = t.play.where(F.col("pathMain").like("%search%") | F.col("path").like("%search%")).select("userId", "videoSid")
    views = t.visit.where(F.col("path").like("%search%")).select("userId", "videoSid")
    return pv_uv(plays.unionByName(views), ["videoSid"])


@report("search_click_counts", "P18")
def search_clicks(t):
    return t.search.where(F.col("step") == "click").groupBy("contentType").agg(F.count(F.lit(1)).alias("n"))


@report("search_clicks_by_result", "P19")
def search_by_result(t):
    params = F.create_map(F.lit("resultSid"), "resultSid", F.lit("resultName"), "resultName")
    clicks = t.search.withColumn("params", params)
    return pv_uv(clicks, [F.col("params")["resultSid"].alias("sid"), F.col("params")["resultName"].alias("name"), "contentType"], null_user="count")


@report("search_clicks_by_type", "P20")
def search_by_type(t):
    return pv_uv(t.search, ["day", "contentType"], where=F.col("step") == "click", null_user="count")


@report("search_clicks_by_video", "P21")
def search_by_video(t):
    return pv_uv(t.search, ["resultSid", "resultName", "contentType"], where=F.col("step") == "click", null_user="count")


@report("search_funnel", "P22")
def search_funnel(t):
    keys = ["day", "entrance", "tabName", "contentType"]
    steps = {"entrance": "enter", "tabview": "views", "click": "clicks"}
    counted = t.search.where(F.col("step").isin(list(steps))).groupBy(*keys).agg(
        *[F.count(F.when(F.col("step") == step, F.col("userId"))).alias(name) for step, name in steps.items()],
        F.count_if(F.col("step") == "entrance").alias("entered"),
    )
    return counted.where("entered > 0").drop("entered")


def _app(event, row):
    @report(f"apps_{event}", row)
    def run(t):
        named = dim_enrich(t.apps.where(F.col("event") == event), t.application, {"appSid": "application_sid"}, {"name": "application_name"})
        return pv_uv(named, ["appSid", "name"])


for _event, _row in (("view", "P23"), ("open", "P24"), ("install", "P25"), ("upgrade", "P26")):
    _app(_event, _row)
