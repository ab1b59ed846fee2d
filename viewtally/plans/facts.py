"""Two-product log mergers, the play fact, snapshots and flat quality rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P
from ..operators.counts import pv_uv
from ..operators.enrich import dim_enrich, network_enrich
from ..operators.dictionaries import category_dictionary, label_details
from ..operators.facts import play_fact
from ..operators.qos import qos_explode
from ..operators.quality import flood_filter
from ..sources.merge import merge_sources
from ..sources.sinks import snapshot_day
from .registry import report


@dataclass(frozen=True)
class Merger:
    """One merged log: the two sides, the columns kept, and side constants."""

    row: str
    new: str
    old: str
    columns: Mapping[str, str]
    extra: Mapping[str, Mapping[str, str]] = field(default_factory=dict)  # side -> column -> SQL
    keys: Sequence[str] = ("flag", "event")


_BASIC = {"userId": "string", "event": "string", "apkVersion": "string", "datetime": "timestamp", "day": "date"}

MERGERS: dict[str, Merger] = {
    "collect": Merger("M1", "home", "visit", {**_BASIC, "videoSid": "string", "contentType": "string"}),
    "enter": Merger("M3", "home", "login", {**_BASIC, "productModel": "string"}),
    "evaluate": Merger(
        "M4", "home", "visit", {**_BASIC, "contentType": "string"},
        {"2x": {"event": "CASE event WHEN 'enter' THEN 'ok' WHEN 'exit' THEN 'cancel' ELSE 'error' END"}},
    ),
    "exit": Merger("M5", "home", "visit", {**_BASIC, "duration": "bigint"}),
    "homeaccess": Merger(
        "M6", "home", "login", {**_BASIC, "accessArea": "string", "accessLocation": "string", "locationIndex": "string"},
        keys=("flag", "accessArea"),
    ),
    "homeview": Merger("M7", "home", "login", {**_BASIC, "duration": "bigint"}, keys=("flag", "day")),
    "livebutton": Merger(
        "M11", "livelog", "accountlog", {**_BASIC, "button": "string"},
        {"3x": {"button": "event"}, "2x": {"button": "'ok'"}}, keys=("flag", "button"),
    ),
    "videobutton": Merger(
        "M12", "play3", "play2", {**_BASIC, "videoSid": "string", "hour": "int"},
        {"3x": {"hour": "hour(datetime)"}, "2x": {"hour": "hour(datetime)"}}, keys=("flag", "hour"),
    ),
    "mtvaccount": Merger("M13", "accountlog", "login", {**_BASIC, "accountId": "bigint", "path": "string"}, keys=("flag", "path")),
    "apprecommend": Merger("M14", "apps", "apps", {**_BASIC, "appSid": "string"}, keys=("flag", "appSid")),
    "playview_fixed": Merger(
        "M18", "play3", "play2",
        {"userId": "string", "event": "string", "contentType": "string", "videoSid": "string", "episodeSid": "string",
         "duration": "bigint", "apkVersion": "string", "productModel": "string", "datetime": "timestamp", "day": "date"},
        keys=("flag", "day", "contentType"),
    ),
}


def merged(t, name: str) -> DataFrame:
    m = MERGERS[name]
    extra: dict[str, dict[str, Column]] = {
        side: {c: F.expr(text) for c, text in cols.items()} for side, cols in m.extra.items()
    }
    return merge_sources([(getattr(t, m.new), "3x"), (getattr(t, m.old), "2x")], m.columns, extra=extra)


def _register(name: str, row: str) -> None:
    @report(f"merge_{name}", row)
    def run(t):
        both = merged(t, name)
        kept = [c for c in MERGERS[name].columns if c not in ("userId", "datetime", "day", *MERGERS[name].keys)]
        return both.groupBy(*MERGERS[name].keys).agg(
            F.count(F.lit(1)).alias("rows"), F.count("userId").alias("users"), *[F.count(c).alias(f"n_{c}") for c in kept]
        )


for _name, _merger in MERGERS.items():
    _register(_name, _merger.row)


@report("merge_detail", "M2")
def merge_detail(t):
    three = t.play3.select("userId", "contentType", "videoSid", "day", P.page_columns_3x("pathMain", "pathSub", "pathSpecial").alias("p"),
                           P.subject_code_3x("pathSpecial").alias("subjectCode"), P.subject_name("pathSpecial").alias("subjectName"))
    two = t.play2.select("userId", "contentType", "videoSid", "day", P.page_columns_2x("path").alias("p"), P.subject_code_2x("path").alias("subjectCode"))
    both = merge_sources([(three.select("*", "p.*").drop("p"), "3x"), (two.select("*", "p.*").drop("p"), "2x")])
    return both.groupBy("flag", "launcherArea", "pathProperty").agg(
        F.count("userId").alias("pv"), F.count("subjectCode").alias("codes"), F.count("subjectName").alias("names"), F.count("previousSid").alias("previous")
    )


@report("merge_interview", "M8", "M9")
def merge_interview(t):
    three = t.visit.select("userId", "event", "contentType", "duration", "day")
    two = t.visit.select("userId", "event", P.content_type_2x("path").alias("contentType"), "duration", "day")
    return pv_uv(merge_sources([(three, "3x"), (two, "2x")]), ["flag", "event", "contentType"])


@report("merge_live", "M10")
def merge_live(t):
    named = dim_enrich(t.livelog, t.livemenu, {"liveMenuCode": "menu_code"}, {"channelName": "menu_name"}, default=F.col("liveMenuCode"))
    both = merge_sources([(named, "3x"), (t.login.select("userId", "datetime", "day", "duration"), "2x")]).withColumn("hour", F.hour("datetime"))
    return pv_uv(both, ["flag", "channelName", "hour"])


@report("merge_subject_visits", "M15", "M16")
def merge_subject_visits(t):
    both = merge_sources([
        (t.visit.select("userId", "event", "subjectCode", "day"), "3x"),
        (t.play2.select("userId", "event", P.subject_code_2x("path").alias("subjectCode"), "day"), "2x"),
    ])
    titled = dim_enrich(
        both, t.subject, {"subjectCode": "subject_code"},
        {"title": "subject_name", "channel": "subject_content_type_name"}, default={"title": F.col("subjectCode")},
    )
    return pv_uv(titled, ["flag", "title", "channel"])


@report("merge_play_with_paths", "M17")
def merge_play(t):
    both = play_fact(t.play3, t.play2, limit=1 << 40)
    return both.groupBy("flag", "entryType", "playKind").agg(
        F.count(F.lit(1)).alias("n"), F.count("subjectCode").alias("codes"), F.count("subjectName").alias("names")
    )


# site tree, page areas and program codes that meet the templates of the paths: names, codes, misses, old rows
SITES = """
SELECT CASE n_nationkey WHEN 0 THEN 'jilu' WHEN 1 THEN 'jilu' WHEN 2 THEN 'tv' WHEN 4 THEN 'movie' WHEN 5 THEN 'history' WHEN 6 THEN 'hot'
    WHEN 7 THEN 'mv' WHEN 8 THEN 'mv' WHEN 9 THEN 'sports' WHEN 10 THEN 'sports' WHEN 11 THEN 'tv' WHEN 12 THEN 'movie' WHEN 13 THEN 'hot'
    WHEN 14 THEN 'tv' WHEN 15 THEN NULL ELSE 'none' END AS site_content_type,
  CASE n_nationkey WHEN 7 THEN 'mv_site' WHEN 8 THEN 'mv_site' WHEN 5 THEN 'site_other' WHEN 0 THEN 'site_jilu' WHEN 1 THEN 'site_jilu'
    WHEN 6 THEN 'site_hot' WHEN 13 THEN 'site_hot' WHEN 9 THEN 'site_sport' WHEN 10 THEN 'site_sport' WHEN 4 THEN 'site_movie'
    WHEN 12 THEN 'site_movie' ELSE 'site_tv' END AS main_category_code,
  CASE n_nationkey WHEN 4 THEN 'movie_hot' WHEN 5 THEN 'collect' WHEN 7 THEN 'site_mvstyle' WHEN 8 THEN 'site_concert' WHEN 11 THEN 'tv_genbo'
    WHEN 12 THEN 'movie_hot' WHEN 13 THEN 'hot_zhuanti' ELSE 'c' || CAST(n_nationkey AS STRING) END AS second_category_code,
  CASE n_nationkey WHEN 0 THEN 'T0' WHEN 1 THEN 'T3' WHEN 2 THEN 'history' WHEN 4 THEN 'big screen' WHEN 6 THEN 'T2' WHEN 12 THEN 'a smaller name'
    ELSE 'name' || CAST(n_nationkey AS STRING) END AS second_category,
  CASE n_nationkey WHEN 9 THEN 'ouguan' WHEN 10 THEN 'yingchao' ELSE 'third' END AS third_category_code,
  CASE n_nationkey WHEN 9 THEN 'champions' WHEN 10 THEN 'premier' ELSE 'x' END AS third_category,
  CASE WHEN n_nationkey = 13 THEN DATE '2023-01-01' ELSE NULL END AS dim_invalid_time
FROM {nation}"""
ENTRANCES = """
SELECT CASE n_nationkey WHEN 0 THEN 'sports' WHEN 1 THEN 'sports' WHEN 2 THEN 'kids' ELSE 'page' || CAST(n_regionkey AS STRING) END AS page_code,
  CASE n_nationkey WHEN 0 THEN 'League' WHEN 1 THEN 'other' WHEN 2 THEN 'program1' WHEN 3 THEN 'program2' WHEN 4 THEN 'League'
    ELSE 'area' || CAST(n_nationkey AS STRING) END AS area_code,
  CASE n_nationkey WHEN 0 THEN 'leagues' WHEN 2 THEN 'cartoons' WHEN 3 THEN 'null' ELSE 'zone' || CAST(n_nationkey AS STRING) END AS area_name
FROM {nation}"""
KIDS_PROGRAMS = """
SELECT CASE r_regionkey WHEN 0 THEN 'kids_anim' WHEN 1 THEN 'kids_song' ELSE 'p' || CAST(r_regionkey AS STRING) END AS path_code,
  CASE r_regionkey WHEN 0 THEN 'program1' WHEN 1 THEN 'program2' ELSE 'none' END AS program_code
FROM {region}"""


def _fact(t, limit):
    sites, entrances = t.spark.sql(SITES, nation=t.nation), t.spark.sql(ENTRANCES, nation=t.nation)
    categories = category_dictionary(sites, entrances, t.spark.sql(KIDS_PROGRAMS, region=t.region))
    return play_fact(t.play3, t.play2, t.subject, categories, limit=limit)


@report("play_fact", "M20", "M21", "S1")
def fact(t):
    rows = _fact(t, 2)
    return rows.groupBy("flag", "entryType", "main_category", "second_category", "third_category").agg(
        F.count(F.lit(1)).alias("n"), F.count("userId").alias("users"), F.sum("duration").alias("duration")
    )


@report("play_fact_subjects", "M20", "M21", "U4")
def fact_subjects(t):
    return _fact(t, 2).groupBy("flag", "subjectCode").agg(F.count(F.lit(1)).alias("n"))


TAB_LABELS = """
SELECT CASE n_nationkey WHEN 0 THEN 'movie' WHEN 1 THEN 'history' WHEN 2 THEN 'tv' WHEN 3 THEN 'movie' WHEN 4 THEN 'hot' WHEN 5 THEN 'subject'
    WHEN 6 THEN 'movie' ELSE 'page' || CAST(n_nationkey AS STRING) END AS page,
  CASE n_nationkey WHEN 0 THEN 'movie_hot' WHEN 1 THEN 'collect' WHEN 2 THEN 'tv_genbo' WHEN 3 THEN 'multi_search' WHEN 4 THEN 'hot_zhuanti'
    WHEN 5 THEN 'hot_zhuanti' WHEN 6 THEN 'collect' ELSE 'code' END AS code,
  CASE n_nationkey WHEN 0 THEN '院线大片' WHEN 1 THEN '收藏追剧' WHEN 2 THEN '华语热播' WHEN 3 THEN '筛选' WHEN 4 THEN '资讯专题' WHEN 5 THEN '资讯专题'
    WHEN 6 THEN '已收藏' ELSE 'label' END AS label
FROM {nation}"""


@report("page_labels_2x", "U3", "U41", "M2")
def page_labels(t):
    pages = t.play2.select("userId", "contentType", P.page_columns_2x("path").alias("p"))
    pages = pages.select("userId", P.channel_label("contentType").alias("channel"), "p.pageType", "p.pageDetailInfo")
    return pv_uv(label_details(pages, t.spark.sql(TAB_LABELS, nation=t.nation)), ["channel", "pageType", "pageDetailInfo"])


@report("enter_ways", "U16")
def enter_ways(t):
    reached = t.play3.select("userId", P.enter_way("pathMain").alias("e")).select("userId", "e.*")
    return pv_uv(reached, ["way", "area", "location", "page", "tab"])


@report("plays_per_program", "J2", "J3", "J4")
def plays_per_program(t):
    titled = dim_enrich(
        t.play3, t.program, {"videoSid": "sid"}, {"title": "title", "channel": "content_type_name"},
        default={"title": F.col("videoSid"), "channel": "none"}, spread=True,
    )
    return pv_uv(titled, ["title", "channel"])


@report("calm_plays", "M19")
def calm_plays(t):
    return pv_uv(flood_filter(t.play, ["day", "userId", "videoSid"], limit=2), ["flag", "day"], null_user="count")


@report("account_snapshot", "M23", "SRC7", "I10", "I12")
def snapshot(t):
    return snapshot_day(t.account, "2024-01-15").groupBy("day", "promotion_channel").agg(
        F.count(F.lit(1)).alias("accounts"), F.max("openTime").alias("last_open")
    )


@report("quality_rows", "M24", "U43", "U44")
def quality_rows(t):
    rows = qos_explode(t.qos, keep=("day",))
    keys = ["playQos", "sourceCases", "videoSource", "sourceIndex", "playCode"]
    # the least of some texts can only be found by sorting, so that is left to the few rows per key and player type
    sums = [F.sum("n").alias("n"), F.sum("play_duration").alias("play_duration"), F.min("init").alias("init")]
    reduced = rows.groupBy(*keys, F.col("playerType").alias("player"), "userId").agg(
        F.count(F.lit(1)).alias("n"), F.sum("playDuration").alias("play_duration"), F.min("initDuration").alias("init")
    )
    names = ["player", "userId", "n", "play_duration", "init"]
    none = {c: F.lit(None).cast(reduced.schema[c].dataType).alias(c) for c in names}
    of_player = F.struct(*[none[c] if c == "userId" else F.col(c) for c in names])
    of_user = F.struct(*[F.col(c) if c == "userId" else none[c] for c in names])
    apart = reduced.select(*keys, F.explode(F.array(of_player, of_user)).alias("r")).select(*keys, "r.*")
    once = apart.groupBy(*keys, "player", "userId").agg(*sums)
    few = once.groupBy(*keys, "player").agg(*sums, F.count("userId").alias("users"))
    return few.groupBy(*keys).agg(*sums, F.min("player").alias("player"), F.sum("users").alias("users"))


@report("user_areas", "M26")
def user_areas(t):
    placed = network_enrich(t.account, t.location, "ip", {"country": "country", "province": "province", "city": "city"}, default="未知")
    return placed.select("user_id", "country", "province", "city")
