"""Launcher and page statistics: one template with many parameter sets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from ..functions import values as V
from ..operators.counts import pv_uv, pv_uv_contains, sum_of
from ..operators.enrich import network_enrich
from ..sources.merge import merge_sources
from .registry import report


@dataclass(frozen=True)
class Clicks:
    """pv and uv per literal contained in a column of a log."""

    row: str
    log: str
    source: str
    literals: tuple[str, ...]
    event: str | None = None
    type_col: str | None = None
    type_value: str | None = None
    hourly: bool = False


# The entries each report counts.
CLICKS: dict[str, Clicks] = {
    "enter_by_model": Clicks("G6", "home", "productModel", ("model1", "model2", "model3", "model7", "model11")),
    "launcher_areas_by_hour": Clicks("G10", "home", "accessArea", tuple(V.LAUNCHER_AREAS_3X), event="click", hourly=True),
    "launcher_classification": Clicks(
        "G11", "home", "accessLocation", ("site_movie", "site_tv", "site_kids", "site_mv"), "click", "accessArea", "classification"
    ),
    "launcher_foundation": Clicks("G12", "home", "accessLocation", ("top_new", "top_hot", "top_star"), "click", "accessArea", "foundation"),
    "launcher_live": Clicks("G13", "home", "accessLocation", ("site", "top"), "click", "accessArea", "live"),
    "launcher_my_tv": Clicks("G14", "home", "accessLocation", ("history", "collect", "site_movie", "site_tv"), "click", "accessArea", "my_tv"),
    "launcher_recommendation": Clicks("G15", "home", "accessArea", ("recommendation",), event="click"),
    "launcher_positions": Clicks(
        "G16", "home", "locationIndex", tuple(str(i) for i in range(15)), "click", "accessArea", "recommendation"
    ),
    "launcher_search_and_setting": Clicks("G17", "home", "accessLocation", ("search", "setting"), event="click"),
    "plays_from_recommendation": Clicks("G18", "play", "pathMain", ("home*recommendation",), event="startplay"),
    "plays_from_launcher_areas": Clicks("G19", "play", "pathMain", tuple(f"home*{a}" for a in V.LAUNCHER_AREAS_3X), event="startplay"),
}


def _register(name: str, c: Clicks) -> None:
    @report(name, c.row, "G3" if c.hourly else "G2")
    def run(t):
        return pv_uv_contains(
            getattr(t, c.log), c.literals, c.source, event=c.event, type_col=c.type_col, type_value=c.type_value,
            ts="datetime" if c.hourly else None,
        )


for _name, _clicks in CLICKS.items():
    _register(_name, _clicks)


@report("enter_application", "G1", "G5")
def enter_application(t):
    return pv_uv(t.home, ["day"])


@report("launcher_views", "G7")
def views(t):
    return pv_uv(t.home, ["day"], where=F.col("event") == "view")


@report("launcher_view_duration", "G8", "G4")
def view_duration(t):
    return sum_of(t.home, "duration", where=F.col("event") == "view", name="duration")


@report("launcher_clicks", "G9")
def clicks(t):
    return pv_uv(t.home, ["day"], where=F.col("event") == "click")


@report("start_pages", "G20")
def start_pages(t):
    return pv_uv(t.home, ["apkVersion", "accessArea"], null_user="count")


@report("launcher_clicks_by_city", "G21")
def by_city(t):
    users = network_enrich(t.account, t.location, "ip", {"city": "city"}, default="未知").select(F.col("user_id").alias("userId"), "city")
    located = t.home.where(F.col("event") == "click").join(users, "userId", "left").fillna("未知", ["city"])
    return pv_uv(located, ["accessArea", "accessLocation", "city"])


@report("function_use", "G22")
def functions(t):
    logs = [
        (t.home.where(F.col("event") == "click"), "launcher"), (t.search.where(F.col("step") == "click"), "search"),
        (t.visit.where(F.col("event") == "enter"), "collect_ok"), (t.visit.where(F.col("event") == "exit"), "collect_cancel"),
        (t.apps.where(F.col("event") == "install"), "install"), (t.accountlog.where(F.col("event") == "login"), "login"),
        (t.livelog.where(F.col("event") == "startplay"), "live"), (t.play2, "play"),
    ]
    return pv_uv(merge_sources([(log.select("userId"), name) for log, name in logs], flag="function"), ["function"])


@report("article_entrances", "G23")
def articles(t):
    entrance = F.when(F.col("entrance") == "home", "homepage").when(F.col("entrance") == "movie", "detail").otherwise("others")
    return pv_uv(t.search.withColumn("entrance", entrance), ["entrance"], null_user="count")
