"""Version roll-out and conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.counts import (
    adoption_ratio, conversion_ratio, funnel_join, pv_uv, play_duration, running_total, users_where,
)
from ..operators.enrich import dim_enrich, network_enrich
from ..operators.rollout import accumulate_new, loyalty_split
from ..operators.rollups import period_rollup, rollup_all
from .channels import started
from .registry import report

CUT = "2024-01-15"


def _log(t):
    return t.login.select("userId", "mac", "day", "datetime", "ip", S.apk_version("version").alias("version"))


def _since(log, version="3.1.4"):
    return log.where(S.version_at_least("version", version))


def _accumulated(name, row, key, version, keep=()):
    @report(name, row, "S3", "S5", "J7", "F11")
    def run(t):
        """Set of yesterday plus today's new keys, with the first day kept."""
        log = _since(_log(t), version) if version == "3.1.4" else _log(t).where(F.col("version") == version)
        cut = F.lit(CUT).cast("date")
        before = accumulate_new(None, log.where(F.col("day") < cut), [key], "day", keep)
        return accumulate_new(before, log.where(F.col("day") >= cut), [key], "day", keep)


_accumulated("upgraded_devices", "E1", "mac", "3.1.4", ("userId",))
_accumulated("upgraded_users", "E2", "userId", "3.1.4")
_accumulated("upgraded_devices_315", "E3", "mac", "3.1.5")
_accumulated("upgraded_devices_316", "E4", "mac", "3.1.6")


@report("upgrades_new_and_total", "E5")
def new_and_total(t):
    log = _since(_log(t))
    devices = accumulate_new(None, log, ["mac"], "day").groupBy("day").agg(F.count(F.lit(1)).alias("new_devices"))
    users = accumulate_new(None, log, ["userId"], "day").groupBy("day").agg(F.count(F.lit(1)).alias("new_users"))
    both = funnel_join([devices, users], ["day"], how="full")
    return running_total(running_total(both, "day", "new_devices", "total_devices"), "day", "new_users", "total_users")


@report("adoption", "E6", "A12")
def adoption(t):
    return adoption_ratio(_log(t), F.col("version") >= "3.1.4", ["day"], user="mac")


@report("login_new_active_by_version_class", "E7")
def by_class(t):
    kind = F.when(F.col("version") >= "3.1.4", "new").otherwise("old").alias("kind")
    seen = pv_uv(_log(t), ["day", kind], user="mac", pv="logins", uv="login_users")
    opened = t.account.select("mac", "day", S.apk_version("current_version").alias("version"))
    fresh = pv_uv(opened, ["day", kind], user="mac", uv="new_users").drop("pv")
    both = funnel_join([seen, fresh], ["day", "kind"], how="left")
    return both.withColumn("active_users", F.col("login_users") - F.col("new_users"))


@report("hourly_logins_new_version", "E8", "A16")
def hourly(t):
    return pv_uv(_since(_log(t)), ["day", F.hour("datetime").alias("hour")], user="mac").drop("pv")


@report("weekly_logins_new_version", "E9")
def weekly(t):
    return period_rollup(_since(_log(t)), "day", "mac", ["week"]).drop("pv")


@report("monthly_logins_new_version", "E10")
def monthly(t):
    return period_rollup(_since(_log(t)), "day", "mac", ["month"]).drop("pv")


@report("province_logins_new_version", "E11")
def provinces(t):
    placed = network_enrich(_since(_log(t)), t.location, "ip", {"country": "country", "province": "province"})
    area = F.when(F.col("country") == "中国", F.col("province")).otherwise("国外及其他").alias("province")
    return pv_uv(placed, [area], user="mac").drop("pv")


@report("copyright_plays", "E12")
def copyright_plays(t):
    """All, per type and per video, side by side in one table."""
    plays = dim_enrich(t.play, t.program, {"videoSid": "sid"}, {"licensed": "program_sk"}).where(F.col("licensed").isNotNull())
    watched = F.when((F.col("event") != "startplay") & F.col("duration").between(0, 10800), F.col("duration"))
    starts = F.when(started(), F.lit(1)).otherwise(F.lit(0))
    return rollup_all(
        plays, [[], ["contentType"], ["contentType", "videoSid"]], "userId",
        sums={"starts": starts, "duration": watched}, pv="rows",
    )


def _ratio(t, plays_where, clicks_where, version):
    play = pv_uv(t.play.where(plays_where & started()), [version, "contentType"], uv="play_users").drop("pv")
    click = pv_uv(t.visit.where(clicks_where), [version, "contentType"], uv="click_users").drop("pv")
    return conversion_ratio(play, click, ["version", "contentType"], "play_users", "click_users")


@report("play_ratio_by_version_class", "E13", "A13")
def play_ratio(t):
    kind = F.when(F.col("apkVersion") >= "3.1.4", "new").otherwise("old").alias("version")
    return _ratio(t, F.lit(True), F.lit(True), kind)


@report("outflow_and_active_users", "E14", "A14")
def outflow(t):
    first = t.login.where(F.col("day") == F.lit("2024-01-10").cast("date"))
    return loyalty_split(
        _log(t).where(F.col("day") == F.lit("2024-01-10").cast("date")).where(F.col("mac").isNotNull()), t.login, "mac", "day",
        "2024-01-11", "2024-01-15", 3, outflow_users=F.col("version") >= "3.1.4",
    )


@report("plays_of_outflow_and_active", "E15")
def outflow_plays(t):
    groups = outflow(t).join(t.account.select("mac", F.col("user_id").alias("userId")), "mac").select("userType", "userId").distinct()
    plays = t.play.where(started()).join(groups, "userId")
    return pv_uv(plays, ["userType", "contentType"])


@report("play_ratio_313", "E16", "A13")
def play_ratio_313(t):
    only = F.col("apkVersion") == "3.1.3"
    return _ratio(t, only, only, F.col("apkVersion").alias("version"))


@report("play_ratio_per_version", "E17")
def play_ratio_version(t):
    return _ratio(t, F.lit(True), F.lit(True), F.col("apkVersion").alias("version"))


def _activity(t, log, accounts):
    logins = pv_uv(log, ["version"], user="mac", uv="login_users").drop("pv")
    total = pv_uv(accounts.select("mac", S.apk_version("current_version").alias("version")), ["version"], user="mac", uv="total_users").drop("pv")
    return conversion_ratio(logins, total, ["version"], "login_users", "total_users")


@report("activity_ratio_313", "E18")
def activity_313(t):
    return _activity(t, _log(t).where(F.col("version") == "3.1.3"), t.account)


@report("activity_ratio_per_version", "E19")
def activity(t):
    return _activity(t, _log(t), t.account)


def _averages(plays):
    out = play_duration(plays, ["apkVersion", "contentType"])
    users = F.nullif("uv", F.lit(0))
    return out.withColumn("avg_plays", F.col("pv") / users).withColumn("avg_hours", F.col("duration") / 3600 / users)


@report("average_plays_313", "E20")
def averages_313(t):
    return _averages(t.play.where((F.col("apkVersion") == "3.1.3") & F.col("contentType").isin("movie", "tv", "zongyi", "kids")))


@report("average_plays_per_version", "E21")
def averages(t):
    return _averages(t.play)


def _players(t, where):
    log = _log(t)
    plays = pv_uv(t.play.where(started() & where), [F.col("apkVersion").alias("version")], uv="play_users").drop("pv")
    logins = pv_uv(log, ["version"], uv="login_users").drop("pv")
    return conversion_ratio(plays, logins, ["version"], "play_users", "login_users")


@report("play_user_ratio_313", "E22")
def players_313(t):
    return _players(t, F.col("apkVersion") == "3.1.3")


@report("play_user_ratio_per_version", "E23")
def players(t):
    return _players(t, F.lit(True))


@report("daily_and_total_of_two_versions", "E24")
def two_versions(t):
    """3.1.3 on all days, 3.1.4 from the cut day on."""
    wanted = (F.col("version") == "3.1.3") | ((F.col("version") == "3.1.4") & (F.col("day") >= F.lit(CUT).cast("date")))
    daily = pv_uv(_log(t).where(wanted), ["day", "version"], user="mac", uv="daily_users").drop("pv")
    total = users_where(t.account, [S.apk_version("current_version").alias("version")], {"total_users": F.lit(True)}, user="mac")
    return daily.join(total, "version", "left")
