"""Logins and active users."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import periods as D
from ..functions import scalars as S
from ..functions import values as V
from ..operators.counts import funnel_join, new_active_total, pv_uv, running_total, users_where
from ..operators.distributions import count_histogram
from ..operators.enrich import brand_enrich, mac_brand_enrich, network_enrich
from ..operators.quality import blacklist_filter
from ..operators.rollups import period_rollup
from ..sources.access_log import parse_access_log
from ..sources.merge import merge_sources
from .registry import report


def version():
    return S.apk_version("version")


def new_users(t, keys, name="new_users"):
    """Accounts opened per key, in their own column."""
    return pv_uv(t.account, keys, user="user_id", uv=name).drop("pv")


@report("daily_overview", "N1", "N2", "A18")
def daily_overview(t):
    logins = pv_uv(t.login, ["day"], user="mac", pv="logins", uv="login_users")
    fresh = pv_uv(t.account, ["day"], user="mac", uv="new_users").drop("pv")
    both = funnel_join([logins, fresh], ["day"], how="full")
    both = both.withColumn("active_users", F.col("login_users") - F.col("new_users"))
    return running_total(both, "day", "new_users", "total_users")


@report("weekly_active", "N3", "A18")
def weekly_active(t):
    active = period_rollup(t.login, "day", "mac", ["week"], uv="active").select("start", "active")
    fresh = period_rollup(t.account, "day", "mac", ["week"], uv="new_users").select("start", "new_users")
    return running_total(funnel_join([active, fresh], ["start"], how="full"), "start", "new_users", "total")


@report("monthly_active", "N4")
def monthly_active(t):
    return period_rollup(t.login, "day", "userId", ["month"])


@report("areas", "N5", "J14")
def areas(t):
    area = F.when(F.col("country") == V.HOME_COUNTRY, F.col("province")).otherwise(F.lit(V.ABROAD_LABEL)).alias("area")
    logins = network_enrich(t.login, t.location, "ip", {"country": "country", "province": "province"})
    accounts = network_enrich(t.account, t.location, "ip", {"country": "country", "province": "province"})
    day = F.lit("2024-01-20").cast("date")
    seen = pv_uv(logins.where(F.col("day") == day), [area], user="mac", pv="logins", uv="users")
    base = users_where(
        accounts.where(F.col("day") <= day), [area], {"new_users": F.col("day") == day, "total_users": F.lit(True)}, user="mac"
    )
    both = funnel_join([seen, base], ["area"], how="full")
    return both.withColumn("active_users", F.col("users") - F.col("new_users"))


@report("versions_new_total_active", "N6")
def versions(t):
    day = F.lit("2024-01-20").cast("date")
    v = S.apk_version("current_version").alias("v")
    accounts = t.account.where(F.col("day") <= day)
    return new_active_total(
        {
            "new_users": pv_uv(accounts.where(F.col("day") == day), [v], user="user_id").drop("pv"),
            "total_users": pv_uv(accounts, [v], user="user_id").drop("pv"),
            "active_users": pv_uv(t.login.where(F.col("day") == day), [version().alias("v")], user="userId").drop("pv"),
        },
        ["v"], how="inner",
    )


@report("new_users_per_version_and_channel", "N7")
def new_per_version(t):
    return new_users(t, [S.apk_version("current_version").alias("version"), S.normalize_key("promotion_channel").alias("channel")])


@report("logins_per_version", "N8", "A2")
def per_version(t):
    return pv_uv(t.login, ["day", version().alias("version")], null_user="count")


@report("login_hours_per_version", "N9", "A16")
def hours(t):
    return pv_uv(t.login, [version().alias("version"), F.hour("datetime").alias("hour")], null_user="count").drop("pv")


@report("login_count_buckets", "N10", "A5")
def login_buckets(t):
    return count_histogram(t.login, "userId", [version().alias("version")], bucket=S.login_count_bucket, n="bucket")


@report("logins_per_device_brand", "N11")
def device_brands(t):
    return pv_uv(mac_brand_enrich(t.login, t.mac_brand, "mac", default="other"), ["day", "brand"], null_user="count")


@report("logins_per_model_and_brand", "N12", "U37", "SRC13")
def models(t):
    return pv_uv(brand_enrich(t.login, t.brand, "productModel"), ["productModel", "brand"], null_user="count")


@report("new_users_per_model", "N13")
def new_models(t):
    return new_users(t, ["product_model", "day"])


def _channel_counts(logins, accounts, how="full"):
    white = blacklist_filter(logins, "promotionChannel", ["ch7"], pattern=r"^[\w\-]+$")
    opened = blacklist_filter(accounts, "promotion_channel", ["ch7"], pattern=r"^[\w\-]+$")
    seen = pv_uv(white, [S.normalize_key("promotionChannel").alias("channel")], user="mac", pv="logins", uv="users")
    fresh = pv_uv(opened, [S.normalize_key("promotion_channel").alias("channel")], user="mac", uv="new_users").drop("pv")
    return funnel_join([seen, fresh], ["channel"], how=how)


@report("channels_new_and_logins", "N14", "J12")
def channels(t):
    return _channel_counts(t.login, t.account)


@report("channels_of_two_products", "N15")
def channels_two(t):
    kids = t.play2.select("userId", F.col("userId").alias("mac"), "promotionChannel")
    both = merge_sources([(t.login.select("userId", "mac", "promotionChannel"), "main"), (kids, "kids")])
    return _channel_counts(both, t.account)


@report("kids_channels", "N16")
def kids_channels(t):
    channel = S.normalize_key("promotionChannel", r"^\w+$").alias("channel")
    return pv_uv(t.play2.where(F.col("contentType") == "kids"), [channel], null_user="count")


@report("kids_access", "N17")
def kids_access(t):
    return pv_uv(t.play2.where(F.col("contentType") == "kids"), ["day"], null_user="count")


def _dogs(column):
    c = F.col(column)
    return {
        "all_users": F.lit(True), "ali_users": c.like("%3.1.1%"), "tv_users": c.like("%3.1.2%"),
        "other_users": ~c.like("%3.1.1%") & ~c.like("%3.1.2%"),
    }


@report("yun_active", "N18")
def yun_active(t):
    return users_where(t.login, ["day"], _dogs("version"), user="mac")


@report("yun_new", "N19")
def yun_new(t):
    return users_where(t.account.where(F.col("origin_type") == "yun"), ["day"], _dogs("current_version"), user="mac")


@report("yun_channels", "N20", "J12")
def yun_channels(t):
    fresh = pv_uv(t.account.where(F.col("origin_type") == "yun"), [F.col("promotion_channel").alias("channel")], user="mac", uv="new_users").drop("pv")
    active = pv_uv(t.login.where(F.col("promotionChannel").like("ch1%")), [F.col("promotionChannel").alias("channel")], user="mac", uv="active").drop("pv")
    return funnel_join([fresh, active], ["channel"], how="full")


@report("yun_logins", "N21")
def yun_logins(t):
    return pv_uv(t.login, ["day"], user="mac", where=F.col("version").like("%3.1.1%"), null_user="count")


@report("yun_new_total", "N22")
def yun_new_total(t):
    return t.account.where(F.col("origin_type") == "yun").select("mac").distinct().agg(F.count("mac").alias("new_users"))


@report("dogs_active_and_new", "N23")
def dogs(t):
    kind = F.when(F.col("v").like("%3.1.1%"), "ali").when(F.col("v").like("%3.1.2%"), "tv").otherwise("other").alias("version")
    active = pv_uv(t.login.withColumn("v", F.col("version")), [kind], user="mac")
    fresh = pv_uv(t.account.withColumn("v", F.col("current_version")), [kind], user="mac", uv="new_users").drop("pv")
    return funnel_join([active, fresh], ["version"], how="full")


@report("open_api_users", "N24", "SRC9")
def open_api(t):
    calls = parse_access_log(t.access).where(F.col("logType") == "play")
    return pv_uv(calls, ["day"], null_user="count")


@report("devices_per_province", "N25")
def provinces(t):
    placed = network_enrich(t.account, t.location, "ip", {"province": "province"}, default="未知")
    return placed.groupBy("province").agg(F.count(F.lit(1)).alias("n"))


@report("total_and_average_time", "N26")
def total_time(t):
    exits = t.login.where(F.col("duration").between(0, 54000))
    out = pv_uv(exits, ["day"])
    seconds = exits.groupBy("day").agg(F.sum("duration").alias("duration"))
    both = funnel_join([out, seconds], ["day"])
    return both.withColumn("week", D.week_span("day")).withColumn("average", F.col("duration") / F.nullif("uv", F.lit(0)))


@report("session_length_buckets", "N27", "U28")
def session_lengths(t):
    return pv_uv(t.login, ["day", S.duration_bucket("duration").alias("bucket")], null_user="count")


def _all_logs(t):
    logs = [(t.play, "play"), (t.home, "home"), (t.visit, "visit"), (t.livelog, "live"), (t.login, "login")]
    return merge_sources([(df.select("userId", "day"), name) for df, name in logs], flag="log_type")


@report("active_over_all_logs", "N28", "S3", "SRC4")
def all_active(t):
    return pv_uv(_all_logs(t), ["day"]).drop("pv")


@report("active_per_period_over_all_logs", "N29")
def all_periods(t):
    return period_rollup(_all_logs(t), "day", "userId", ["day", "week", "month"]).drop("pv")


@report("active_per_major_version", "N30", "U26")
def major(t):
    logs = t.play.select("userId", "apkVersion").unionByName(t.home.select("userId", "apkVersion")).unionByName(t.visit.select("userId", "apkVersion"))
    return pv_uv(logs, [S.major_version("apkVersion").alias("major")]).drop("pv")


@report("active_per_brand_and_channel", "N31")
def brand_channel(t):
    return pv_uv(brand_enrich(t.play, t.brand, "productModel"), ["brand", "promotionChannel"])


@report("model_users_per_period", "N32", "SRC6")
def model_periods(t):
    return period_rollup(t.play, "day", "userId", ["week", "month"], keys=["productModel"]).drop("pv")


@report("weekly_new_version_logins", "N33")
def weekly_new_version(t):
    log = t.login.where(S.version_at_least(version(), "3.1.4"))
    return period_rollup(log, "day", "userId", ["week"])
