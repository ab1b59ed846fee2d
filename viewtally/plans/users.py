"""The user base."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.counts import funnel_join, new_active_total, pv_uv, running_total, share_of_group, users_where
from ..operators.distributions import count_histogram
from ..operators.enrich import brand_enrich
from ..operators.rollout import accumulate_new, new_keys
from ..operators.rollups import period_rollup
from .registry import report

DAY = "2024-01-20"


def _day():
    return F.lit(DAY).cast("date")


def _until(t):
    return t.account.where(F.col("day") <= _day())


def _new_total(accounts, keys):
    return users_where(accounts, keys, {"new_users": F.col("day") == _day(), "total_users": F.lit(True)}, user="user_id")


@report("cumulative_users_per_model", "B1")
def per_model(t):
    return pv_uv(_until(t), ["product_model"], user="user_id", uv="users").drop("pv")


@report("new_users_per_channel", "B2")
def per_channel(t):
    return pv_uv(t.account, ["day", "promotion_channel"], user="user_id", uv="new_users").drop("pv")


@report("new_and_total_per_brand", "B3", "J11")
def per_brand(t):
    return _new_total(brand_enrich(_until(t), t.brand, "product_model"), ["brand"])


@report("new_and_total_per_model", "B4")
def new_total_model(t):
    return _new_total(_until(t), ["product_model"])


@report("new_total_active_per_channel_and_model", "B5", "J13")
def per_channel_model(t):
    keys = ["channel", "model"]
    base = _new_total(_until(t), [F.col("promotion_channel").alias("channel"), F.col("product_model").alias("model")])
    active = pv_uv(
        t.login.where(F.col("day") == _day()), [F.col("promotionChannel").alias("channel"), F.col("productModel").alias("model")], uv="active_users"
    ).drop("pv")
    return funnel_join([base, active], keys, how="full")


@report("new_users_and_logins_per_period", "B6", "B8")
def per_period(t):
    periods = ["day", "week", "month", "quarter", "year"]
    fresh = period_rollup(t.account, "day", "user_id", periods, uv="new_users").drop("pv")
    seen = period_rollup(t.login, "day", "userId", periods)
    return funnel_join([fresh, seen], ["period", "start"], how="full")


@report("details_and_plays_per_period", "B7")
def details_plays(t):
    periods = ["day", "week", "month"]
    details = period_rollup(t.visit.where(F.col("event") == "view"), "day", "userId", periods, uv="detail_users").drop("pv")
    start = F.col("event").isin("startplay", "playview")
    watched = (F.col("event") != "startplay") & F.col("duration").between(0, 10800)
    started = F.when(start & F.col("userId").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    plays = period_rollup(
        t.play.where(start | watched), "day", "userId", periods, sums={"plays": started, "duration": F.when(watched, F.col("duration"))},
        users={"play_users": start, "watch_users": watched},
    )
    return funnel_join([details, plays.drop("pv", "uv")], ["period", "start"], how="full")


@report("users_per_version", "B9")
def per_version(t):
    return pv_uv(t.account, [S.apk_version("current_version").alias("version")], user="user_id", uv="users").drop("pv")


@report("active_and_new_per_brand", "B10", "J12", "W7")
def active_new_brand(t):
    active = pv_uv(brand_enrich(t.login, t.brand, "productModel"), ["brand"], user="mac", uv="active_users").drop("pv")
    fresh = pv_uv(brand_enrich(t.account, t.brand, "product_model"), ["brand"], user="mac", uv="new_users").drop("pv")
    return new_active_total({"active_users": active, "new_users": fresh}, ["brand"]).orderBy(F.col("active_users").desc())


@report("channel_share_of_brand", "B11", "A6")
def channel_share(t):
    counted = pv_uv(
        brand_enrich(t.account, t.brand, "product_model"), ["brand", S.normalize_key("promotion_channel").alias("channel")], user="user_id", uv="n"
    ).drop("pv")
    return share_of_group(counted, ["brand"], "n")


@report("new_users_on_other_devices", "B12", "U38")
def non_ott(t):
    """Devices of the listed models, which are no boxes; any other and an unknown model is a box."""
    no_boxes = ["model1", "model2", "model3"]
    other = t.account.where(F.col("product_model").isin(no_boxes))
    return pv_uv(other, ["promotion_channel"], user="mac", uv="n", null_user="count").drop("pv")


@report("total_users_per_channel", "B13")
def total_channel(t):
    return pv_uv(_until(t), ["promotion_channel"], user="user_id", uv="n").drop("pv")


@report("ages", "B14", "U29")
def ages(t):
    people = t.person.select(F.col("birth").alias("year"), S.age_band("birth", 2024).alias("age"))
    known = people.where(F.col("age").isNotNull())
    year = F.when(F.col("age") == "其他", F.lit("其他")).otherwise(F.col("year"))
    return known.groupBy(year.alias("year"), "age").agg(F.count(F.lit(1)).alias("n"))


@report("genders", "B15", "U31")
def genders(t):
    coded = t.person.withColumn("code", S.gender_code("gender"))
    return coded.groupBy().pivot("code", ["f", "m", "o", "0"]).agg(F.count(F.lit(1))).withColumnRenamed("0", "empty")


@report("regions", "B16", "U30")
def regions(t):
    return t.person.select(S.region_parts("area").alias("r")).select("r.*").groupBy("province", "city").agg(F.count(F.lit(1)).alias("n"))


@report("account_events", "B17")
def account_events(t):
    return pv_uv(t.accountlog, ["event", F.month("day").alias("month")])


@report("account_logins_by_path", "B18")
def account_paths(t):
    return pv_uv(t.accountlog, ["path"], where=F.col("event") == "login", null_user="count")


@report("account_logins", "B19")
def account_total(t):
    return pv_uv(t.accountlog, [], where=(F.col("event") == "login") & F.col("path").isin("home", "history", "collect", "comment"))


@report("accounts_ever_used", "B20", "S5")
def ever_used(t):
    first = accumulate_new(None, t.accountlog, ["userId"], "day")
    daily = first.groupBy("day").agg(F.count(F.lit(1)).alias("new_users"))
    return running_total(daily, "day", "new_users", "total_users")


@report("new_account_ids_of_last_days", "B20", "S4", "S5")
def new_ids(t):
    split = F.lit("2024-01-03").cast("date")
    before, after = t.accountlog.where(F.col("day") < split), t.accountlog.where(F.col("day") >= split)
    fresh = new_keys(before, after, ["userId", "accountId"])
    return fresh.groupBy("accountId").agg(F.count(F.lit(1)).alias("new_pairs"))


@report("accounts_per_user", "B21", "A4")
def accounts_per_user(t):
    return count_histogram(t.accountlog.select("userId", "accountId").distinct(), "userId", n="accounts")
