"""New-user quality and identity."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.counts import play_duration, pv_uv
from ..operators.identity import dedup_by_model, dedup_identity, same_device_keys, unmatched_logins
from ..operators.rollout import dup_alert, non_play_rate
from .registry import report

SHARED = ["model1", "model4", "model9"]


def _marked(t):
    return dedup_identity(t.account, same_device_keys())


def _as_new(frame, *extra):
    return frame.select(F.col("user_id").alias("userId"), "day", *extra)


def _actions(t):
    return t.play.select("userId", "day").unionByName(t.home.select("userId", "day")).unionByName(t.visit.select("userId", "day"))


@report("acted_among_rejected", "I1", "SRC3")
def rejected(t):
    return non_play_rate(_as_new(_marked(t).where("is_duplicate")), _actions(t))


@report("played_among_accepted", "I2")
def accepted(t):
    return non_play_rate(_as_new(_marked(t).where("NOT is_duplicate")), t.play)


@report("played_per_model", "I3", "J9")
def per_model(t):
    return non_play_rate(_as_new(t.account, "product_model"), t.play, ["product_model"], horizon=3)


@report("played_per_channel", "I4")
def per_channel(t):
    return non_play_rate(_as_new(t.account, "promotion_channel"), t.play, ["promotion_channel"], horizon=3)


@report("duplicate_wifi_macs", "I5", "A8", "SNK3")
def wifi_alert(t):
    known = t.account.where(F.col("wifi_mac").isNotNull() & (F.col("wifi_mac") != ""))
    first, last = F.lit("2024-01-10").cast("date"), F.lit("2024-01-16").cast("date")
    fresh = known.where(F.col("day").between(first, last))
    wifi = dup_alert(known, "wifi_mac", 3, {"2": "promotion_channel", "3": "product_model"}, among=fresh, kind="1")
    ips = dup_alert(fresh, "ip", 2, kind="4")
    return wifi.unionByName(ips)


@report("account_duplicates", "I6", "J18")
def duplicates(t):
    return _marked(t).select("id", "user_id", "is_duplicate", "original")


@report("account_duplicates_listed_models", "I7")
def duplicates_listed(t):
    return dedup_by_model(t.account, SHARED, only_listed=True).select("id", "is_duplicate", "original")


@report("account_duplicates_by_model", "I8", "U39")
def duplicates_by_model(t):
    return dedup_by_model(t.account, SHARED).select("id", "is_duplicate", "original")


@report("anonymous_logins_without_account", "I9", "U39")
def anonymous(t):
    log = t.login.select(F.when(F.col("log_type") == "click", F.col("userId")).alias("userId"), "mac", "wifiMac", "productModel")
    return unmatched_logins(log, t.account, SHARED, F.lit("2024-01-15").cast("timestamp"))


@report("accepted_users_per_channel", "I11")
def accepted_channel(t):
    return pv_uv(_marked(t).where("NOT is_duplicate"), ["day", "promotion_channel"], user="user_id", uv="n").drop("pv")


@report("watch_time_of_rejected", "I13")
def rejected_time(t):
    gone = _marked(t).where("is_duplicate").select(F.col("user_id").alias("userId"))
    plays = t.play.join(gone, "userId", "left_semi")
    return play_duration(plays, [], avg="average")
