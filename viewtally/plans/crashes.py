"""Crashes and daily activity by version."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.crashes import crash_counts, crash_trend
from ..operators.rollups import rollup_all
from .registry import report

LEVELS = [["APP_VERSION_NAME", "DATE_CODE", "PRODUCT_CODE"], ["APP_VERSION_NAME", "DATE_CODE"], ["PRODUCT_CODE"], []]


@report("crashes_per_device", "X1")
def per_device(t):
    return crash_counts(t.crash)


def _testers(t):
    return t.account.where(F.col("userType") == 3).select("mac")


@report("crash_trend", "X2", "A9")
def trend(t):
    return crash_trend(t.crash, LEVELS, test_devices=_testers(t), version_length=5, date_length=20)


@report("crash_trend_without_noise", "X3")
def trend_calm(t):
    return crash_trend(t.crash, LEVELS, test_devices=_testers(t), cap=2, version_length=5, date_length=20)


@report("daily_activity_levels", "X4", "A9")
def activity(t):
    levels = [["apkVersion", "locationIndex", "productModel"], ["apkVersion", "locationIndex"], ["productModel"], []]
    log = t.home.where(F.length("apkVersion") == 5)
    login = F.coalesce((F.col("event") == "click").cast("long"), F.lit(0))
    return rollup_all(log, levels, "userId", sums={"logins": login}, uv="users").drop("pv").where("logins > 0")


@report("activity_without_version", "X4")
def without_version(t):
    """Everything but one version, next to each version's own numbers."""
    versions = F.array(F.lit("All but 3.1.4"), F.lit("All but 3.1.5"))
    shares = F.filter(versions, lambda v: ~v.endswith(F.col("apkVersion")))
    log = t.home.where(F.length("apkVersion") == 5).withColumn("version", F.explode(shares))
    return rollup_all(log, [["version"]], "userId")
