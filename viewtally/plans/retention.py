"""Retention reports: cohorts and activity logs put into one operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import periods as D
from ..functions import scalars as S
from ..operators.enrich import dim_enrich, network_enrich
from ..operators.identity import dedup_identity, same_device_keys
from ..operators.retention import cohort_retention, retention_wide, step_retention
from ..operators.rollout import accumulate_new
from .registry import report

MODELS = ["model1", "model2", "model3"]


def new_users(t):
    """Accounts by opening day, with the columns reports split by."""
    return t.account.select(
        F.col("user_id").alias("userId"), "mac", "day", "product_model", "promotion_channel",
        S.apk_version("current_version").alias("version"), "ip",
    )


def active(t):
    return t.login.select("userId", "mac", "day", S.apk_version("version").alias("version"))


def _new(t, dims=(), cohort=None, activity=None, **options):
    return cohort_retention(
        new_users(t) if cohort is None else cohort, active(t) if activity is None else activity, dims=dims, **options
    )


@report("retention_new_users", "R1", "S4", "J9", "U34")
def r1(t):
    return _new(t)


@report("retention_new_users_wide", "R1", "SNK4")
def r1_wide(t):
    return retention_wide(_new(t), ["day"])


@report("retention_cleaned_users", "R2")
def r2(t):
    marked = dedup_identity(t.account, same_device_keys())
    kept = marked.where(~F.col("is_duplicate")).select(F.col("user_id").alias("userId"), "day")
    return _new(t, cohort=kept)


@report("retention_by_model", "R3")
def r3(t):
    return _new(t, ["product_model"], cohort=new_users(t).where(F.col("product_model").isin(MODELS)), drop_zero=True)


@report("retention_by_channel", "R4")
def r4(t):
    return _new(t, ["promotion_channel"])


@report("retention_by_channel_cleaned", "R5")
def r5(t):
    marked = dedup_identity(t.account, same_device_keys())
    kept = marked.where(~F.col("is_duplicate")).select(F.col("user_id").alias("userId"), "day", "promotion_channel")
    return _new(t, ["promotion_channel"], cohort=kept)


@report("retention_any_day_since", "R6")
def r6(t):
    return step_retention(new_users(t), active(t), user="mac")


@report("retention_template", "R7")
def r7(t):
    return _new(t, ["product_model"], offsets=(1,))


@report("retention_every_day", "R8")
def r8(t):
    return _new(t, offsets=tuple(range(1, 21)))


def _dau(name, row, condition=None, dims=(), user="userId"):
    """Users active on a day that are active again k days later."""

    @report(name, row)
    def run(t):
        log = active(t)
        if callable(condition):
            log = condition(log)
        return cohort_retention(log, log.select(user, "day"), dims=dims, user=user)


def _white_black(log):
    return log.withColumn("kind", F.when(F.col("version") >= "3.1.4", "white").otherwise("black"))


def _band(log):
    return log.withColumn("band", S.version_band("version", ["3.1.5", "3.1.6"], oldest="3.1.4"))


_dau("dau_retention_white_and_black", "R9", _white_black, ["kind"])
_dau("dau_retention", "R10")
_dau("dau_retention_since_314", "R11", lambda log: log.where(F.col("version") >= "3.1.4"))
_dau("dau_retention_by_band", "R12", _band, ["band"])
_dau("dau_retention_313", "R13", lambda log: log.where(F.col("version") == "3.1.3"))
_dau("dau_retention_315", "R14", lambda log: log.where(F.col("version") == "3.1.5"), user="mac")


@report("retention_all_and_since_314", "R15")
def r15(t):
    """Each user counts under 'all' and, if new enough, under 'new'."""
    kinds = F.array(F.lit("all"), F.when(F.col("version") >= "3.1.4", F.lit("new")))
    cohort = new_users(t).withColumn("kind", F.explode(F.filter(kinds, lambda k: k.isNotNull())))
    return _new(t, ["kind"], cohort=cohort)


@report("retention_all_and_315", "R16")
def r16(t):
    kinds = F.array(F.lit("all"), F.when(F.col("version") == "3.1.5", F.lit("3.1.5")))
    cohort = new_users(t).withColumn("kind", F.explode(F.filter(kinds, lambda k: k.isNotNull())))
    return _new(t, ["kind"], cohort=cohort)


@report("retention_since_314_by_version", "R17")
def r17(t):
    return _new(t, ["version"], cohort=new_users(t).where(F.col("version") >= "3.1.4"))


@report("retention_old_users_of_314", "R18")
def r18(t):
    """Users active with 3.1.4 on a day who opened their account before it."""
    accounts = t.account.select(F.col("user_id").alias("userId"), F.col("day").alias("opened"))
    log = active(t).where(F.col("version") == "3.1.4").select("userId", "day").distinct()
    old = log.join(accounts, "userId").where(F.col("opened") < F.col("day")).select("userId", "day")
    return _new(t, cohort=old)


@report("retention_by_version_band", "R19", "F12")
def r19(t):
    band = S.version_band("version", ["3.1.4", "3.1.5", "3.1.6"], oldest="3.1.4").alias("band")
    return _new(t, ["band"], cohort=new_users(t).select("userId", "day", band), offsets=(1,), digits=4)


@report("retention_weekly", "R20")
def r20(t):
    week = D.period_start("day", "week").alias("day")
    first = accumulate_new(None, active(t).where(F.col("version") >= "3.1.4"), ["mac"], "day")
    return cohort_retention(
        first.select("mac", week), t.login.select("mac", week), offsets=(1, 2, 3), user="mac", unit="week"
    )


@report("retention_upgraded_users", "R21")
def r21(t):
    first = accumulate_new(None, active(t).where(F.col("version") >= "3.1.4"), ["userId"], "day")
    return _new(t, cohort=first)


@report("retention_by_city_level", "R22")
def r22(t):
    placed = network_enrich(new_users(t), t.location, "ip", {"city": "city"})
    levels = t.nation.select(
        F.concat(F.lit("city"), F.col("n_nationkey").cast("string")).alias("city"),
        F.when(F.col("n_regionkey") == 0, "a").when(F.col("n_regionkey") == 1, "b").alias("level"),
    )
    return _new(t, ["level"], cohort=dim_enrich(placed, levels, ["city"], {"level": "level"}, default="c"), offsets=(1,), digits=4)


@report("retention_listed_models", "R23")
def r23(t):
    kind = F.when(F.col("product_model").isin(MODELS), "listed").otherwise("other").alias("kind")
    return _new(t, ["kind"], cohort=new_users(t).select("userId", "day", kind))


@report("retention_listed_models_each", "R24")
def r24(t):
    return _new(t, ["product_model"], cohort=new_users(t).where(F.col("product_model").isin(MODELS)))


@report("retention_one_vendor_by_channel", "R25")
def r25(t):
    return _new(t, ["promotion_channel"], cohort=new_users(t).where(F.col("product_model") == "model3"))


def _fall_back(t, offsets):
    """Devices that used 3.1.4 or newer on a day and whose account shows an
    older version in the snapshot ``offset`` days later: counted as fallen
    back, per day and offset. A snapshot holds the accounts opened until then."""
    log = active(t).where(F.col("version") >= "3.1.4").select("mac", "day").distinct()
    older = t.account.where((S.apk_version("current_version") < "3.1.4") & F.col("mac").isNotNull())
    back = older.groupBy("mac").agg(F.min(F.to_date("openTime")).alias("_since"))
    counted = log.join(back, "mac", "left").groupBy("day").agg(
        F.count(F.lit(1)).alias("users"), *[F.count_if(F.col("_since") <= F.date_add("day", o)).alias(f"_{o}") for o in offsets]
    )
    each = F.explode(F.array(*[F.struct(F.lit(o).alias("offset"), F.col(f"_{o}").alias("fallen_back")) for o in offsets])).alias("e")
    out = counted.select("day", "users", each).select("day", "e.offset", "users", "e.fallen_back")
    return out.withColumn("rate", F.col("fallen_back") / F.col("users"))


@report("version_fall_back", "R26")
def r26(t):
    return _fall_back(t, (0, 1, 3, 7, 14))


@report("version_fall_back_fourteen_days", "R26")
def r26_each_day(t):
    return _fall_back(t, range(1, 15))


@report("member_month_retention", "R27", "SRC6")
def r27(t):
    """First monthly orders of a month with another order months later."""
    orders = t.member.where(F.col("good_sk") == 0)
    return cohort_retention(
        orders.where(F.col("is_first_cont_mon_order") == 1), orders, offsets=(1, 2, 3), user="account_sk", unit="month"
    )
