"""Who of a cohort comes back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The day offsets every retention report uses.
OFFSETS = (1, 2, 3, 4, 5, 6, 7, 14, 30)
OFFSET_NAMES = {
    1: "one", 2: "two", 3: "three", 4: "four", 5: "five", 6: "six", 7: "seven", 14: "fourteen", 30: "thirty",
}


def _shift(day: str, offset: Column, unit: str) -> Column:
    start = F.col(day)
    if unit == "day":
        return F.date_add(start, offset)
    if unit == "week":
        return F.date_add(start, offset * 7)
    if unit == "month":
        return F.add_months(start, offset)
    raise ValueError(f"unknown unit: {unit}")


def _last_day(activity: DataFrame, day: str, until: str | Column | None) -> Column:
    if until is None:
        return activity.agg(F.max(day).alias("last")).scalar()
    return F.lit(until).cast("date") if isinstance(until, str) else until


def cohort_retention(
    cohort: DataFrame,
    activity: DataFrame,
    offsets: Sequence[int] = OFFSETS,
    dims: Sequence[str] = (),
    user: str = "userId",
    day: str = "day",
    activity_user: str | None = None,
    activity_day: str | None = None,
    unit: str = "day",
    until: str | Column | None = None,
    digits: int | None = None,
    drop_zero: bool = False,
) -> DataFrame:
    """Users of each cohort day active exactly k days (weeks, months) later:
    (day, dims, offset, users, kept, rate).

    Both sides are first reduced to one row per user and day, and the cohort
    gets one row per offset, so the join is an equi join on (user, day) that
    no busy user can skew or fan out. All offsets come from one scan of each
    log. Offsets that end after the last day of the activity log (or
    ``until``) are left out, because nothing can be known about them.
    """
    members = cohort.where(F.col(user).isNotNull()).select(F.col(user).alias("_user"), F.col(day).alias("_day"), *dims)
    members = members.distinct()
    active = (
        activity.select(
            F.col(activity_user or user).alias("_user"), F.col(activity_day or day).alias("_target")
        )
        .where(F.col("_user").isNotNull())
        .distinct()
        .withColumn("_hit", F.lit(1))
    )
    last = _last_day(activity, activity_day or day, until)
    wanted = (
        members.withColumn("offset", F.explode(F.array(*[F.lit(k) for k in offsets])))
        .withColumn("_target", _shift("_day", F.col("offset"), unit))
        .where(F.col("_target") <= last)
    )
    out = (
        wanted.join(active, ["_user", "_target"], "left")
        .groupBy(F.col("_day").alias(day), *dims, "offset")
        .agg(F.count(F.lit(1)).alias("users"), F.count("_hit").alias("kept"))
    )
    rate = F.col("kept") / F.col("users")
    out = out.withColumn("rate", rate if digits is None else F.round(rate, digits))
    return out.where(F.col("kept") > 0) if drop_zero else out


def day_span(day: str, longest: int) -> Column:
    """Number of the span of ``longest + 1`` days a day lies in."""
    return F.floor(F.unix_date(F.col(day).cast("date")) / (longest + 1))


def day_spans(members: DataFrame, day: str, longest: int) -> DataFrame:
    """Members once for each span (``_span``) that the days from ``day`` to ``longest`` days later touch."""
    last = F.floor((F.unix_date(F.col(day).cast("date")) + longest) / (longest + 1))
    return members.withColumn("_span", F.explode(F.sequence(day_span(day, longest), last)))


def step_retention(
    cohort: DataFrame,
    activity: DataFrame,
    offsets: Sequence[int] = OFFSETS,
    dims: Sequence[str] = (),
    user: str = "userId",
    day: str = "day",
    until: str | Column | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Users active on any day from the cohort day up to k days later.

    The join finds each member's first active day of the window; every offset
    follows from that one number. Days are cut into spans as long as the window,
    of which a member's window touches two, so that the join is on user and span
    and a member meets no more than the active days of two windows.
    """
    longest = max(offsets)
    members = cohort.where(F.col(user).isNotNull()).select(F.col(user).alias("_user"), F.col(day).alias("_day"), *dims)
    members = members.distinct()
    active = activity.select(F.col(user).alias("_user"), F.col(day).alias("_active")).distinct()
    last = _last_day(activity, day, until)
    gap = F.datediff("_active", "_day")
    first = (
        day_spans(members, "_day", longest)
        .join(active.withColumn("_span", day_span("_active", longest)), ["_user", "_span"])
        .where(gap.between(0, longest))
        .groupBy("_user", "_day", *dims)
        .agg(F.min(gap).alias("_gap"))
    )
    # members without any activity count in the base only
    every = members.select("_user", "_day", *dims, F.lit(None).cast("int").alias("_gap")).unionByName(first)
    per_member = every.groupBy("_user", "_day", *dims).agg(F.min("_gap").alias("_gap"))
    out = (
        per_member.withColumn("offset", F.explode(F.array(*[F.lit(k) for k in offsets])))
        .where(F.date_add(F.col("_day"), F.col("offset")) <= last)
        .groupBy(F.col("_day").alias(day), *dims, "offset")
        .agg(F.count(F.lit(1)).alias("users"), F.count_if(F.col("_gap") <= F.col("offset")).alias("kept"))
    )
    rate = F.col("kept") / F.col("users")
    return out.withColumn("rate", rate if digits is None else F.round(rate, digits))


def retention_wide(
    rates: DataFrame, keys: Sequence[str], offsets: Sequence[int] = OFFSETS, value: str = "rate"
) -> DataFrame:
    """One column per offset (one, two, ..., thirty); the offsets are listed,
    so the pivot needs no extra scan to find them."""
    wide = rates.groupBy(*keys).pivot("offset", list(offsets)).agg(F.first(value))
    for k in offsets:
        wide = wide.withColumnRenamed(str(k), OFFSET_NAMES.get(k, f"d{k}"))
    return wide
