"""Calendar periods and day ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import column

PERIODS = ("day", "week", "month", "quarter", "year")


def period_start(day, period: str) -> Column:
    """First day of the period that holds ``day`` (weeks start on Monday)."""
    if period not in PERIODS:
        raise ValueError(f"unknown period: {period}")
    return F.date_trunc(period, column(day)).cast("date")


def period_end(day, period: str) -> Column:
    step = {"day": "1 DAY", "week": "7 DAY", "month": "1 MONTH", "quarter": "3 MONTH", "year": "1 YEAR"}[period]
    return F.date_add((period_start(day, period) + F.expr(f"INTERVAL {step}")).cast("date"), -1)


def week_span(day) -> Column:
    """'yyyy-MM-dd~yyyy-MM-dd' of the Monday-to-Sunday week."""
    return F.concat_ws("~", period_start(day, "week").cast("string"), period_end(day, "week").cast("string"))


def period_label(day, period: str) -> Column:
    start = period_start(day, period)
    if period == "week":
        return week_span(day)
    if period == "month":
        return F.date_format(start, "yyyy-MM")
    if period == "quarter":
        return F.concat(F.year(start).cast("string"), F.lit("Q"), F.quarter(start).cast("string"))
    if period == "year":
        return F.year(start).cast("string")
    return start.cast("string")


def period_range(first, last) -> Column:
    """All days from ``first`` to ``last``, as an array."""
    return F.sequence(column(first).cast("date"), column(last).cast("date"))


def is_period_close(day, period: str) -> Column:
    """Whether a run on ``day`` closes the period before it."""
    day = column(day)
    return period_start(day, period) == day
