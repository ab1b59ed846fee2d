"""Plays, users and durations.

Every operator here first reduces the log to one row per (keys, user) and then
to one row per keys. The first step combines on the map side, so a user, video
or channel that holds a third of all rows is one row per task before anything
is shuffled, and any number of conditional user counts needs no second pass
and no row expansion.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._keys import Key, as_column, as_list, join_on_keys, key_names, long_sum

START_EVENTS = ("startplay", "playview")


def _filtered(df: DataFrame, where: Column | str | None) -> DataFrame:
    return df if where is None else df.where(where)


def pv_uv(
    df: DataFrame,
    keys: Key | Sequence[Key] = (),
    user: Key = "userId",
    where: Column | str | None = None,
    null_user: str = "skip",
    pv: str = "pv",
    uv: str = "uv",
) -> DataFrame:
    """Rows and distinct users per key.

    ``null_user="skip"`` counts only rows with a user; ``"count"`` counts all
    rows and treats the missing user as one more user.
    """
    keys = as_list(keys)
    df = _filtered(df, where)
    names = key_names(df, keys)
    per_user = df.groupBy(*keys, as_column(user).alias("_user")).agg(F.count(F.lit(1)).alias("_rows"))
    counted = F.lit(True) if null_user == "count" else F.col("_user").isNotNull()
    return per_user.groupBy(*names).agg(
        long_sum(F.when(counted, F.col("_rows"))).alias(pv), F.count_if(counted).alias(uv)
    )


def users_where(
    df: DataFrame,
    keys: Key | Sequence[Key],
    conditions: Mapping[str, Column],
    user: Key = "userId",
    rows: Mapping[str, Column] | None = None,
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Several conditional user counts (row counts, and sums of whole numbers) in one pass.

    A sum without a value is 0, as are the counts.
    """
    keys = as_list(keys)
    names = key_names(df, keys)
    rows, sums = rows or {}, sums or {}
    per_user = df.groupBy(*keys, as_column(user).alias("_user")).agg(
        *[F.max(F.coalesce(c, F.lit(False))).alias(f"_c{i}") for i, c in enumerate(conditions.values())],
        *[F.count_if(c).alias(f"_r{i}") for i, c in enumerate(rows.values())],
        *[F.sum(c).alias(f"_s{i}") for i, c in enumerate(sums.values())],
    )
    known = F.col("_user").isNotNull()
    return per_user.groupBy(*names).agg(
        *[F.count_if(known & F.col(f"_c{i}")).alias(n) for i, n in enumerate(conditions)],
        *[long_sum(F.col(f"_r{i}")).alias(n) for i, n in enumerate(rows)],
        *[F.coalesce(F.sum(f"_s{i}"), F.lit(0)).alias(n) for i, n in enumerate(sums)],
    )


def pv_uv_duration(
    df: DataFrame,
    keys: Key | Sequence[Key] = (),
    user: Key = "userId",
    start: Column | None = None,
    dur: str = "duration",
    dur_rows: Column | None = None,
    low: int | None = None,
    high: int | None = None,
    how: str = "inner",
    avg: str | None = None,
    digits: int | None = None,
    dur_users: str | None = None,
    null_dur: str = "skip",
) -> DataFrame:
    """Starts, users and watched seconds per key, from one scan.

    Starts and durations sit on different rows: ``start`` marks the former,
    ``dur_rows`` the latter; bounds on the duration hold only where given. The
    usual rows: starts are startplay/playview, durations all but startplay.
    ``how`` says which keys stay: "inner" those with both kinds of rows,
    "left" those with starts, "full" those with either. ``avg`` names a column
    for seconds per starting user, ``dur_users`` one for users with a duration.
    """
    keys = as_list(keys)
    names = key_names(df, keys)
    start = F.col("event").isin(*START_EVENTS) if start is None else start
    rows = (F.col("event") != "startplay") if dur_rows is None else dur_rows
    seconds = F.col(dur) if null_dur == "skip" else F.coalesce(F.col(dur), F.lit(0))
    valid = rows & seconds.isNotNull()
    if low is not None:
        valid = valid & (seconds >= low)
    if high is not None:
        valid = valid & (seconds <= high)
    per_user = df.where(start | valid).groupBy(*keys, as_column(user).alias("_user")).agg(
        F.count_if(start).alias("_starts"),
        F.count_if(valid).alias("_valid"),
        F.sum(F.when(valid, seconds)).alias("_seconds"),
    )
    known = F.col("_user").isNotNull()
    out = per_user.groupBy(*names).agg(
        long_sum(F.when(known, F.col("_starts"))).alias("pv"),
        F.count_if(known & (F.col("_starts") > 0)).alias("uv"),
        F.sum("_seconds").alias("duration"),
        F.count_if(known & (F.col("_valid") > 0)).alias("_dur_users"),
        F.sum("_starts").alias("_any_start"),
        F.sum("_valid").alias("_any_valid"),
    )
    if how == "inner":
        out = out.where((F.col("_any_start") > 0) & (F.col("_any_valid") > 0))
    elif how == "left":
        out = out.where(F.col("_any_start") > 0)
    elif how != "full":
        raise ValueError(f"unknown how: {how}")
    if avg is not None:
        mean = F.col("duration") / F.when(F.col("uv") > 0, F.col("uv"))
        out = out.withColumn(avg, mean if digits is None else F.round(mean, digits))
    if dur_users is not None:
        out = out.withColumnRenamed("_dur_users", dur_users)
    return out.drop("_dur_users", "_any_start", "_any_valid")


#: Starts and watched seconds of plays: durations of up to three hours count.
play_duration = partial(pv_uv_duration, low=0, high=10800)


def sum_of(df: DataFrame, value: str, keys: Key | Sequence[Key] = (), where=None, name: str = "total") -> DataFrame:
    """Grand sum of one column."""
    return _filtered(df, where).groupBy(*as_list(keys)).agg(F.sum(value).alias(name))


def explode_contained(df: DataFrame, source: Key, literals: Sequence[str], name: str = "literal") -> DataFrame:
    """One row per literal that the column contains.

    A row may match several ('12' contains '1', '2' and '12'). The literals
    are an array constant, so this is neither a join nor a scan per literal.
    """
    text = as_column(source)
    wanted = F.array(*[F.lit(x) for x in literals])
    return df.withColumn(name, F.explode(F.filter(wanted, lambda x: text.contains(x))))


def pv_uv_contains(
    df: DataFrame,
    literals: Sequence[str],
    source: Key,
    user: Key = "userId",
    event: str | None = None,
    event_col: str = "event",
    type_col: str | None = None,
    type_value: str | None = None,
    ts: str | None = None,
    name: str = "literal",
) -> DataFrame:
    """pv and uv of each literal that the column contains, by hour with ``ts``.

    ``event`` must be equal, unless a ``type_col`` is given: then the event and
    the type both only have to be contained.
    """
    if event is not None:
        col = F.col(event_col)
        df = df.where(col.contains(event) if type_col else col == event)
    if type_col is not None:
        df = df.where(F.col(type_col).contains(type_value))
    matched = explode_contained(df, source, literals, name)
    keys: list[Key] = [name]
    if ts is not None:
        keys.append(F.hour(ts).alias("hour"))
    return pv_uv(matched, keys, user)


def stack_metrics(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Union frames of (keys, metrics) with a presence mark per frame."""
    out = None
    for i, frame in enumerate(frames):
        marked = frame.withColumn(f"_in{i}", F.lit(True))
        out = marked if out is None else out.unionByName(marked, allowMissingColumns=True)
    return out


def funnel_join(
    frames: Sequence[DataFrame], keys: Sequence[str], how: str = "inner", default: int | None = 0
) -> DataFrame:
    """Put several metrics of the same keys side by side.

    Each frame has the keys (once per key) and its own metric columns. Instead
    of a chain of joins the frames are unioned and grouped once, which treats
    a null key like any other. ``how`` is "inner" (keys in every frame),
    "left" (keys of the first) or "full" with ``default`` for what is missing.
    """
    keys = list(keys)
    stacked = stack_metrics(frames, keys)
    metrics = [c for c in stacked.columns if c not in keys and not c.startswith("_in")]
    marks = [f"_in{i}" for i in range(len(frames))]
    out = stacked.groupBy(*keys).agg(
        *[F.max(m).alias(m) for m in metrics], *[F.max(m).alias(m) for m in marks]
    )
    if how == "inner":
        for m in marks:
            out = out.where(F.col(m))
    elif how == "left":
        out = out.where(F.col(marks[0]))
    elif how != "full":
        raise ValueError(f"unknown how: {how}")
    out = out.drop(*marks)
    return out if default is None or not metrics else out.fillna(default, subset=metrics)


def conversion_ratio(
    numerator: DataFrame,
    denominator: DataFrame,
    keys: Sequence[str],
    num: str,
    den: str,
    name: str = "ratio",
    how: str = "inner",
    digits: int | None = None,
) -> DataFrame:
    """num / den of the shared keys; null where the denominator is 0."""
    both = funnel_join([numerator, denominator], keys, how=how)
    ratio = F.col(num) / F.when(F.col(den) != 0, F.col(den))
    return both.withColumn(name, ratio if digits is None else F.round(ratio, digits))


def adoption_ratio(
    df: DataFrame,
    condition: Column,
    keys: Key | Sequence[Key] = (),
    user: Key = "userId",
    digits: int | None = None,
) -> DataFrame:
    """Distinct users that meet a condition, and their share of all users."""
    counted = users_where(df, keys, {"adopted": condition, "users": F.lit(True)}, user)
    share = F.col("adopted") / F.when(F.col("users") > 0, F.col("users"))
    return counted.withColumn("share", share if digits is None else F.round(share, digits))


def new_active_total(
    parts: Mapping[str, DataFrame], keys: Sequence[str], how: str = "full"
) -> DataFrame:
    """New, active and total (or any other) counts of the same keys.

    ``parts`` maps the metric name to a frame whose one non-key column is the
    count. Missing counts are 0; ``how="inner"`` keeps only complete keys.
    """
    frames = []
    for name, frame in parts.items():
        (value,) = [c for c in frame.columns if c not in keys]
        frames.append(frame.select(*keys, F.col(value).alias(name)))
    return funnel_join(frames, keys, how=how)


def with_totals(
    df: DataFrame, keys: Sequence[str], value: str, name: str, scope: DataFrame | None = None
) -> DataFrame:
    """Add the sum of ``value`` over all rows with the same ``keys``.

    A grouped sum joined back, not a window: a group with a third of all rows
    must not end in one task. Without keys it is a scalar subquery.
    """
    base = df if scope is None else scope
    if not keys:
        return df.withColumn(name, base.agg(F.sum(value).alias(name)).scalar())
    totals = base.groupBy(*keys).agg(F.sum(value).alias(name))
    return join_on_keys(df, totals, keys)


def share_of_group(
    df: DataFrame, group: Sequence[str], metric: str, name: str = "share", digits: int | None = None
) -> DataFrame:
    """metric / sum(metric) within the group."""
    totalled = with_totals(df, group, metric, "_total")
    share = F.col(metric) / F.when(F.col("_total") != 0, F.col("_total"))
    return totalled.withColumn(name, share if digits is None else F.round(share, digits)).drop("_total")


def running_total(df: DataFrame, order: str, value: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Total carried from day to day. ``df`` holds one row per key and day, so
    a window partition is as long as the calendar, not as the data."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(value).over(w))
