"""How many users did something n times."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._keys import Key, as_list, join_on_keys, key_names
from .counts import with_totals

#: Counts of one block of a threshold curve.
CURVE_BLOCK = 1024


def count_histogram(
    df: DataFrame,
    entity: Key | Sequence[Key],
    by: Key | Sequence[Key] = (),
    value: Column | None = None,
    bucket: Callable[[Column], Column] | None = None,
    where: Column | str | None = None,
    having: Column | None = None,
    total: str | None = None,
    n: str = "n",
    users: str = "users",
) -> DataFrame:
    """Entities per count (or per bucket of the count), per ``by``.

    The count is the number of rows per entity, or ``value`` (an aggregate,
    such as a sum of seconds). ``having`` filters the counted column ``_n``.
    ``total`` adds the number of entities of the ``by`` group.
    """
    by, entity = as_list(by), as_list(entity)
    if where is not None:
        df = df.where(where)
    names = key_names(df, by)
    counted = df.groupBy(*by, *entity).agg((F.count(F.lit(1)) if value is None else value).alias("_n"))
    if having is not None:
        counted = counted.where(having)
    label = F.col("_n") if bucket is None else bucket(F.col("_n"))
    out = counted.groupBy(*names, label.alias(n)).agg(F.count(F.lit(1)).alias(users))
    return out if total is None else with_totals(out, names, users, total)


def threshold_curve(
    df: DataFrame,
    entity: Key | Sequence[Key],
    by: Key | Sequence[Key] = (),
    user: str | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """For every observed count n: users and plays of entities with count <= n.

    Columns (by, n, valid_uv, valid_pv, uv, pv). ``user`` is the column whose
    distinct values are "users"; it must be part of the entity. A user enters
    the curve at the smallest count of any of their entities, so one running
    sum replaces one query per threshold. Only the distinct counts of a group
    are sorted: their sum cannot exceed the number of rows, so N rows have at
    most sqrt(2N) of them. The running sum has two levels, inside blocks of
    ``CURVE_BLOCK`` counts and over the blocks, so that a curve without groups
    is not one task.
    """
    by, entity = as_list(by), as_list(entity)
    if where is not None:
        df = df.where(where)
    names = key_names(df, by)
    counted = df.groupBy(*by, *entity).agg(F.count(F.lit(1)).alias("n"))
    plays = counted.groupBy(*names, "n").agg(F.sum("n").alias("_pv"), F.count(F.lit(1)).alias("_entities"))
    if user is None:
        steps = plays.withColumn("_uv", F.col("_entities"))
    else:
        first = counted.groupBy(*names, user).agg(F.min("n").alias("n"))
        entered = first.where(F.col(user).isNotNull()).groupBy(*names, "n").agg(F.count(F.lit(1)).alias("_uv"))
        steps = (
            plays.select(*names, "n", "_pv", F.lit(0).cast("bigint").alias("_uv"))
            .unionByName(entered.select(*names, "n", F.lit(0).cast("bigint").alias("_pv"), "_uv"))
            .groupBy(*names, "n")
            .agg(F.sum("_pv").alias("_pv"), F.sum("_uv").alias("_uv"))
        )
    blocked = steps.withColumn("_block", F.floor(F.col("n") / CURVE_BLOCK))
    totals = blocked.groupBy(*names, "_block").agg(F.sum("_uv").alias("_bu"), F.sum("_pv").alias("_bp"))
    earlier = Window.partitionBy(*names).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*names)
    totals = totals.select(
        *names,
        "_block",
        F.coalesce(F.sum("_bu").over(earlier), F.lit(0)).alias("_u0"),
        F.coalesce(F.sum("_bp").over(earlier), F.lit(0)).alias("_p0"),
        F.sum("_bu").over(whole).alias("uv"),
        F.sum("_bp").over(whole).alias("pv"),
    )
    upto = Window.partitionBy(*names, "_block").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    inside = blocked.withColumn("_u1", F.sum("_uv").over(upto)).withColumn("_p1", F.sum("_pv").over(upto))
    return join_on_keys(inside, totals, [*names, "_block"]).select(
        *names, "n", (F.col("_u0") + F.col("_u1")).alias("valid_uv"), (F.col("_p0") + F.col("_p1")).alias("valid_pv"), "uv", "pv"
    )


def event_gaps(
    df: DataFrame, keys: Sequence[str], ts: str, slice_seconds: int = 86400
) -> DataFrame:
    """Seconds between successive events of a key, with how often each occurs
    at that moment: (keys, ts, gap_seconds, times).

    Events of a key in the same second become one row with a count first
    (combined on the map side), so a key that holds a third of the log is at
    most 86,400 rows a day; ``times`` of a zero gap is the count less one.
    The rest is compared within time slices, and the first event of a slice
    with the last one of the slice before, of which there is one row each, so
    that no task sorts a key over the whole calendar.
    """
    keys = list(keys)
    seconds = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, F.unix_timestamp(ts).alias("_s"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_slice", F.floor(F.col("_s") / slice_seconds))
    )
    within = Window.partitionBy(*keys, "_slice").orderBy("_s")
    inner = seconds.withColumn("_prev", F.lag("_s").over(within))
    ends = seconds.groupBy(*keys, "_slice").agg(F.min("_s").alias("_s"), F.max("_s").alias("_last"))
    across = Window.partitionBy(*keys).orderBy("_slice")
    outer = ends.withColumn("_prev", F.lag("_last").over(across))

    def gap(seconds: Column, times: Column) -> Column:
        return F.struct(seconds.cast("bigint").alias("gap_seconds"), times.cast("bigint").alias("times"))

    step = F.when(F.col("_prev").isNotNull(), gap(F.col("_s") - F.col("_prev"), F.lit(1)))
    same = F.when(F.col("_n") > 1, gap(F.lit(0), F.col("_n") - 1))
    found = F.explode(F.filter(F.array(step, same), lambda g: g.isNotNull())).alias("g")
    every = inner.select(*keys, "_s", found).unionByName(
        outer.where(F.col("_prev").isNotNull()).select(*keys, "_s", step.alias("g"))
    ).select(*keys, "_s", "g.gap_seconds", "g.times")
    return every.select(*keys, F.timestamp_seconds("_s").alias(ts), "gap_seconds", "times")
