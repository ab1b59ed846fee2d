"""Counts at several grains at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.periods import PERIODS, period_label, period_start
from ._keys import Key, as_column, as_list, key_names, long_sum

ALL = "All"


def rollup_all(
    df: DataFrame,
    levels: Sequence[Sequence[str]],
    user: Key,
    sums: Mapping[str, Column] | None = None,
    pv: str = "pv",
    uv: str = "uv",
    null_label: str | None = "null",
    all_label: str = ALL,
) -> DataFrame:
    """Rows, distinct users and sums at every grouping level; the columns a
    level leaves out hold 'All'.

    The log is reduced to one row per (finest keys, user) before the grouping
    sets repeat rows, so the repetition is paid on users, not on events. The
    reduced rows are dealt by user first and repeated where they arrive, in as
    many parts as ``spark.sql.shuffle.partitions`` says: a task that repeats
    rows holds one part of them, and the repeated rows are not shuffled. A user
    has no more of these rows than there are finest keys; those without a user
    are dealt by a hash of the keys. Null keys read ``null_label``, so they
    differ from 'All'.
    """
    sums = sums or {}
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    finest = list(dict.fromkeys(c for level in levels for c in level))
    partial = df.groupBy(*finest, as_column(user).alias("_user")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_s{i}") for i, c in enumerate(sums.values())]
    )
    nobody = F.col("_user").isNull()
    partial = partial.withColumn("_part", F.when(nobody, F.xxhash64(F.lit(0), *finest)).otherwise(F.lit(0))).repartition(parts, "_user", "_part")
    for c in finest:
        text = F.col(c).cast("string")
        partial = partial.withColumn(c, text if null_label is None else F.coalesce(text, F.lit(null_label)))
    labelled = partial.withColumn(
        "_level",
        F.explode(
            F.array(
                *[
                    F.struct(*[(F.col(c) if c in level else F.lit(all_label)).alias(c) for c in finest])
                    for level in levels
                ]
            )
        ),
    )
    keyed = [F.col(f"_level.{c}").alias(c) for c in finest]
    per_user = labelled.groupBy(*keyed, "_user", "_part").agg(
        F.sum("_rows").alias("_rows"), *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(sums))]
    )
    known = F.col("_user").isNotNull()
    return per_user.groupBy(*finest).agg(
        long_sum(F.col("_rows")).alias(pv),
        F.count_if(known).alias(uv),
        *[F.sum(f"_s{i}").alias(name) for i, name in enumerate(sums)],
    )


def period_rollup(
    df: DataFrame,
    day: str,
    user: Key,
    periods: Sequence[str] = PERIODS,
    keys: Key | Sequence[Key] = (),
    sums: Mapping[str, Column] | None = None,
    pv: str = "pv",
    uv: str = "uv",
    users: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rows, distinct users and sums per day, week, month, quarter and year:
    (period, start, keys, pv, uv, sums, users). ``users`` counts those who meet
    a condition, in the same pass.

    The log is reduced once: what is added up to one row per (keys, day), users
    to one row per (keys, month, user) with a bit for each day. Days, months and
    the weeks inside one month are counted from the bits; only a week that two
    months share, a quarter and a year have to know a user's other months.
    """
    keys = as_list(keys)
    sums, users = sums or {}, users or {}
    unknown = [p for p in periods if p not in PERIODS]
    if unknown:
        raise ValueError(f"unknown period: {unknown[0]}")
    names = key_names(df, keys)
    who, start = as_column(user), period_start(day, "day")
    # a row without a day has the first bit of no month
    bit = F.expr("shiftleft(1L, coalesce(dayofmonth(_day), 1) - 1)")
    met = [f"_c{i}" for i in range(len(users) + 1)]
    conditions = [F.lit(True), *users.values()]
    kinds = F.when(who.isNull(), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    rows = df.select(
        *keys, start.alias("_day"), who.alias("_user"), F.explode(kinds).alias("_one"),
        *[c.alias(f"_s{i}") for i, c in enumerate(sums.values())],
        *[F.coalesce(c, F.lit(False)).alias(name) for name, c in zip(met, conditions, strict=True)],
    )
    added = ~F.col("_one")
    reduced = rows.groupBy(
        *names, "_one", F.when(F.col("_one"), period_start("_day", "month")).otherwise(F.col("_day")).alias("_day"),
        F.when(F.col("_one"), F.col("_user")).alias("_user"),
    ).agg(
        F.count_if(added & F.col("_user").isNotNull()).alias("_rows"),
        *[F.sum(F.when(added, F.col(f"_s{i}"))).alias(f"_s{i}") for i in range(len(sums))],
        *[F.bit_or(F.when(F.col("_one") & F.col(name), bit)).alias(name) for name in met],
    )
    nobody = F.when(F.lit(False), F.col("_user"))

    def slot(p: str, first: Column, whom: Column, hits: Sequence[Column]) -> Column:
        return F.struct(
            F.lit(p).alias("period"), first.cast("date").alias("first"), whom.alias("user"),
            *[F.coalesce(h, F.lit(False)).alias(name) for h, name in zip(hits, met, strict=True)],
        )

    def slots(p: str) -> Column:
        masks = [F.coalesce(F.col(name), F.lit(0).cast("bigint")) for name in met]
        if p == "day":
            every = [slot(p, F.date_add("_day", b), nobody, [m.bitwiseAND(F.lit(1 << b)) != 0 for m in masks]) for b in range(31)]
        elif p == "week":
            # bits moved so that each seven of them are a week from Monday on
            before = F.coalesce(F.weekday("_day"), F.lit(0))
            moved = [F.call_function("shiftleft", m, before) for m in masks]
            every = []
            for k in range(6):
                monday = F.date_add("_day", F.lit(7 * k) - before)
                shared = (monday < F.col("_day")) | (F.date_add(monday, 6) > F.last_day("_day"))
                every.append(slot(p, monday, F.when(shared, F.col("_user")), [m.bitwiseAND(F.lit(127 << (7 * k))) != 0 for m in moved]))
        else:
            every = [slot(p, period_start("_day", p), nobody if p == "month" else F.col("_user"), [m != 0 for m in masks])]
        return F.filter(F.array(*every), lambda x: x[met[0]])

    of_days = F.array(*[slot(p, period_start("_day", p), nobody, [F.lit(False)] * len(met)) for p in periods])
    of_users = F.concat(*[slots(p) for p in periods])
    spread = reduced.select(
        *names, "_rows", *[f"_s{i}" for i in range(len(sums))], F.explode(F.when(F.col("_one"), of_users).otherwise(of_days)).alias("_p")
    )
    alone = F.col("_user").isNull()
    per_user = spread.groupBy(F.col("_p.period").alias("period"), F.col("_p.first").alias("_first"), *names, F.col("_p.user").alias("_user")).agg(
        F.sum("_rows").alias("_rows"), *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(sums))],
        *[F.count_if(F.col(f"_p.{name}")).alias(name) for name in met],
    )
    counts = [F.when(alone, F.col(name)).otherwise((F.col(name) > 0).cast("bigint")) for name in met]
    label = F.lit(None).cast("string")
    for p in dict.fromkeys(periods):
        label = F.when(F.col("period") == p, period_label("_first", p)).otherwise(label)
    counted = per_user.groupBy("period", "_first", *names).agg(
        long_sum(F.col("_rows")).alias("_rows"),
        *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(sums))],
        *[long_sum(c).alias(name) for c, name in zip(counts, met, strict=True)],
    )
    return counted.select(
        "period", label.alias("start"), *names, F.col("_rows").alias(pv), F.col(met[0]).alias(uv),
        *[F.col(f"_s{i}").alias(name) for i, name in enumerate(sums)],
        *[F.col(c).alias(name) for c, name in zip(met[1:], users, strict=True)],
    )
