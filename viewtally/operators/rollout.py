"""Version roll-out, loyalty and new-user quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._keys import join_on_keys
from .retention import day_span, day_spans


def accumulate_new(
    previous: DataFrame | None,
    today: DataFrame,
    key: Sequence[str],
    day: str,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Yesterday's set plus the keys first seen in ``today``: (key, day, keep).

    Of several rows of a key the earliest day wins, and of those the smallest
    ``keep`` values, so a re-run gives the same set. With ``previous=None``
    the whole set is built from one log of many days. Null keys never enter.
    """
    key = list(key)
    picked = F.min(F.struct(F.col(day), *[F.col(c) for c in keep])).alias("_first")
    present = today
    for k in key:
        present = present.where(F.col(k).isNotNull())
    fresh = present.groupBy(*key).agg(picked).select(*key, f"_first.{day}", *[f"_first.{c}" for c in keep])
    if previous is None:
        return fresh
    unseen = fresh.join(previous.select(*key), key, "left_anti")
    return previous.select(*key, day, *keep).unionByName(unseen)


def new_keys(previous: DataFrame, today: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys of today that the earlier set does not hold."""
    return today.select(*key).distinct().join(previous.select(*key), list(key), "left_anti")


def loyalty_split(
    users: DataFrame,
    later: DataFrame,
    user: str,
    day: str,
    first: str,
    last: str,
    active_days: int,
    outflow_users: Column | None = None,
    outflow: str = "outflow",
    active: str = "active",
) -> DataFrame:
    """Users without any later login, and users with logins on at least
    ``active_days`` days of (first .. last): (userType, user).

    ``outflow_users`` restricts who may count as lost (for instance the users
    of one version); the active ones are taken from all ``users``.
    """
    window = later.where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    days = (
        window.select(user, day)
        .distinct()
        .groupBy(user)
        .agg(F.count(F.lit(1)).alias("_days"))
    )
    base = users if outflow_users is None else users.where(outflow_users)
    lost = base.select(user).distinct().join(days.select(user), user, "left_anti")
    loyal = users.select(user).distinct().join(days.where(F.col("_days") >= active_days).select(user), user, "left_semi")
    return lost.select(F.lit(outflow).alias("userType"), user).unionByName(
        loyal.select(F.lit(active).alias("userType"), user)
    )


def non_play_rate(
    new_users: DataFrame,
    actions: DataFrame,
    keys: Sequence[str] = (),
    user: str = "userId",
    day: str = "day",
    horizon: int = 14,
    new: str = "new_users",
    acted: str = "acted_users",
) -> DataFrame:
    """New users, and those of them with any action in the next ``horizon``
    days (the first day included).

    Actions are one row per user and day before the join, which is on the user
    and spans of ``horizon`` days, so a new user meets those of two spans at
    most; groups without any action stay, with 0.
    """
    members = new_users.where(F.col(user).isNotNull()).select(F.col(user).alias("_user"), F.col(day).alias("_new"), *keys)
    members = members.distinct()
    did = actions.select(F.col(user).alias("_user"), F.col(day).alias("_did")).distinct()
    after = F.datediff("_did", "_new").between(0, horizon - 1)
    spans = day_spans(members, "_new", horizon - 1)
    hits = spans.join(did.withColumn("_span", day_span("_did", horizon - 1)), ["_user", "_span"]).where(after).select("_user", "_new", *keys).distinct()
    marked = members.withColumn("_hit", F.lit(0)).unionByName(hits.withColumn("_hit", F.lit(1)))
    per_user = marked.groupBy("_user", *keys).agg(F.max("_hit").alias("_hit"))
    return per_user.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(new), F.coalesce(F.sum("_hit"), F.lit(0)).cast("bigint").alias(acted)
    )


def dup_alert(
    df: DataFrame,
    key: str,
    threshold: int,
    breakdowns: Mapping[str, str] | None = None,
    among: DataFrame | None = None,
    kind: str = "key",
) -> DataFrame:
    """Keys with at least ``threshold`` rows: (type, key, part, n).

    ``breakdowns`` maps a type label to a column that splits the alarmed keys
    further; ``among`` limits the alarm to keys it holds.
    """
    finest = list((breakdowns or {}).values())
    # one scan: rows per (key, all breakdown columns), everything else from it
    cells = df.where(F.col(key).isNotNull()).groupBy(key, *finest).agg(F.count(F.lit(1)).alias("_cell"))
    alarmed = cells.groupBy(key).agg(F.sum("_cell").alias("n")).where(F.col("n") >= threshold)
    if among is not None:
        alarmed = alarmed.join(among.select(key).distinct(), key, "left_semi")
    out = alarmed.select(F.lit(kind).alias("type"), F.col(key).alias("key"), F.lit(None).cast("string").alias("part"), "n")
    if breakdowns:
        hit = join_on_keys(cells, alarmed.select(key), [key])
        for label, column in breakdowns.items():
            split = hit.groupBy(key, column).agg(F.sum("_cell").alias("n"))
            out = out.unionByName(
                split.select(
                    F.lit(label).alias("type"), F.col(key).alias("key"), F.col(column).cast("string").alias("part"), "n"
                )
            )
    return out


def variants_per_key(df: DataFrame, key: str, parts: Sequence[Column | str], n: str = "n") -> DataFrame:
    """Distinct combinations of ``parts`` per key."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    combos = df.where(F.col(key).isNotNull()).select(F.col(key), *[c.alias(f"_p{i}") for i, c in enumerate(cols)])
    return combos.distinct().groupBy(key).agg(F.count(F.lit(1)).alias(n))
