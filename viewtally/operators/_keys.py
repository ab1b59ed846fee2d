"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Key = str | Column


def as_list(keys: Key | Sequence[Key] | None) -> list[Key]:
    if keys is None:
        return []
    if isinstance(keys, (str, Column)):
        return [keys]
    return list(keys)


def as_column(c: Key) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_names(df: DataFrame, keys: Sequence[Key]) -> list[str]:
    """Output names of key expressions (analysis only, no job)."""
    return df.select(*keys).columns if keys else []


def same_keys(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality on all key columns."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def join_on_keys(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join where a null key equals a null key; keys appear once.

    No broadcast hint: Spark broadcasts a side when its size, estimated or
    measured at run time, is below its threshold, and shuffles (splitting
    skewed partitions) when it is not.
    """
    renamed = right
    for n in names:
        renamed = renamed.withColumnRenamed(n, f"__r_{n}")
    cond = reduce(lambda a, b: a & b, [left[n].eqNullSafe(renamed[f"__r_{n}"]) for n in names])
    return left.join(renamed, cond, how).drop(*[f"__r_{n}" for n in names])


NULL_KEY_PARTS = 4096
#: Columns that tell rows of a log apart, and that its reports read anyway; the salt takes the first ones there are.
TELLING = ("userId", "user_id", "datetime", "ts", "id", "mac", "videoSid", "ip")
SALT_COLUMNS = 2


def telling_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Two columns that tell the rows of a frame apart (``TELLING`` ones, else the first that are no keys)."""
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "array", "struct", "variant") and f.name not in keys]
    names = [c for c in TELLING if c in plain] + [c for c in plain if c not in TELLING]
    return [F.col(f"`{c}`") for c in names[:SALT_COLUMNS]]


def null_key_salt(df: DataFrame, keys: Sequence[str]) -> Column:
    """0 for a row that can match; another number, by a hash of the row, if a key is null.

    As one more key of an equi join (0 on the other side) it spreads rows with
    null keys over all partitions instead of sending them to one. It reads two
    columns, so that the others can be pruned, and only where a key is null.
    """
    plain = telling_columns(df, keys)
    if not plain:
        return F.lit(0)
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return F.when(missing, F.pmod(F.xxhash64(*plain), F.lit(NULL_KEY_PARTS)).cast("int") + 1).otherwise(0)


def left_join_known(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Left join on equal names where rows with a null key match nothing, and do not meet in one task."""
    salted = df.withColumn("_salt", null_key_salt(df, keys))
    # always 0, but not a literal: that would turn the key into a condition on one side
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    return salted.join(side.withColumn("_salt", zero), [*keys, "_salt"], how).drop("_salt")


#: A key is frequent if it has more than this part of all rows, so there are fewer frequent keys than this number.
HOT_SHARE = 256
#: Number of parts a frequent key is dealt over.
HOT_PARTS = 64


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys with more than one part in ``share`` of all rows with a key; fewer than ``share`` rows.

    The count combines on the map side. It reads the key columns only.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = df.where(complete).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") * share > counts.agg(F.sum("_n")).scalar()).select(*keys)


def left_join_spread(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left", share: int = HOT_SHARE, parts: int = HOT_PARTS) -> DataFrame:
    """``left_join_known`` where the rows of a frequent key do not meet in one task either.

    Rows of a frequent key are dealt over ``parts`` by a hash of two columns,
    and the key's rows of ``side`` are repeated once a part: fewer than
    ``share * parts`` more rows if a key is one row of ``side``. The list of
    frequent keys has fewer than ``share`` rows, so it can be broadcast.
    """
    plain = telling_columns(df, keys)
    if not plain:
        return left_join_known(df, side, keys, how)
    hot = F.broadcast(hot_keys(df, keys, share).withColumn("_hot", F.lit(True)))
    dealt = F.pmod(F.xxhash64(*plain), F.lit(parts)).cast("int")
    salted = df.withColumn("_missing", null_key_salt(df, keys)).join(hot, list(keys), "left")
    salted = salted.withColumn("_salt", F.when(F.col("_hot"), dealt).otherwise(F.col("_missing"))).drop("_hot", "_missing")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    repeated = side.join(hot, list(keys), "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def long_sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
