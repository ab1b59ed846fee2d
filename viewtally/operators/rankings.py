"""Top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._keys import join_on_keys

#: Up to this many rows of a group Spark limits a ranking before it shuffles.
SPARK_LIMIT = 1000


def topn_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    n: int = 200,
    tie_break: Sequence[str] = (),
    ties: str = "break",
    rank: str | None = "rank",
) -> DataFrame:
    """The n largest rows of each group.

    ``ties="break"`` gives exactly n rows, equal values ordered by
    ``tie_break``; ``ties="keep"`` keeps all rows that share the last rank.
    With ``break`` each task is cut to n rows per group before the shuffle: by
    Spark itself up to ``SPARK_LIMIT``, beyond it by a ranking of each input
    partition's rows. So a group of any size reaches its final task as n rows
    per input partition. With ``keep`` only the distinct values of a group are
    ranked, counted on the map side; rows are joined to the n best of them, so
    that a group whose rows are all tied stays spread. Without a group it is a
    sort with a limit, merged from per-task top lists.
    """
    ordering: list[Column] = [F.col(order).desc(), *[F.col(c).asc() for c in tie_break]]
    if not group and ties == "break":
        top = df.orderBy(*ordering).limit(n)
        if rank is None:
            return top
        return top.withColumn(rank, F.row_number().over(Window.orderBy(*ordering)))
    name = rank or "_rank"
    if ties == "keep":
        return _keep_ties(df, list(group), order, n, rank)
    w = Window.partitionBy(*group).orderBy(*ordering)
    if n > SPARK_LIMIT:
        own = Window.partitionBy(*group, "_part").orderBy(*ordering)
        df = df.withColumn("_part", F.spark_partition_id()).withColumn(name, F.row_number().over(own)).where(F.col(name) <= n).drop("_part", name)
    out = df.withColumn(name, F.row_number().over(w))
    out = out.where(F.col(name) <= n)
    return out if rank else out.drop(name)


def _keep_ties(df: DataFrame, group: list[str], order: str, n: int, rank: str | None) -> DataFrame:
    values = df.groupBy(*group, order).agg(F.count(F.lit(1)).alias("_times"))
    best = Window.partitionBy(*group).orderBy(F.col(order).desc())
    # a value's rank is at least its place among the distinct ones, so no more than n of them count
    placed = values.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= n)
    ranked = placed.withColumn("_rank", F.sum("_times").over(best.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_times") + 1)
    ranked = ranked.where(F.col("_rank") <= n).select(*group, order, F.col("_rank").cast("int").alias("_rank"))
    out = join_on_keys(df, ranked, [*group, order])
    return out.select(*df.columns, *([F.col("_rank").alias(rank)] if rank else []))
