"""Compare two results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(a: DataFrame, b: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows that the two frames do not share, with how often each side has
    them: (columns, in_a, in_b). Empty when equal as multisets.

    One union and one grouping; nulls are compared like values.
    """
    cols = [c for c in a.columns if c not in ignore]
    left = a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    right = b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    return (
        left.unionByName(right)
        .groupBy(*cols)
        .agg(F.sum("_a").alias("in_a"), F.sum("_b").alias("in_b"))
        .where(F.col("in_a") != F.col("in_b"))
    )


def reconcile_counts(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys (days, tables) whose row counts differ."""
    left = a.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    right = b.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    return (
        left.unionByName(right)
        .groupBy(*keys)
        .agg(F.sum("_a").alias("in_a"), F.sum("_b").alias("in_b"))
        .where(F.col("in_a") != F.col("in_b"))
    )
