"""Drop traffic that is not an audience."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: plays of one (user, video) in a day from which on they are a flood.
FLOOD_LIMIT = 5000


def flood_keys(df: DataFrame, keys: Sequence[str], limit: int = FLOOD_LIMIT) -> DataFrame:
    """Keys with at least ``limit`` rows; incomplete keys are never a flood."""
    complete = df
    for k in keys:
        complete = complete.where(F.col(k).isNotNull())
    return complete.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= limit).select(*keys)


def flood_filter(df: DataFrame, keys: Sequence[str], limit: int = FLOOD_LIMIT) -> DataFrame:
    """Without the rows of any key that occurs ``limit`` times or more.

    The count combines on the map side, and the few flooded keys are removed
    with an anti join: no window, which would gather the flood in one task.
    Rows with a null in the key stay.
    """
    return df.join(flood_keys(df, keys, limit), list(keys), "left_anti")


def blacklist_filter(
    df: DataFrame,
    column: str,
    black: DataFrame | Sequence[str] | None = None,
    white: DataFrame | Sequence[str] | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Without black-listed values.

    A value that does not match ``pattern`` is black, whatever the lists say;
    the white list wins over the black list; null and '' are always white.
    Lists may be short Python lists or frames with one column.
    """
    value = F.col(column)
    free = value.isNull() | (value == "")
    if pattern is not None:
        df = df.where(free | value.rlike(pattern))
    if black is None:
        return df
    if not isinstance(black, DataFrame):
        allowed = [] if white is None else list(white)
        bad = [b for b in black if b not in allowed]
        return df.where(free | ~value.isin(bad)) if bad else df
    listed = black.select(F.col(black.columns[0]).alias(column)).where(F.col(column) != "").distinct()
    if isinstance(white, DataFrame):
        listed = listed.join(white.select(F.col(white.columns[0]).alias(column)), column, "left_anti")
    elif white:
        listed = listed.where(~F.col(column).isin(list(white)))
    return df.join(listed, column, "left_anti")
