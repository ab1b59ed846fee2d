"""Live viewing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .counts import pv_uv


def occupancy(
    df: DataFrame,
    end: str,
    length: str,
    keys: Sequence[str],
    user: str = "userId",
    slot_minutes: int = 10,
    low: int | None = None,
    high: int | None = None,
    pv: str | None = None,
) -> DataFrame:
    """Distinct viewers per time slot: an interval that ends at ``end`` and
    lasts ``length`` seconds counts in every slot it touches.

    Lengths outside low..high, if given, are no viewing; negative ones never
    are. Rows are cut to (keys, user, slot range) and made distinct before they
    are spread.
    """
    width = slot_minutes * 60
    last = F.floor(F.unix_timestamp(end) / width)
    first = F.floor((F.unix_timestamp(end) - F.col(length)) / width)
    valid = F.col(end).isNotNull() & (F.col(length) >= max(low or 0, 0))
    if high is not None:
        valid = valid & (F.col(length) <= high)
    spans = df.where(valid).select(
        *keys, F.col(user).alias("_user"), first.cast("bigint").alias("_first"), last.cast("bigint").alias("_last")
    )
    if pv is None:
        spans = spans.distinct()
    slots = spans.withColumn("_slot", F.explode(F.sequence("_first", "_last")))
    at = F.timestamp_seconds(F.col("_slot") * width).alias("slot")
    counted = pv_uv(slots, [*keys, at], user="_user", pv=pv or "_pv")
    return counted if pv else counted.drop("_pv")
