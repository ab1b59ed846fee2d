"""Crash reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import blacklist_filter
from .rollups import ALL, rollup_all

# Crash kinds by what the crash key contains.
CRASH_KINDS = {"OOM": "java.lang.OutOfMemoryError", "NPE": "java.lang.NullPointerException"}


def crash_counts(crashes: DataFrame, mac: str = "MAC") -> DataFrame:
    """Crashes per (device, stack, product, date code)."""
    return crashes.groupBy(
        mac, F.md5(F.col("STACK_TRACE")).alias("stack_md5"), "PRODUCT_CODE", "DATE_CODE"
    ).agg(F.count(F.lit(1)).alias("n"))


def crash_trend(
    crashes: DataFrame,
    levels: Sequence[Sequence[str]],
    test_devices: DataFrame | Sequence[str] | None = None,
    kinds: Mapping[str, str] = CRASH_KINDS,
    cap: int | None = None,
    version_length: int | None = None,
    date_length: int | None = None,
    mac: str = "MAC",
) -> DataFrame:
    """Crashes and devices per kind at every level:
    (crash_type, level columns with 'All', crashes, devices).

    Devices are compared and counted without the colons of their MAC. Test
    devices are left out, so are reports without a stack. Where given: a
    (device, version, product, date, crash key, stack) group of more than
    ``cap`` rows is noise and dropped, versions of another length and longer
    date codes are left out. A crash counts under its kind and under 'All'.
    """
    crashes = crashes.withColumn(mac, F.replace(F.col(mac), F.lit(":"), F.lit("")))
    keep = F.col("STACK_TRACE").isNotNull() & (F.col("STACK_TRACE") != "")
    if version_length is not None:
        keep = keep & (F.length("APP_VERSION_NAME") == version_length)
    if date_length is not None:
        keep = keep & F.coalesce(F.length(F.col("DATE_CODE").cast("string")) <= date_length, F.lit(True))
    real = crashes.where(keep)
    if isinstance(test_devices, DataFrame):
        device = test_devices.columns[0]
        test_devices = test_devices.select(F.replace(F.col(device), F.lit(":"), F.lit("")).alias(device))
    elif test_devices is not None:
        test_devices = [x.replace(":", "") for x in test_devices]
    if test_devices is not None:
        real = blacklist_filter(real, mac, test_devices)
    finest = list(dict.fromkeys(c for level in levels for c in level))
    grouped = real.groupBy(
        *dict.fromkeys([mac, "APP_VERSION_NAME", "APP_VERSION_CODE", "DATE_CODE", "PRODUCT_CODE", *finest]),
        "CRASH_KEY",
        F.md5(F.col("STACK_TRACE")).alias("_stack"),
    ).agg(F.count(F.lit(1)).alias("_n"))
    if cap is not None:
        grouped = grouped.where(F.col("_n") <= cap)
    marks = [F.when(F.col("CRASH_KEY").contains(text), F.lit(name)) for name, text in kinds.items()]
    typed = grouped.withColumn(
        "crash_type", F.explode(F.filter(F.array(F.lit(ALL), *marks), lambda k: k.isNotNull()))
    )
    out = rollup_all(
        typed, [["crash_type", *level] for level in levels], user=mac, sums={"crashes": F.col("_n")}, uv="devices"
    )
    return out.drop("pv")
