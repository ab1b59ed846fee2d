"""Bring logs with different columns to one declared schema and merge them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def as_schema(columns: StructType | Mapping[str, str] | Sequence[str]) -> StructType:
    """A StructType from itself, a name -> type mapping, or names of strings."""
    if isinstance(columns, StructType):
        return columns
    if isinstance(columns, Mapping):
        return StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in columns.items()))
    return StructType([StructField(name, StringType()) for name in columns])


def project_whitelist(
    df: DataFrame,
    columns: StructType | Mapping[str, str] | Sequence[str],
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Exactly the white-listed columns, with the declared types.

    A column the day's file lacks becomes a typed null, a value that does not
    fit its declared type becomes null. ``rename`` maps wanted -> actual name.
    """
    rename = rename or {}
    out = []
    for field in as_schema(columns).fields:
        actual = rename.get(field.name, field.name)
        if actual in df.columns:
            out.append(F.col(f"`{actual}`").try_cast(field.dataType).alias(field.name))
        else:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*out)


def merge_sources(
    parts: Sequence[tuple[DataFrame | None, str]],
    columns: StructType | Mapping[str, str] | Sequence[str] | None = None,
    flag: str = "flag",
    extra: Mapping[str, Mapping[str, Column]] | None = None,
) -> DataFrame:
    """Union of several product lines' logs with the product in ``flag``.

    ``parts`` holds (frame, product); a missing side (None) is left out, no
    side at all is an error. With ``columns`` each side is cut to that schema
    first, else the schemas are unioned and missing columns become null.
    ``extra`` adds columns to one side only (for instance a constant button).
    """
    extra = extra or {}
    frames = []
    for df, product in parts:
        if df is None:
            continue
        for name, expr in extra.get(product, {}).items():
            df = df.withColumn(name, expr)
        if columns is not None:
            df = project_whitelist(df, columns)
        frames.append(df.withColumn(flag, F.lit(product)))
    if not frames:
        raise ValueError("no input log on any side")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
