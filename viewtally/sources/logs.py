"""Scans. A log table is one parquet table partitioned by product, log type
and day, so every selection below is a partition filter and prunes files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _one_or_many(value) -> list:
    return [value] if isinstance(value, str) else list(value)


def scan_log(
    spark: SparkSession,
    root: str,
    product: str | Sequence[str] | None = None,
    log_type: str | Sequence[str] | None = None,
    days: str | Sequence[str] | tuple[str, str] | None = None,
    exclude_types: Sequence[str] = (),
    schema: StructType | None = None,
    between: bool = False,
) -> DataFrame:
    """Rows of the wanted products, log types and event days.

    ``days`` is one day, a list of days, or with ``between=True`` a
    (first, last) pair. ``exclude_types`` is the black list for "every log type
    of the day" scans. ``day`` is the day of the event itself.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    df = reader.parquet(root)
    if product is not None:
        df = df.where(F.col("product").isin(_one_or_many(product)))
    if log_type is not None:
        df = df.where(F.col("log_type").isin(_one_or_many(log_type)))
    if exclude_types:
        df = df.where(~F.col("log_type").isin(list(exclude_types)))
    if days is not None:
        if between:
            first, last = days
            df = df.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        else:
            df = df.where(F.col("day").isin([F.lit(d).cast("date") for d in _one_or_many(days)]))
    return df


def current_rows(dim: DataFrame, valid_col: str = "dim_invalid_time") -> DataFrame:
    """The current version of a slowly changing dimension."""
    return dim.where(F.col(valid_col).isNull())


def scan_dim(spark: SparkSession, root: str, name: str, valid_col: str | None = "dim_invalid_time") -> DataFrame:
    """Current rows of a dimension table (all rows with ``valid_col=None``)."""
    dim = spark.read.parquet(f"{root.rstrip('/')}/{name}")
    return dim if valid_col is None else current_rows(dim, valid_col)


def scan_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    where: Column | str | None = None,
) -> DataFrame:
    """A database table read as ``partitions`` id ranges between two bounds.

    The filter is pushed into the database, so only matching rows travel.
    """
    df = (
        spark.read.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("partitionColumn", column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )
    return df if where is None else df.where(where)


def id_bounds(df: DataFrame, column: str = "id") -> DataFrame:
    """Smallest and largest id, the bounds of a split scan."""
    return df.agg(F.min(column).alias("min_id"), F.max(column).alias("max_id"))
