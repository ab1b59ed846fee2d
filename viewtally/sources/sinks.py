"""Idempotent per-day outputs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def write_day(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = ("day",),
    fmt: str = "parquet",
    files: int | None = None,
    **options,
) -> None:
    """Replace exactly the partitions present in ``df``; other days stay.

    ``fmt`` may be parquet, json or csv (``sep="\\t"`` for delimited text).
    ``files`` spreads each day over that many files; without it Spark decides.
    """
    out = df
    if files is not None:
        # spread by a hash of the row, so that one big day is not one task and
        # a retried task sends every row to the same place again
        hashed = [f.name for f in df.schema.fields if not f.dataType.simpleString().startswith("map")]
        spread = F.pmod(F.xxhash64(*hashed), F.lit(files))
        out = df.repartition(*partitions, spread)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .options(**options)
        .partitionBy(*partitions)
        .format(fmt)
        .save(path)
    )


def _file_system(spark: SparkSession, path: str):
    """(file system, path) by the scheme of the path, so that any store Spark writes to works."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def _staged(df: DataFrame, path: str) -> tuple[DataFrame, str]:
    """``df`` written completely beside the table, in a folder that scans of the table do not see."""
    place = f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    try:
        df.write.parquet(place)
    except Exception:
        remove_path(df.sparkSession, place)
        raise
    return df.sparkSession.read.schema(df.schema).parquet(place), place


def replace_days(df: DataFrame, path: str, days: Sequence[str | date], day: str = "day") -> None:
    """Make the rows of the listed days in the table at ``path`` exactly those of ``df``.

    A listed day without rows in ``df`` is emptied, other days stay. ``df`` is
    computed once, into a staged folder; only when that is complete are the days
    with rows replaced and the emptied ones removed. A run that dies before then
    has changed nothing, one that dies later is repaired by running it again,
    since every step sets a state instead of adding to it. Rows of a day that is
    not listed are an error, before anything is changed.
    """
    spark = df.sparkSession
    listed = {date.fromisoformat(str(d)) for d in days}
    staged, place = _staged(df.withColumn(day, F.col(day).cast("date")), path)
    try:
        present = {r[0] for r in staged.select(day).distinct().limit(len(listed) + 1).collect()}
        if present - listed:
            raise ValueError(f"rows of days that are not listed: {sorted(map(str, present - listed))}")
        if present:
            write_day(staged, path, (day,))
        for empty in listed - present:
            remove_path(spark, f"{path.rstrip('/')}/{day}={empty.isoformat()}")
    finally:
        remove_path(spark, place)


def merge_columns(updates: DataFrame, path: str, schema: str, keys: Sequence[str], partition: str = "day") -> None:
    """Put new values into the rows of a wide table, and add rows it does not have.

    ``updates`` holds ``keys`` (with ``partition`` among them) and some of the
    value columns; a value that is null changes nothing. Where several updates
    meet in one row the largest value counts. Only partitions that ``updates``
    touches are read, joined (null keys are equal) and replaced, through a
    staged copy; merging the same updates again changes nothing, so a run that
    died can be repeated. ``schema`` declares all columns: files written before
    a column existed read as null there.
    """
    spark = updates.sparkSession
    empty = spark.createDataFrame([], schema)
    values = [c for c in empty.columns if c not in keys]
    given = [c for c in values if c in updates.columns]
    news = updates.groupBy(*keys).agg(*[F.max(c).alias(f"_{c}") for c in given])
    news, place = _staged(news, path)
    try:
        touched = [r[0] for r in news.select(partition).distinct().collect()]  # one value for each partition of the table at most
        old = empty
        if any(path_exists(spark, f"{path.rstrip('/')}/{partition}={t}") for t in touched):
            old = spark.read.schema(empty.schema).parquet(path)
            old = old.where(F.col(partition).isin(touched))
        renamed = news.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[f"_{c}" for c in given])
        same = None
        for i, k in enumerate(keys):
            equal = F.col(k).eqNullSafe(F.col(f"_k{i}"))
            same = equal if same is None else same & equal
        both = old.withColumn("_old", F.lit(True)).join(renamed.withColumn("_new", F.lit(True)), same, "full")
        merged = both.select(
            *[F.when(F.col("_new"), F.col(f"_k{i}")).otherwise(F.col(k)).alias(k) for i, k in enumerate(keys)],
            *[(F.coalesce(f"_{c}", c) if c in given else F.col(c)).cast(empty.schema[c].dataType).alias(c) for c in values],
        )
        whole, copy = _staged(merged, path)
        try:
            write_day(whole, path, (partition,))
        finally:
            remove_path(spark, copy)
    finally:
        remove_path(spark, place)


def write_day_jdbc(df: DataFrame, options: dict[str, str], table: str, batch: int = 1000) -> None:
    """Append a result to a database table, one connection per partition.

    The caller deletes the day first; the writer itself never deletes rows.
    """
    (
        df.write.format("jdbc")
        .options(**options)
        .option("dbtable", table)
        .option("batchsize", batch)
        .mode("append")
        .save()
    )


def snapshot_day(accounts: DataFrame, day: str, open_col: str = "openTime") -> DataFrame:
    """State of the account table at the end of ``day``."""
    end = F.date_add(F.lit(day).cast("date"), 1).cast("timestamp")
    return accounts.where(F.col(open_col) < end).withColumn("day", F.lit(day).cast("date"))


def checkpoint_step(
    df: DataFrame, path: str | None = None, name: str = "step", metrics: dict[str, Column] | None = None
) -> tuple[DataFrame, Observation]:
    """Cut the lineage at a reliable place and count rows in the same pass.

    With ``path`` the step is written there and read back, so it survives the
    job; else it goes to the shared checkpoint folder. ``metrics`` adds named
    counts, such as kept and rejected rows. The counts are in the Observation.
    """
    observed = Observation(name)
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [expr.alias(label) for label, expr in (metrics or {}).items()]
    watched = df.observe(observed, *aggs)
    if path is not None:
        watched.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path), observed
    ensure_checkpoint_dir(df.sparkSession)
    return watched.checkpoint(eager=True), observed
