"""Reports that keep tables of their own: written, written again, and read back.

Each run has a folder of its own below the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.counts import pv_uv
from ..operators.migration import device_rules, model_rules, sequential_dedup
from ..operators.retention import OFFSET_NAMES, OFFSETS, cohort_retention, retention_wide
from ..session import ensure_checkpoint_dir
from ..sources.logs import scan_log
from ..sources.sinks import merge_columns, replace_days
from ..streaming.online import exact_counts, start_day_sink
from .registry import report
from .retention import active, new_users

SHARED = ["model1", "model4", "model9"]


def own_folder(t, name: str) -> str:
    return f"{ensure_checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


# -- accounts in the order they were opened


@report("account_migration", "I6", "J18")
def account_migration(t):
    """An account is a duplicate if an account kept before it has its MAC or its Wi-Fi MAC."""
    return sequential_dedup(t.device, device_rules()).select("id", "is_duplicate", "original")


@report("account_migration_listed_models", "I7")
def account_migration_listed(t):
    return sequential_dedup(t.device, model_rules(SHARED, only_listed=True)).select("id", "is_duplicate", "original")


@report("account_migration_by_model", "I8", "U39")
def account_migration_by_model(t):
    return sequential_dedup(t.device, model_rules(SHARED)).select("id", "is_duplicate", "original")


# -- tables by day


@report("area_logins_rewritten", "SNK1", "SNK2")
def area_logins_rewritten(t):
    """Logins per day and version, stored, and three days of it stored again from corrected logs.

    The corrected logs have no rows of the 10th and only visitors with an
    account number below 50 on the 11th; the 12th is as it was.
    """
    path = own_folder(t, "logins")
    version = S.apk_version("version").alias("version")
    counts = lambda log: pv_uv(log, ["day", version], pv="logins", uv="users")
    days = [str(r[0]) for r in t.login.select("day").distinct().collect()]
    replace_days(counts(t.login), path, days)
    corrected = t.login.where(F.col("day").between(F.lit("2024-01-10").cast("date"), F.lit("2024-01-12").cast("date")))
    corrected = corrected.where((F.dayofmonth("day") == 12) | ((F.dayofmonth("day") == 11) & (F.col("k") < 50)))
    replace_days(counts(corrected), path, ["2024-01-10", "2024-01-11", "2024-01-12"])
    schema = "version string, logins bigint, users bigint, day date"
    return t.spark.read.schema(schema).parquet(path).select("day", "version", "logins", "users")


@report("retention_upserted", "SNK4", "R1")
def retention_upserted(t):
    """Retention of new users as it comes in: the first offset makes a row, later ones fill its columns."""
    path = own_folder(t, "retention")
    names = [OFFSET_NAMES[k] for k in OFFSETS]
    schema = ", ".join([*[f"{n} double" for n in names], "day date"])
    for offsets in ((1,), (2, 3, 4, 5, 6), (7, 14, 30)):
        rates = cohort_retention(new_users(t), active(t), offsets=offsets)
        merge_columns(retention_wide(rates, ["day"], offsets), path, schema, ["day"])
    return t.spark.read.schema(schema).parquet(path).select("day", *names)


# -- logs by product, type and day

EARLY = "userId string, mac string, datetime timestamp, duration bigint"
LOG_SCHEMA = f"{EARLY}, productModel string, k bigint, product string, log_type string, day date"


@report("scans_of_partitioned_logs", "SRC1", "SRC2", "SRC3", "SRC4", "F14")
def scans_of_partitioned_logs(t):
    """One log laid out by product, type and day, its columns growing over time, and scanned in four ways.

    Files of days before the 11th lack two columns. Every scan declares the
    schema, so no footer is read to find it, and selects by partition columns.
    """
    root = own_folder(t, "logs")
    log = t.login.select("*", F.when(F.col("k") % 4 == 0, "2x").otherwise("3x").alias("product"))
    parts = ["product", "log_type", "day"]
    early = ["userId", "mac", "datetime", "duration"]
    old = F.dayofmonth("day") < 11
    log.where(old).select(*early, *parts).write.partitionBy(*parts).parquet(root)
    log.where(~old).select(*early, "productModel", "k", *parts).write.mode("append").partitionBy(*parts).parquet(root)
    schema = t.spark.createDataFrame([], LOG_SCHEMA).schema

    def counted(name, **selection):
        rows = scan_log(t.spark, root, schema=schema, **selection)
        out = pv_uv(rows, ["day", "product", "log_type"], pv="plays", uv="users")
        more = rows.groupBy("day", "product", "log_type").agg(F.count("productModel").alias("models"), F.sum("k").alias("k_sum"))
        return out.join(more, ["day", "product", "log_type"]).select(F.lit(name).alias("scan"), "*")

    scans = [
        counted("one", product="3x", log_type="view", days="2024-01-12"),
        counted("list", product="3x", log_type="click", days=["2024-01-09", "2024-01-11", "2024-01-20"]),
        counted("types", log_type=["view", "signup"], days=("2024-01-08", "2024-01-14"), between=True),
        counted("but", product=["2x", "3x"], days="2024-01-10", exclude_types=["view", "purchase"]),
    ]
    out = scans[0]
    for scan in scans[1:]:
        out = out.unionByName(scan)
    return out


# -- a table read as a stream

ARRIVALS = 6


@report("hourly_counts_of_a_file_stream", "ST2")
def hourly_counts_of_a_file_stream(t):
    """Exact plays and users per hour from a stream of files, some rows arriving up to eighty minutes late.

    The log is laid out in the order of arrival, one folder for each step, with
    an empty hour far ahead as the last row, which lets the stream close its
    windows. The result is what the stream wrote.
    """
    folder = own_folder(t, "arrivals")
    late = F.col("k") % 3 * F.expr("INTERVAL 40 MINUTES")
    at = F.col("datetime").cast("timestamp")
    log = t.login.select("userId", at.alias("datetime"), "log_type", (at + late).alias("arrived"))
    first, last = log.agg(F.min("arrived"), F.max("arrived")).first()
    if first is None:
        return exact_counts(log, ["log_type"])
    span = F.unix_micros(F.lit(last)) - F.unix_micros(F.lit(first)) + 1
    step = F.floor((F.unix_micros("arrived") - F.unix_micros(F.lit(first))) * ARRIVALS / span).cast("int")
    log.withColumn("step", step).select("userId", "datetime", "log_type", "step").write.partitionBy("step").parquet(folder + "/in")
    ahead = t.spark.range(1).select(
        F.lit(None).cast("string").alias("userId"), (F.lit(last) + F.expr("INTERVAL 7 DAYS")).alias("datetime"), F.lit("end").alias("log_type")
    )
    for i in (ARRIVALS, ARRIVALS + 1):  # the first moves the watermark, the second lets both aggregations see it
        ahead.write.parquet(f"{folder}/in/step={i}")
    for i in range(ARRIVALS + 2):
        stream = t.spark.readStream.schema("userId string, datetime timestamp, log_type string").parquet(f"{folder}/in/step=[0-{i}]")
        counts = exact_counts(stream.select("userId", "datetime", "log_type"), ["log_type"])
        start_day_sink(counts, folder + "/out", folder + "/state", available_now=True).awaitTermination()
    return t.spark.read.schema("start timestamp, log_type string, pv bigint, uv bigint").parquet(folder + "/out")
