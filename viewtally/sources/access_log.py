"""Raw web access-log lines to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields that hold numbers, and the renamed key.
NUMERIC_KEYS = ("duration", "accountId")
KEY_ALIASES = {"ProductModel": "productModel"}
BAD_KEY = "corruptKey"


def _clean_key(key: Column) -> Column:
    named = key
    for old, new in KEY_ALIASES.items():
        named = F.when(key == old, new).otherwise(named)
    return F.when(named.rlike(r"^\w+$"), named).otherwise(F.lit(BAD_KEY))


def _decoded(raw: Column) -> Column:
    return F.coalesce(F.try_url_decode(raw), F.lit(""))


def query_params(query: Column) -> Column:
    """``a=1&b=x%20y`` as map<string,string>.

    A key without a value gets the empty string, an undecodable value too, a
    pair with more than one ``=`` is dropped, and of repeated keys the last
    one wins.
    """
    pairs = F.filter(F.split(query, "&"), lambda p: (F.size(F.split(p, "=")) <= 2) & (p != ""))
    entries = F.transform(
        pairs,
        lambda p: F.struct(
            _clean_key(F.split(p, "=")[0]).alias("k"),
            _decoded(F.coalesce(F.get(F.split(p, "="), F.lit(1)), F.lit(""))).alias("v"),
        ),
    )
    return F.aggregate(
        entries,
        F.expr("cast(map() as map<string,string>)"),
        lambda acc, e: F.map_concat(
            F.map_filter(acc, lambda k, _: k != e["k"]), F.create_map(e["k"], e["v"])
        ),
    )


def parse_access_log(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """ip, datetime, day, logType, duration, accountId and all ``params``.

    Lines without a query string or without a readable time are dropped.
    ``keep`` names columns of ``lines`` to carry along. Unreadable numbers are 0.
    """
    line = F.col(column)
    parts = lines.select(
        *keep,
        F.regexp_extract(line, r"^(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})", 1).alias("_ip"),
        F.regexp_extract(line, r"\[([^\]]{20})", 1).alias("_time"),
        F.regexp_extract(line, r"^[^?]+\?(\S*) ", 1).alias("_query"),
        line.rlike(r"^[^?]+\?\S* ").alias("_has_query"),
    )
    stamped = parts.where(F.col("_has_query")).withColumn(
        "datetime", F.try_to_timestamp(F.col("_time"), F.lit("dd/MMM/yyyy:HH:mm:ss"))
    )
    out = stamped.where(F.col("datetime").isNotNull()).withColumn("params", query_params(F.col("_query")))
    numbers = [
        F.coalesce(F.col("params")[key].try_cast("bigint"), F.lit(0).cast("bigint")).alias(key)
        for key in NUMERIC_KEYS
    ]
    return out.select(
        *keep,
        F.col("_ip").alias("ip"),
        "datetime",
        F.to_date("datetime").alias("day"),
        F.col("params")["logType"].alias("logType"),
        F.col("params")["userId"].alias("userId"),
        *numbers,
        "params",
    )


def split_ids(ids: Column, account_default: str = "0", group_default: str = "0") -> Column:
    """``user-account-group`` as a struct; absent or blank parts get defaults."""
    parts = F.split(ids, "-")
    known = F.size(parts).isin(2, 3)

    def part(i: int, default: str) -> Column:
        value = F.when(known, F.get(parts, F.lit(i)))
        return F.when(value.isNull() | (value == ""), F.lit(default)).otherwise(value)

    return F.struct(
        parts[0].alias("userId"),
        part(1, account_default).alias("accountId"),
        part(2, group_default).alias("groupId"),
    )
