"""Run a report on Spark and its check on the other engine, and compare."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime

import duckdb

from viewtally.plans.standins import BASE


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in BASE:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, int):
        return float(value)
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows(names, data) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a frame and a query, empty when equal."""
    found = []
    spark_rows = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    sql_rows = rows(names, cur.fetchall())
    if spark_rows != sql_rows:
        found.append(f"rows {sum(spark_rows.values())} / {sum(sql_rows.values())}")
        found.append(f"cols {sorted(names)}")
        found += [f"only spark: {r}" for r in list((spark_rows - sql_rows))[:3]]
        found += [f"only check: {r}" for r in list((sql_rows - spark_rows))[:3]]
    return found
