"""Tables that are written again, accounts taken over one by one, exact counts of a stream."""

import random

import pytest
from pyspark.sql import functions as F

from viewtally.operators.migration import device_rules, model_rules, sequential_dedup
from viewtally.sources.logs import scan_log
from viewtally.sources.sinks import merge_columns, path_exists, replace_days
from viewtally.streaming.online import exact_counts, start_day_sink

ACCOUNTS = "id long, mac string, wifi_mac string, product_model string"


def scan(rows, lookups, offers):
    """One account after the other; keys of kept ones are remembered with their first owner."""
    kept, out = {}, []
    for row in sorted(rows):
        found = [kept[k] for k in lookups(row) if k in kept]
        out.append((row[0], bool(found), min(found, default=None)))
        if not found:
            for k in offers(row):
                kept.setdefault(k, row[0])
    return out


def valid(wifi):
    bare = (wifi or "").replace(":", "").upper()
    return bare if bare not in ("", "020000000000") else None


def device_keys(row):
    _, mac, wifi, _ = row
    return [("mac", mac)] * bool(mac) + [("wifi", valid(wifi))] * bool(valid(wifi))


def all_model_keys(row):
    _, mac, wifi, model = row
    any_wifi = None if wifi is None else wifi.replace(":", "").upper()
    keys = [("m", mac or None, model), ("w", any_wifi, model), ("wm", any_wifi, mac or None, model)]
    return [k for k in keys if None not in k]


def one_model_key(row, shared, only):
    _, mac, wifi, model = row
    if only and model not in shared:
        return []
    kind = "m" if valid(wifi) is None else "w" if model in shared else "wm"
    return [k for k in all_model_keys(row) if k[0] == kind]


def marked(df):
    return sorted((r["id"], r["is_duplicate"], r["original"]) for r in df.collect())


CHAIN = [(i, f"m{i // 2}", f"w{(i + 1) // 2}", "a") for i in range(14)]
HOT = [(100 + i, "same", None if i % 3 else f"w{i}", "a") for i in range(300)]


def random_accounts(seed):
    rng = random.Random(seed)
    pick = lambda n, p: rng.choice([None, "", "02:00:00:00:00:00"]) if rng.random() < 0.2 else f"{p}{rng.randrange(n)}"
    return [(i, pick(40, "m"), pick(40, "w:"), rng.choice(["a", "b", "c", None])) for i in rng.sample(range(1000), 150)]


@pytest.mark.parametrize("rows", [CHAIN, HOT, random_accounts(1), random_accounts(2), [(1, None, None, None)], []])
def test_accounts_are_compared_with_those_kept_before(spark, rows):
    got = sequential_dedup(spark.createDataFrame(rows, ACCOUNTS), device_rules())
    assert marked(got) == scan(rows, device_keys, device_keys)


@pytest.mark.parametrize("only", [True, False])
def test_accounts_by_the_key_their_model_selects(spark, only):
    rows = random_accounts(3) + [(2000 + i, "same", "w:1", "a") for i in range(60)]
    got = sequential_dedup(spark.createDataFrame(rows, ACCOUNTS), model_rules(["a", "b"], only_listed=only))
    assert marked(got) == scan(rows, lambda r: one_model_key(r, ("a", "b"), only), all_model_keys)


DAYS = "day string, area string, n long"


def stored(spark, path):
    return sorted(tuple(r) for r in spark.read.schema("area string, n long, day date").parquet(path).select(F.col("day").cast("string"), "area", "n").collect())


def test_replace_days_empties_days_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [("2024-01-01", "a", 1), ("2024-01-02", "a", 2), ("2024-01-03", "b", 3)]
    replace_days(spark.createDataFrame(first, DAYS), path, ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"])
    assert stored(spark, path) == first
    again = spark.createDataFrame([("2024-01-02", "c", 5)], DAYS)
    for _ in range(2):  # a second run changes nothing
        replace_days(again, path, ["2024-01-02", "2024-01-03"])
        assert stored(spark, path) == [("2024-01-01", "a", 1), ("2024-01-02", "c", 5)]
    replace_days(spark.createDataFrame([], DAYS), path, ["2024-01-01"])
    assert stored(spark, path) == [("2024-01-02", "c", 5)]


def test_replace_days_changes_nothing_when_it_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("2024-01-01", "a", 1), ("2024-01-02", "a", 2)]
    replace_days(spark.createDataFrame(rows, DAYS), path, ["2024-01-01", "2024-01-02"])
    with pytest.raises(ValueError, match="2024-01-02"):
        replace_days(spark.createDataFrame([("2024-01-02", "x", 9)], DAYS), path, ["2024-01-01"])
    with pytest.raises(Exception, match="broken"):
        replace_days(spark.createDataFrame(rows, DAYS).withColumn("n", F.raise_error(F.lit("broken")).cast("long")), path, ["2024-01-01"])
    assert stored(spark, path) == rows
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("_staged")]


WIDE = "one double, two double, seven double, area string, day date"


def wide(spark, path):
    rows = spark.read.schema(WIDE).parquet(path).select(F.col("day").cast("string"), "area", "one", "two", "seven").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_merge_columns_fills_and_inserts(spark, tmp_path):
    path = str(tmp_path / "w")
    update = lambda rows, columns: merge_columns(spark.createDataFrame(rows, f"day date, area string, {columns}"), path, WIDE, ["day", "area"])
    from datetime import date

    first, second = date(2024, 1, 1), date(2024, 1, 2)
    update([(first, "a", 0.1), (first, None, 0.2), (second, "a", 0.3)], "one double")
    untouched = {p.name for p in (tmp_path / "w" / "day=2024-01-02").iterdir()}
    for _ in range(2):
        update([(first, "a", 0.5, None), (first, None, 0.6, 0.7), (first, "b", None, 0.8)], "two double, seven double")
    assert wide(spark, path) == [
        ("2024-01-01", "a", 0.1, 0.5, None), ("2024-01-01", "b", None, None, 0.8), ("2024-01-01", None, 0.2, 0.6, 0.7), ("2024-01-02", "a", 0.3, None, None)
    ]
    assert {p.name for p in (tmp_path / "w" / "day=2024-01-02").iterdir()} == untouched
    update([(first, "a", 0.9)], "one double")
    assert ("2024-01-01", "a", 0.9, 0.5, None) in wide(spark, path)
    assert path_exists(spark, path) and not path_exists(spark, path + "x")


def test_scans_prune_partitions_and_read_grown_columns(spark, tmp_path):
    path = str(tmp_path / "logs")
    base = spark.range(40).selectExpr("'u' || id AS userId", "CAST(id % 2 AS STRING) AS product", "'play' AS log_type", "DATE '2024-01-01' + CAST(id % 4 AS INT) AS day")
    base.where("day < DATE '2024-01-03'").write.partitionBy("product", "log_type", "day").parquet(path)
    base.where("day >= DATE '2024-01-03'").withColumn("extra", F.lit(7)).write.mode("append").partitionBy("product", "log_type", "day").parquet(path)
    schema = spark.createDataFrame([], "userId string, extra int, product string, log_type string, day date").schema
    got = scan_log(spark, path, product="1", log_type="play", days=["2024-01-02", "2024-01-04"], schema=schema)
    assert got.groupBy("day").agg(F.count("*").alias("n"), F.count("extra").alias("x")).count() == 2
    assert got.agg(F.count("*"), F.count("extra")).first()[:] == (20, 10)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = got.select("*")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert all(c in filters.split("PartitionFilters")[1] for c in ("product", "log_type", "day"))


def test_exact_counts_of_a_stream(spark, tmp_path):
    schema = "userId string, datetime timestamp, kind string"
    at = lambda rows: spark.createDataFrame(rows, "userId string, t string, kind string").selectExpr("userId", "CAST(t AS TIMESTAMP) AS datetime", "kind")
    steps = [
        [("a", "2024-01-01 10:10:00", "x"), ("a", "2024-01-01 10:20:00", "x"), (None, "2024-01-01 10:30:00", "y")],
        [("b", "2024-01-01 11:50:00", "x"), ("a", "2024-01-01 10:59:00", "x")],  # the second row is late, and counts
        [("c", "2024-01-01 15:00:00", "x")],
        [("late", "2024-01-01 10:05:00", "x")],  # its window is closed
        [("end", "2024-01-03 00:00:00", "x")], [("end", "2024-01-03 00:00:00", "x")],
    ]
    for rows in steps:
        at(rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        start_day_sink(exact_counts(stream, ["kind"]), str(tmp_path / "out"), str(tmp_path / "state"), available_now=True).awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).where("start < '2024-01-02'").collect()}
    assert got == {tuple(r) for r in exact_counts(at(sum(steps[:3], [])), ["kind"]).collect()}
