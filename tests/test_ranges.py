"""Addresses in ranges: overlapping ones, single addresses, blocks full of ranges."""

import random

from pyspark.sql import functions as F

from viewtally.operators.enrich import lookup_ranges


def text(n):
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def brute(ips, ranges):
    out = {}
    for n in ips:
        hits = [(lo, -hi, name) for lo, hi, name in ranges if lo <= n <= hi]
        if hits:
            out[text(n)] = max(hits)[2]
    return out


def found(spark, ips, ranges):
    df = spark.createDataFrame([(text(lo), text(hi), name) for lo, hi, name in ranges], "lo string, hi string, name string")
    got = lookup_ranges(spark.createDataFrame([(text(n),) for n in ips], "ip string").distinct(), df, ["name"])
    return {r.ip: r.name for r in got.collect()}


def test_overlapping_ranges_of_all_sizes(spark):
    rng = random.Random(4)
    base = 10 << 24
    starts = [base + rng.randrange(1 << 18) for _ in range(300)]
    ranges = {(lo, lo + rng.choice([0, 0, 1, 15, 16, 255, 256, 4095, 4096, 65535, 65536, 200000])) for lo in starts}
    ranges = [(lo, hi, f"r{i}") for i, (lo, hi) in enumerate(sorted(ranges))] + [(0, 2**32 - 1, "all"), (9, 3, "none")]
    ips = [base + rng.randrange(1 << 19) for _ in range(400)] + [lo for lo, _, _ in ranges] + [hi for _, hi, _ in ranges]
    assert found(spark, ips, ranges) == brute(set(ips), ranges)


def test_a_block_of_single_addresses_makes_no_pairs(spark):
    base = 20 << 24
    df = spark.range(base, base + 40_000).selectExpr("concat_ws('.', id >> 24 & 255, id >> 16 & 255, id >> 8 & 255, id & 255) AS ip")
    ranges = df.select(F.col("ip").alias("lo"), F.col("ip").alias("hi"), F.col("ip").alias("name"))
    got = lookup_ranges(df, ranges, ["name"])
    assert got.where("name = ip").count() == 40_000
