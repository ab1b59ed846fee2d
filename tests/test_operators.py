"""Operators on small frames: null rules, skew cases, loop forms, sinks."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from viewtally.operators.counts import explode_contained, funnel_join, play_duration, pv_uv, pv_uv_duration, with_totals
from viewtally.operators.distributions import event_gaps, threshold_curve
from viewtally.operators.enrich import dim_enrich, lookup_ranges
from viewtally.operators.identity import dedup_identity, same_device_keys
from viewtally.operators.live import occupancy
from viewtally.operators.quality import blacklist_filter, flood_filter
from viewtally.operators.rankings import topn_per_group
from viewtally.operators.reconcile import reconcile
from viewtally.operators.retention import cohort_retention
from viewtally.operators.rollout import accumulate_new, non_play_rate
from viewtally.operators.qos import qos_explode
from viewtally.sources.logs import scan_dim, scan_log
from viewtally.sources.merge import merge_sources, project_whitelist
from viewtally.sources.sinks import checkpoint_step, write_day


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_flood_filter_limit_nulls_and_no_key_collision(spark):
    data = [("u", "v")] * 5000 + [("w", "v")] * 4999 + [(None, "v")] * 5001 + [("a", "bc")] * 3000 + [("ab", "c")] * 3000
    kept = flood_filter(spark.createDataFrame(data, "u string, v string"), ["u", "v"])
    counts = {(r.u, r.v): r["count"] for r in kept.groupBy("u", "v").count().collect()}
    assert counts == {("w", "v"): 4999, (None, "v"): 5001, ("a", "bc"): 3000, ("ab", "c"): 3000}


def test_starts_and_durations(spark):
    data = [
        ("both", "a", "startplay", None), ("both", "a", "userexit", 10), ("both", "b", "userexit", 10800), ("both", "b", "userexit", 10801),
        ("both", "c", "userexit", None), ("both", "c", "userexit", 0), ("starts", "a", "startplay", None), ("ends", "a", "userexit", 5),
        ("two", "a", "playview", 7),
    ]
    df = spark.createDataFrame(data, "k string, userId string, event string, duration bigint")
    inner = {r.k: (r.pv, r.uv, r.duration) for r in play_duration(df, ["k"]).collect()}
    assert inner == {"both": (1, 1, 10810), "two": (1, 1, 7)}
    assert {r.k for r in play_duration(df, ["k"], how="left").collect()} == {"both", "starts", "two"}
    assert {r.k for r in play_duration(df, ["k"], how="full").collect()} == {"both", "starts", "ends", "two"}


def test_null_user_rules(spark):
    df = spark.createDataFrame([("k", "a"), ("k", "a"), ("k", None), ("only", None)], "k string, userId string")
    assert rows(pv_uv(df, ["k"])) == [("k", 2, 1), ("only", 0, 0)]
    assert rows(pv_uv(df, ["k"], null_user="count")) == [("k", 3, 2), ("only", 1, 1)]


def test_literal_matches_several(spark):
    df = spark.createDataFrame([("12",), ("1",), (None,)], "p string")
    assert rows(explode_contained(df, "p", ["1", "2", "12"])) == [("1", "1"), ("12", "1"), ("12", "12"), ("12", "2")]


def test_dim_enrich_does_not_fan_out(spark):
    fact = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    dim = spark.createDataFrame(
        [("a", "old", "2020-01-01"), ("a", "x", None), ("a", "y", None), (" b ", "z", None)], "k string, v string, dim_invalid_time string"
    )
    out = dim_enrich(fact, dim, ["k"], {"v": "v"}, default="miss", trim=True)
    assert rows(out) == [("a", "y"), ("b", "z"), ("c", "miss"), (None, "miss")]


def test_funnel_join_null_keys_and_ways(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([("y", 5), (None, 6)], "k string, b int")
    assert rows(funnel_join([a, b], ["k"])) == [(None, 2, 6)]
    assert rows(funnel_join([a, b], ["k"], how="left")) == [("x", 1, 0), (None, 2, 6)]
    assert rows(funnel_join([a, b], ["k"], how="full")) == [("x", 1, 0), ("y", 0, 5), (None, 2, 6)]


def test_totals_of_null_group(spark):
    df = spark.createDataFrame([(None, "a", 1), (None, "b", 2), ("g", "a", 5)], "g string, k string, n bigint")
    assert {(r.g, r.t) for r in with_totals(df, ["g"], "n", "t").collect()} == {(None, 3), ("g", 5)}
    assert {r.t for r in with_totals(df, [], "n", "t").collect()} == {8}


def test_topn_ties(spark):
    df = spark.createDataFrame([("g", c, n) for c, n in [("a", 3), ("b", 2), ("c", 2), ("d", 1)]], "g string, k string, n int")
    assert [r.k for r in topn_per_group(df, ["g"], "n", 2, ["k"]).orderBy("rank").collect()] == ["a", "b"]
    assert {r.k for r in topn_per_group(df, ["g"], "n", 2, ties="keep").collect()} == {"a", "b", "c"}


def test_blacklist_rules(spark):
    df = spark.createDataFrame([("bad",), ("both",), ("ok",), ("a b",), ("",), (None,)], "c string")
    kept = blacklist_filter(df, "c", ["bad", "both"], ["both"], r"^[\w\-]+$")
    assert {r.c for r in kept.collect()} == {"both", "ok", "", None}
    frame = spark.createDataFrame([("bad",), ("both",)], "x string")
    assert {r.c for r in blacklist_filter(df, "c", frame, ["both"], r"^[\w\-]+$").collect()} == {"both", "ok", "", None}


def test_retention_equals_loop(spark):
    rnd = random.Random(3)
    cohort = [(f"u{i}", f"2024-01-{rnd.randint(1, 9):02d}") for i in range(200)]
    activity = [(f"u{rnd.randint(0, 220)}", f"2024-01-{rnd.randint(1, 20):02d}") for _ in range(3000)]
    c = spark.createDataFrame(cohort, "userId string, day string").withColumn("day", F.to_date("day"))
    a = spark.createDataFrame(activity, "userId string, day string").withColumn("day", F.to_date("day"))
    seen = {(u, int(d[-2:])) for u, d in activity}
    last = max(d for _, d in seen)
    by_day = defaultdict(set)
    for u, d in cohort:
        by_day[int(d[-2:])].add(u)
    want = {(d, k): (len(us), sum((u, d + k) in seen for u in us)) for d, us in by_day.items() for k in (1, 2, 7, 14) if d + k <= last}
    got = {(r.day.day, r.offset): (r.users, r.kept) for r in cohort_retention(c, a, (1, 2, 7, 14)).collect()}
    assert got == want


def test_threshold_curve_equals_loop(spark):
    rnd = random.Random(5)
    plays = [(f"u{rnd.randint(0, 9)}", f"v{rnd.randint(0, 5)}") for _ in range(300)]
    counts = defaultdict(int)
    for p in plays:
        counts[p] += 1
    want = {}
    for n in set(counts.values()):
        upto = {k: c for k, c in counts.items() if c <= n}
        want[n] = (len({u for u, _ in upto}), sum(upto.values()), len({u for u, _ in counts}), len(plays))
    df = spark.createDataFrame(plays, "u string, v string")
    got = {r.n: (r.valid_uv, r.valid_pv, r.uv, r.pv) for r in threshold_curve(df, ["u", "v"], user="u").collect()}
    assert got == want


@pytest.mark.parametrize("seconds", [1, 7, 3600])
def test_gaps_do_not_depend_on_slices(spark, seconds):
    times = [0, 3, 3, 3, 10, 50, 4000, 9000]
    df = spark.createDataFrame([("k", t) for t in times] + [("single", 5)], "k string, s bigint").withColumn("ts", F.timestamp_seconds("s"))
    got = sorted(g for r in event_gaps(df, ["k"], "ts", seconds).collect() for g in [r.gap_seconds] * r.times)
    assert got == sorted(b - a for a, b in zip(times, times[1:]))


def test_identity_uses_all_earlier_accounts(spark):
    data = [(1, "m1", "w1"), (2, "m2", "w1"), (3, "m2", "w3"), (4, None, "020000000000"), (5, "", "02:00:00:00:00:00"), (6, "m6", "w:6"), (7, "m7", "W6")]
    df = spark.createDataFrame(data, "id bigint, mac string, wifi_mac string")
    got = {r.id: r.original for r in dedup_identity(df, same_device_keys()).collect()}
    assert got == {1: None, 2: 1, 3: 2, 4: None, 5: None, 6: None, 7: 6}


def test_accumulate_keeps_first_day(spark):
    prev = spark.createDataFrame([("a", "d1", "u1")], "mac string, day string, userId string")
    today = spark.createDataFrame([("a", "d2", "u9"), ("b", "d2", "u3"), ("b", "d2", "u2"), (None, "d2", "u")], "mac string, day string, userId string")
    assert rows(accumulate_new(prev, today, ["mac"], "day", ["userId"])) == [("a", "d1", "u1"), ("b", "d2", "u2")]


def test_non_play_keeps_empty_groups(spark):
    new = spark.createDataFrame([("a", "2024-01-01", "g"), ("b", "2024-01-01", "h")], "userId string, day string, g string").withColumn("day", F.to_date("day"))
    plays = spark.createDataFrame([("a", "2024-01-14"), ("b", "2024-01-15")], "userId string, day string").withColumn("day", F.to_date("day"))
    assert rows(non_play_rate(new, plays, ["g"])) == [("g", 1, 1), ("h", 1, 0)]


def test_occupancy_slots_over_midnight(spark):
    data = [("u1", "2024-01-01 10:27:00", 24 * 60), ("u2", "2024-01-02 00:05:00", 600), ("u3", "2024-01-01 10:00:00", 99999)]
    df = spark.createDataFrame(data, "userId string, t string, duration bigint").withColumn("datetime", F.to_timestamp("t"))
    got = {(str(r.slot), r.uv) for r in occupancy(df.withColumn("k", F.lit("c")), "datetime", "duration", ["k"], high=36000).collect()}
    assert got == {("2024-01-01 10:00:00", 1), ("2024-01-01 10:10:00", 1), ("2024-01-01 10:20:00", 1), ("2024-01-01 23:50:00", 1), ("2024-01-02 00:00:00", 1)}


def test_ranges_cross_blocks(spark):
    ranges = spark.createDataFrame([("1.0.0.0", "1.1.255.255", "wide"), ("1.1.5.0", "1.1.5.255", "inner"), ("9.9.9.9", "9.9.9.0", "empty")], "lo string, hi string, city string")
    ips = spark.createDataFrame([("1.0.200.1",), ("1.1.5.7",), ("1.1.6.0",), ("2.0.0.0",), ("bad",)], "ip string")
    assert rows(lookup_ranges(ips, ranges, ["city"])) == [("1.0.200.1", "wide"), ("1.1.5.7", "inner"), ("1.1.6.0", "wide")]


def test_quality_documents(spark):
    docs = [
        '{"userId":"u","playqos":[{"videoSource":"a","sourcecases":[{"playCode":200},{"playCode":-1}]},{"videoSource":"b","sourcecases":[{"playCode":1},{"playCode":2}]}]}',
        '{"userId":"u"}', '{"userId":"u","playqos":[{"videoSource":"c"}]}', "{broken", None,
    ]
    df = spark.createDataFrame([(d,) for d in docs], "jsonLog string")
    kept = [(r.videoSource, r.playCode, r.playQos, r.sourceCases) for r in qos_explode(df).collect()]
    assert sorted(kept, key=str) == sorted([("a", 200, True, True), ("a", -1, True, True), ("b", 1, True, True), ("b", 2, True, True), ("none", None, False, False), ("c", None, True, False)], key=str)
    counted = qos_explode(df, broken="keep").groupBy("playCode").count().collect()
    assert {r.playCode: r["count"] for r in counted}[0] == 2


def test_whitelist_and_merge(spark):
    new = spark.createDataFrame([("u", "12", "x")], "userId string, duration string, extra string")
    old = spark.createDataFrame([("w", "bad")], "userId string, duration string")
    cut = project_whitelist(new, {"userId": "string", "duration": "bigint", "groupId": "string"})
    assert [f.dataType.simpleString() for f in cut.schema.fields] == ["string", "bigint", "string"]
    both = merge_sources([(new, "3x"), (old, "2x")], {"userId": "string", "duration": "bigint"})
    assert rows(both) == [("u", 12, "3x"), ("w", None, "2x")]
    assert rows(merge_sources([(None, "3x"), (old, "2x")])) == [("w", "bad", "2x")]
    with pytest.raises(ValueError):
        merge_sources([(None, "3x")])


def test_write_day_replaces_only_its_day(spark, tmp_path):
    path = str(tmp_path / "out")
    write_day(spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, n int"), path)
    write_day(spark.createDataFrame([("d2", 9), ("d2", 8)], "day string, n int"), path, files=2)
    assert sorted((r.day, r.n) for r in spark.read.parquet(path).collect()) == [("d1", 1), ("d2", 8), ("d2", 9)]
    text = str(tmp_path / "text")
    write_day(spark.createDataFrame([("d1", "a", 1)], "day string, k string, n int"), text, fmt="csv", sep="\t")
    assert [r.value for r in spark.read.text(text).collect()] == ["a\t1"]


def test_scan_log_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "log")
    data = [("3x", t, f"2024-01-0{d}", f"u{d}") for t in ("play", "enter", "crash") for d in range(1, 5)]
    log = spark.createDataFrame(data, "product string, log_type string, day string, userId string").withColumn("day", F.to_date("day"))
    write_day(log, path, partitions=("product", "log_type", "day"))
    got = scan_log(spark, path, "3x", ["play", "enter"], ("2024-01-02", "2024-01-03"), between=True)
    assert got.count() == 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert scan_log(spark, path, days="2024-01-01", exclude_types=["crash"]).count() == 2


def test_scan_dim_current_rows(spark, tmp_path):
    spark.createDataFrame([("a", None), ("b", "2020")], "k string, dim_invalid_time string").write.parquet(str(tmp_path / "dim" / "x"))
    assert rows(scan_dim(spark, str(tmp_path / "dim"), "x").select("k")) == [("a",)]


def test_checkpoint_step_counts_in_one_pass(spark, tmp_path):
    df = spark.range(10).withColumn("ok", F.col("id") % 2 == 0)
    out, seen = checkpoint_step(df, str(tmp_path / "step"), metrics={"kept": F.count_if("ok")})
    assert out.count() == 10 and seen.get == {"rows": 10, "kept": 5}
    out, seen = checkpoint_step(df, name="other")
    assert out.count() == 10 and seen.get["rows"] == 10


def test_reconcile(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), (None, 2)], "k string, n int")
    b = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "k string, n int")
    assert rows(reconcile(a, b)) == [("x", 1, 2, 1), ("y", 3, 0, 1)]
    assert reconcile(a, a).count() == 0


def test_counts_read_only_their_columns(spark, tmp_path):
    path = str(tmp_path / "log")
    data = [("u", "startplay", "movie", "v", 1), ("u", "userexit", "movie", "v", 2)]
    spark.createDataFrame(data, "userId string, event string, contentType string, videoSid string, duration int").write.parquet(path)
    out = pv_uv(spark.read.parquet(path), ["contentType"], where=F.col("event") == "startplay")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event,startplay)" in plan
    assert "ReadSchema: struct<userId:string,event:string,contentType:string>" in plan


def test_one_scan_for_starts_and_durations(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([("u", "startplay", 1)], "userId string, event string, duration int").write.parquet(path)
    plan = pv_uv_duration(spark.read.parquet(path), ["event"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") <= 1 and "Expand" not in plan and "Join" not in plan


def test_hot_key_is_one_row_per_task_before_the_shuffle(spark):
    """Both grouping steps combine before their exchange."""
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.lit("u").alias("userId"))
    plan = pv_uv(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan and "partial_sum" in plan
