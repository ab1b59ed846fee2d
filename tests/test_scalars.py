import pytest
from pyspark.sql import functions as F

from viewtally.functions import network as N
from viewtally.functions import scalars as S


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"p {kind}").select(expr(F.col("p")).alias("x")).first()["x"]


@pytest.mark.parametrize("v,want", [("TVApp3.0_X_3.1.4", "3.1.4"), ("3.1.4", "3.1.4"), ("", "kong"), (None, "null")])
def test_apk_version(spark, v, want):
    assert one(spark, v, "string", S.apk_version) == want


@pytest.mark.parametrize("v,want", [(None, "null"), ("", "kong"), ("a-b", "corrupt"), ("ab", "ab")])
def test_normalize_key(spark, v, want):
    assert one(spark, v, "string", lambda c: S.normalize_key(c, r"^\w+$")) == want


@pytest.mark.parametrize("n,want", [(1, "登入1次"), (3, "登入3次"), (4, "登入4-5次"), (6, "登入6-8次"), (9, "登入9-15次"), (16, "登入大于15次")])
def test_login_bucket(spark, n, want):
    assert one(spark, n, "bigint", S.login_count_bucket) == want


@pytest.mark.parametrize("n,want", [(30, "0-30s"), (31, "30-60s"), (300, "180-300s"), (301, "5-15min"), (21600, "5-6h"), (21601, ">6h")])
def test_duration_label(spark, n, want):
    assert one(spark, n, "bigint", S.duration_bucket) == want


@pytest.mark.parametrize("n,want", [(86400, 1440), (86401, 86402), (None, 0)])
def test_duration_unit(spark, n, want):
    assert one(spark, n, "bigint", lambda c: S.duration_in(c, "m")) == want


@pytest.mark.parametrize("ip,key", [("1.2.3.4", 16909056), ("x.y", 0), (None, 0)])
def test_network_key(spark, ip, key):
    assert one(spark, ip, "string", N.network_key) == key


def test_padded_ip(spark):
    assert one(spark, "1.20.3.244", "string", N.padded_ip) == "001.020.003.244"


@pytest.mark.parametrize("t,want", [("2024-01-01 10:05:00", "10:06:00"), ("2024-01-01 10:05:01", "10:06:00")])
def test_ceil_minute(spark, t, want):
    assert one(spark, t, "string", lambda c: S.ceil_minute(c.cast("timestamp")).cast("string")).endswith(want)


@pytest.mark.parametrize("m,want", [("MiBOX3", "小米盒子"), (None, "NULL"), ("10moons_x", "10MOONS"), ("abc", "其他品牌")])
def test_brand(spark, m, want):
    assert one(spark, m, "string", S.brand_by_prefix) == want


@pytest.mark.parametrize("e,want", [("up", "ok"), ("down", "cancel"), ("x", "error"), (None, "error")])
def test_event_alias(spark, e, want):
    assert one(spark, e, "string", S.event_alias) == want


def test_version_order_is_text_unless_numeric(spark):
    assert one(spark, "3.1.10", "string", lambda c: S.version_at_least(c, "3.1.4")) is False
    assert one(spark, "3.1.10", "string", lambda c: S.version_at_least(c, "3.1.4", numeric=True)) is True


@pytest.mark.parametrize("m,want", [("aa:bb:cc", "AABBCC"), ("aabbcc", "AABBCC"), ("", None), (None, None)])
def test_canonical_mac(spark, m, want):
    assert one(spark, m, "string", S.canonical_mac) == want
