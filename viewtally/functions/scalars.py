"""Scalar expressions over log fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_of(c, labels: Mapping[str, str], default: Column | str | None = None) -> Column:
    """Dictionary lookup with a default: one constant map, ``c`` read once."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.try_element_at(table, column(c)), fallback)


def banded(c, bounds: Sequence[tuple[int, str]], above: str) -> Column:
    """First label whose inclusive upper bound holds; null stays null."""
    c = column(c)
    expr = F.when(c.isNull(), F.lit(None).cast("string"))
    for upper, label in bounds:
        expr = expr.when(c <= upper, F.lit(label))
    return expr.otherwise(F.lit(above))


def normalize_key(c, pattern: str | None = None, max_length: int | None = None) -> Column:
    """null -> 'null', '' -> 'kong', not matching ``pattern`` -> 'corrupt', over ``max_length`` -> 'toolong'."""
    c = column(c)
    expr = F.when(c.isNull(), V.KEY_NULL).when(c == "", V.KEY_EMPTY)
    if pattern is not None:
        expr = expr.when(~c.rlike(pattern), V.KEY_CORRUPT)
    if max_length is not None:
        expr = expr.when(F.length(c) > max_length, V.KEY_LONG)
    return expr.otherwise(c)


def fits(c, max_length: int) -> Column:
    """Key short enough for the result table."""
    return F.length(column(c)) <= max_length


def event_alias(c) -> Column:
    """Thumb events under their newer names."""
    return label_of(c, {"up": "ok", "down": "cancel"}, "error")


def has_non_ascii(c) -> Column:
    return column(c).rlike(r"[^\x00-\x7F]")


def strip_invalid(c, pattern: str = r"[^\w\-.:]") -> Column:
    return F.regexp_replace(column(c), pattern, "")


def blank(c) -> Column:
    """Null or only blanks."""
    c = column(c)
    return c.isNull() | (F.trim(c) == "")


# ------------------------------------------------------------------ versions
def apk_version(series) -> Column:
    """Text after the last underscore; null -> 'null', '' -> 'kong'."""
    series = column(series)
    return (
        F.when(series.isNull(), V.KEY_NULL)
        .when(series == "", V.KEY_EMPTY)
        .otherwise(F.substring_index(series, "_", -1))
    )


def series_part(series) -> Column:
    """Text before the last underscore, '' without one."""
    return F.regexp_extract(column(series), r"^(.*)_[^_]*$", 1)


def major_version(version) -> Column:
    version = column(version)
    return F.when(version.isNull(), V.UNKNOWN).otherwise(F.substring(version, 1, 1))


def version_number(version, parts: int = 4) -> Column:
    """Version as an array of ints, so that it sorts by number."""
    pieces = F.split(column(version), r"\.")
    return F.array(*[F.coalesce(F.get(pieces, F.lit(i)).try_cast("int"), F.lit(0)) for i in range(parts)])


def version_at_least(version, floor: str, numeric: bool = False) -> Column:
    """Text order by default ('3.1.10' < '3.1.4'); by number on request."""
    if numeric:
        return version_number(version) >= version_number(F.lit(floor))
    return column(version) >= floor


def version_band(version, exact: Sequence[str], oldest: str, old: str = "old", other: str = "other") -> Column:
    """One of the ``exact`` versions, 'old' below ``oldest``, else 'other'."""
    version = column(version)
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for name in exact:
        expr = expr.when(version == name, F.lit(name))
    return expr.when(version < oldest, F.lit(old)).otherwise(F.lit(other))


# ----------------------------------------------------------------- durations
UNIT_SECONDS = {"s": 1, "m": 60, "q": 900, "h": 3600}
DAY_SECONDS = 86400


def duration_in(duration, unit: str = "s") -> Column:
    """Whole units up to one day; longer ones stay in seconds, plus one.

    The extra second marks "more than a day" and is part of the result.
    """
    duration = column(duration)
    whole = F.floor(duration / UNIT_SECONDS[unit]).cast("bigint")
    return (
        F.when(duration.isNull(), F.lit(0).cast("bigint"))
        .when(duration <= DAY_SECONDS, whole)
        .otherwise((duration + 1).cast("bigint"))
    )


def duration_bucket(duration) -> Column:
    return banded(duration, V.DURATION_LABELS, V.DURATION_LONGEST)


def login_count_bucket(n) -> Column:
    n = column(n)
    few = F.concat(F.lit("登入"), n.cast("string"), F.lit("次"))
    return F.when(n <= 3, few).otherwise(banded(n, V.LOGIN_COUNT_LABELS, V.LOGIN_COUNT_MOST))


# --------------------------------------------------------------------- times
def hour_of(c) -> Column:
    """Hour of a timestamp or of ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.hour(column(c).cast("timestamp"))


def floor_minute(ts) -> Column:
    return F.date_trunc("minute", column(ts))


def ceil_minute(ts) -> Column:
    """The next full minute; an exact minute moves on as well."""
    return floor_minute(ts) + F.expr("INTERVAL 1 MINUTE")


# -------------------------------------------------------------- demographics
def age_band(birth_year, this_year: int | Column) -> Column:
    """Age band of a birth-year text; calendar text or blank is 'other',
    a year that is no number or not in the past gives null."""
    text = column(birth_year)
    now = F.lit(this_year) if isinstance(this_year, int) else this_year
    age = now - text.try_cast("int")
    marked = (text == "") | text.contains(V.CALENDAR_MARKS[0]) | text.contains(V.CALENDAR_MARKS[1])
    return F.when(marked, F.lit(V.OTHER)).when(age > 0, banded(age, V.AGE_BANDS, V.AGE_OLDEST))


def gender_code(text) -> Column:
    lowered = F.lower(column(text))
    return F.when(lowered.isin("f", "m", "o"), lowered).otherwise(F.lit("0"))


def region_parts(text) -> Column:
    """(province, city) of 'province,city' or 'province;city' text."""
    text = column(text)
    semi, comma = F.split(text, ";"), F.split(text, ",")
    parts = F.when(F.size(semi) > F.size(comma), semi).otherwise(comma)
    first = F.get(parts, F.lit(0))
    second = F.get(parts, F.lit(1))
    alone = second.isNull() | second.isin("", V.CITY_DISTRICT)
    province = F.when(text == "", F.lit(V.OTHER)).otherwise(first)
    city = F.when(text == "", F.lit(V.OTHER)).when(alone, first).otherwise(second)
    return F.struct(province.alias("province"), city.alias("city"))


# ------------------------------------------------------------------- devices
def brand_by_prefix(model) -> Column:
    """Brand of a model that no dictionary knows."""
    model = column(model)
    expr = F.when(model.isNull(), F.lit(V.BRAND_NULL))
    for start, brand in V.BRAND_PREFIXES:
        expr = expr.when(model.startswith(start), F.lit(brand))
    start, brand = V.BRAND_PREFIX_ANY_CASE
    return expr.when(F.upper(model).startswith(start), F.lit(brand)).otherwise(F.lit(V.BRAND_OTHER))


def canonical_mac(mac) -> Column:
    """One spelling for ``aa:bb:..`` / ``AABB..``; blank becomes null."""
    return F.nullif(F.upper(F.regexp_replace(F.trim(column(mac)), "[:-]", "")), F.lit(""))


def valid_wifi_mac(mac) -> Column:
    """Canonical Wi-Fi address, null when it identifies no device."""
    clean = canonical_mac(mac)
    bad = sorted({m.replace(":", "").upper() for m in V.INVALID_WIFI_MACS})
    return F.when(~clean.isin(bad), clean)


def id_hash(user) -> Column:
    """A positive long for an id, where a set key must be a number."""
    return F.xxhash64(column(user)).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
