"""Dimension joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.network import ip_number, network_key, padded_ip
from ..functions.scalars import brand_by_prefix
from ._keys import left_join_known, left_join_spread


def unique_dim(
    dim: DataFrame, on: Mapping[str, Column], cols: Mapping[str, str], pick: str = "max", valid_col: str | None = None
) -> DataFrame:
    """Current rows, one per key, so that a join can not multiply the fact.

    ``pick`` says which row of a key wins; all columns come from that row.
    """
    if valid_col is not None:
        dim = dim.where(F.col(valid_col).isNull())
    keyed = dim.select(*[expr.alias(k) for k, expr in on.items()], *[F.col(src).alias(out) for out, src in cols.items()])
    for k in on:
        keyed = keyed.where(F.col(k).isNotNull())
    chooser = {"max": F.max, "min": F.min}[pick]
    best = keyed.groupBy(*on).agg(chooser(F.struct(*cols.keys())).alias("_best"))
    return best.select(*on, *[F.col(f"_best.{c}").alias(c) for c in cols])


def dim_enrich(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str | tuple[Column | str, Column | str]] | Sequence[str],
    cols: Mapping[str, str] | Sequence[str],
    default: Column | str | Mapping[str, Column | str] | None = None,
    valid_col: str | None = "dim_invalid_time",
    pick: str = "max",
    trim: bool = False,
    guard: Column | None = None,
    null_safe: Sequence[str] = (),
    how: str = "left",
    spread: bool = False,
) -> DataFrame:
    """Add dimension columns to a fact.

    ``on`` maps a fact column to a dimension column, or a name to a pair of
    expressions; keys may be trimmed. ``guard`` is a condition on the fact
    under which the row may match at all; it turns the key into null, so the
    join stays an equi join. ``null_safe`` lists keys where null matches null.
    ``cols`` maps the new column to the dimension column; a miss gets
    ``default``. The dimension is cut to its current rows and one row per key.
    ``spread`` deals the rows of frequent keys over many tasks, for a dimension
    too large to be broadcast; it counts the fact's keys first.
    """
    if not isinstance(on, Mapping):
        on = {c: c for c in on}
    if not isinstance(cols, Mapping):
        cols = {c: c for c in cols}
    if valid_col is not None and valid_col not in dim.columns:
        valid_col = None
    fact_keys: dict[str, Column] = {}
    dim_keys: dict[str, Column] = {}
    for i, (left, right) in enumerate(on.items()):
        if isinstance(right, tuple):
            l_expr, r_expr = (F.col(e) if isinstance(e, str) else e for e in right)
        else:
            l_expr, r_expr = F.col(left), F.col(right)
        if trim:
            l_expr, r_expr = F.trim(l_expr), F.trim(r_expr)
        if left in null_safe:
            # a mark no code can be, so that null equals null in an equi join
            l_expr, r_expr = (F.coalesce(e.cast("string"), F.lit("\u0000")) for e in (l_expr, r_expr))
        if guard is not None and i == 0:
            l_expr = F.when(guard, l_expr)
        fact_keys[f"_k{i}"], dim_keys[f"_k{i}"] = l_expr, r_expr
    temp = {f"_v{i}": src for i, src in enumerate(cols.values())}
    one = unique_dim(dim, dim_keys, temp, pick, valid_col)
    keyed = fact.select("*", *[e.alias(k) for k, e in fact_keys.items()])
    joined = (left_join_spread if spread else left_join_known)(keyed, one, list(fact_keys), how)
    out = [F.col(f"`{c}`") for c in fact.columns if c not in cols]
    for i, name in enumerate(cols):
        value = F.col(f"_v{i}")
        fallback = default.get(name) if isinstance(default, Mapping) else default
        if fallback is not None:
            value = F.coalesce(value, fallback if isinstance(fallback, Column) else F.lit(fallback))
        out.append(value.alias(name))
    return joined.select(*out)


def brand_enrich(
    fact: DataFrame, brands: DataFrame, model: str, key: str = "product_model", brand: str = "brand_name", out: str = "brand"
) -> DataFrame:
    """Brand of a product model: dictionary first, then the prefix rules."""
    return dim_enrich(fact, brands, {model: key}, {out: brand}, default=brand_by_prefix(model))


def mac_brand_enrich(fact: DataFrame, prefixes: DataFrame, mac: str, out: str = "brand", default: str | None = None) -> DataFrame:
    """Device brand by the first six, then the first eight characters of the
    MAC. ``prefixes`` has (prefix, brand)."""
    for size in (6, 8):
        part = prefixes.where(F.length("prefix") == size)
        fact = dim_enrich(
            fact, part, {"_mac": (F.substring(F.col(mac), 1, size), F.col("prefix"))}, {f"_b{size}": "brand"}
        )
    return fact.withColumn(out, F.coalesce("_b6", "_b8", F.lit(default))).drop("_b6", "_b8")


def network_enrich(
    fact: DataFrame, locations: DataFrame, ip: str, cols: Mapping[str, str], key: str = "web_location_key", default=None
) -> DataFrame:
    """Location of the /24 network of an address, by an equi join."""
    return dim_enrich(fact, locations, {"_net": (network_key(ip), F.col(key))}, cols, default=default)


# Blocks of addresses by which ranges are found, each sixteen times the one before.
BLOCK_SIZES = (1, 16, 256, 4096, 65536)


def lookup_ranges(ips: DataFrame, ranges: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Range of each distinct address: (ip, cols).

    ``ranges`` has text bounds ``lo`` and ``hi``. A range lies in the one or two
    blocks of the smallest size it fits in (larger ones in all /16 blocks they
    touch), and an address asks for its block of every size: an equi join in
    which ranges that do not overlap put at most 17 into a block of their size,
    however many single addresses are listed, and no block holds more than
    65,536 distinct addresses. Of overlapping ranges the one that starts last
    wins, the shorter one of equal starts.
    """
    lo, hi = ip_number("lo"), ip_number("hi")
    own = ranges.select(lo.alias("_lo"), hi.alias("_hi"), *cols).where(F.col("_lo") <= F.col("_hi"))
    size = F.lit(BLOCK_SIZES[-1])
    for s in reversed(BLOCK_SIZES[:-1]):
        size = F.when(F.col("_hi") - F.col("_lo") < s, F.lit(s)).otherwise(size)
    own = own.withColumn("_size", size)
    first, last = (F.floor(F.col(c) / F.col("_size")) for c in ("_lo", "_hi"))
    blocks = own.withColumn("_block", F.explode(F.sequence(first, last)))
    numbered = ips.withColumn("_n", ip_number("ip")).where(F.col("_n").isNotNull())
    asked = numbered.withColumn("_size", F.explode(F.array(*[F.lit(s) for s in BLOCK_SIZES])))
    found = (
        asked.withColumn("_block", F.floor(F.col("_n") / F.col("_size")))
        .join(blocks, ["_size", "_block"])
        .where(F.col("_n").between(F.col("_lo"), F.col("_hi")))
    )
    best = found.groupBy("ip").agg(F.max_by(F.struct(*cols), F.struct("_lo", -F.col("_hi"))).alias("_best"))
    return best.select("ip", *[F.col(f"_best.{c}").alias(c) for c in cols])


def geo_enrich(
    fact: DataFrame,
    ip: str,
    ranges: DataFrame,
    prefixes: DataFrame | None = None,
    cols: Sequence[str] = ("country", "province", "city"),
    unknown: str = "未知",
) -> DataFrame:
    """Address to location: exact network prefix first, ranges second.

    ``prefixes`` has a ``prefix`` of three octets ('1.2.3'). The look-up runs
    on distinct addresses, so the log is shuffled once, by address, and a hot
    address is one row in the range join.
    """
    cols = list(cols)
    ips = fact.select(F.col(ip).alias("ip")).where(F.col(ip).isNotNull()).distinct()
    located = lookup_ranges(ips, ranges, cols)
    if prefixes is not None:
        by_prefix = dim_enrich(
            ips, prefixes, {"_p": (F.substring_index(F.trim(F.col("ip")), ".", 3), F.col("prefix"))},
            {f"_p_{c}": c for c in cols},
        )
        located = by_prefix.join(located, "ip", "left").select(
            "ip", *[F.coalesce(f"_p_{c}", c).alias(c) for c in cols]
        )
    renamed = located.select(F.col("ip").alias("_ip"), *[F.col(c).alias(f"_g_{c}") for c in cols])
    joined = left_join_known(fact.withColumn("_ip", F.col(ip)), renamed, ["_ip"])
    return joined.select(
        *[F.col(c) for c in fact.columns if c not in cols],
        *[F.coalesce(F.col(f"_g_{c}"), F.lit(unknown)).alias(c) for c in cols],
    )


def range_contains(ip: Column | str, lo: Column | str, hi: Column | str) -> Column:
    """Whether an address lies in a range, on zero-padded text."""
    return padded_ip(ip).between(padded_ip(lo), padded_ip(hi))
