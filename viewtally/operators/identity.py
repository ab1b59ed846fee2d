"""Accounts that belong to the same device."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import canonical_mac, valid_wifi_mac
from ._keys import left_join_known


def dedup_identity(
    accounts: DataFrame, keys: Mapping[str, Sequence[Column]], order: str = "id"
) -> DataFrame:
    """Mark accounts for which an earlier account has the same key.

    ``keys`` names the rules; each is a list of expressions that must all be
    equal and non-null. Adds ``is_duplicate`` and ``original`` (the smallest
    earlier ``order`` value over all rules). An account is compared with all
    earlier accounts, also with those that are duplicates themselves.

    Per rule: the smallest order value per key (combined on the map side, so a
    key that many accounts share costs one row per task), joined back by equi
    join. An OR of the rules would be a nested loop.
    """
    out = accounts
    found = []
    for i, (rule, parts) in enumerate(keys.items()):
        names = [f"_r{i}_{j}" for j in range(len(parts))]
        out = out.select("*", *[p.alias(n) for p, n in zip(parts, names)])
        keyed = out.select(*names, F.col(order).alias("_o"))
        for n in names:
            keyed = keyed.where(F.col(n).isNotNull())
        first = keyed.groupBy(*names).agg(F.min("_o").alias(f"_first{i}"))
        out = left_join_known(out, first, names).drop(*names)
        found.append(F.when(F.col(f"_first{i}") < F.col(order), F.col(f"_first{i}")))
    original = F.least(*found) if len(found) > 1 else found[0]
    out = out.withColumn("original", original).withColumn("is_duplicate", F.col("original").isNotNull())
    return out.select(*accounts.columns, "is_duplicate", "original")


def same_device_keys(mac: str = "mac", wifi: str = "wifi_mac") -> dict[str, list[Column]]:
    """Same MAC, or same valid Wi-Fi MAC."""
    return {
        "mac": [F.nullif(F.col(mac), F.lit(""))],
        "wifi": [valid_wifi_mac(wifi)],
    }


def model_device_key(
    shared_models: Sequence[str], mac: str = "mac", wifi: str = "wifi_mac", model: str = "product_model"
) -> list[tuple[Column, dict[str, Column]]]:
    """Which columns identify a device, by the state of its Wi-Fi MAC:

    no valid one -> (mac, model); a model whose MACs repeat -> (wifi, model);
    else (wifi, mac, model). Returned as (condition, key columns) in order.
    """
    valid = valid_wifi_mac(wifi)
    plain = F.nullif(F.col(mac), F.lit(""))
    return [
        (valid.isNull(), {"mac": plain, "model": F.col(model)}),
        (F.col(model).isin(list(shared_models)), {"wifi": canonical_mac(wifi), "model": F.col(model)}),
        (F.lit(True), {"wifi": canonical_mac(wifi), "mac": plain, "model": F.col(model)}),
    ]


def dedup_by_model(
    accounts: DataFrame,
    shared_models: Sequence[str],
    order: str = "id",
    mac: str = "mac",
    wifi: str = "wifi_mac",
    model: str = "product_model",
    only_listed: bool = False,
) -> DataFrame:
    """Mark duplicates by the per-model device key.

    Each account is looked up under the one key its own state selects, among
    all earlier accounts. With ``only_listed`` accounts of other models are
    never duplicates.
    """
    out = accounts
    result: Column | None = None
    for i, (condition, parts) in enumerate(model_device_key(shared_models, mac, wifi, model)):
        names = [f"_m{i}_{n}" for n in parts]
        out = out.select("*", *[e.alias(n) for e, n in zip(parts.values(), names)])
        keyed = out.select(*names, F.col(order).alias("_o"))
        for n in names:
            keyed = keyed.where(F.col(n).isNotNull())
        first = keyed.groupBy(*names).agg(F.min("_o").alias(f"_first{i}"))
        out = left_join_known(out, first, names).drop(*names)
        hit = F.when(F.col(f"_first{i}") < F.col(order), F.col(f"_first{i}"))
        applies = F.coalesce(condition, F.lit(False))
        result = F.when(applies, hit) if result is None else result.when(applies, hit)
    if only_listed:
        result = F.when(F.col(model).isin(list(shared_models)), result)
    out = out.withColumn("original", result).withColumn("is_duplicate", F.col("original").isNotNull())
    return out.select(*accounts.columns, "is_duplicate", "original")


def unmatched_logins(
    logins: DataFrame,
    accounts: DataFrame,
    models: Sequence[str],
    before: Column,
    user: str = "userId",
    mac: str = "mac",
    wifi: str = "wifiMac",
    model: str = "productModel",
) -> DataFrame:
    """Logins without a user id on listed models that match no account opened
    up to ``before``: by (mac, model), or with a valid Wi-Fi MAC by
    (wifi, mac, model)."""
    anonymous = (
        logins.where((F.col(user).isNull() | (F.col(user) == "")) & F.col(model).isin(list(models)))
        .select(user, mac, wifi, model)
        .distinct()
        .withColumn("_w", valid_wifi_mac(wifi))
    )
    older = accounts.where(F.col("openTime") <= before).select(
        F.col("mac").alias("_m"), F.col("product_model").alias("_p"), canonical_mac("wifi_mac").alias("_aw")
    )
    plain = anonymous.where(F.col("_w").isNull())
    wired = anonymous.where(F.col("_w").isNotNull())
    by_mac = older.select("_m", "_p").distinct()
    by_wifi = older.distinct()
    a = plain.join(by_mac, (plain[mac] == by_mac["_m"]) & (plain[model] == by_mac["_p"]), "left_anti")
    b = wired.join(
        by_wifi,
        (wired["_w"] == by_wifi["_aw"]) & (wired[mac] == by_wifi["_m"]) & (wired[model] == by_wifi["_p"]),
        "left_anti",
    )
    return a.unionByName(b).drop("_w")
