"""Accounts taken over one after another: each is compared with those kept so far."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import valid_wifi_mac
from ..session import ensure_checkpoint_dir
from .identity import model_device_key

Rule = tuple[Column, Sequence[Column]]


def device_rules(mac: str = "mac", wifi: str = "wifi_mac") -> list[Rule]:
    """Same MAC, or same valid Wi-Fi MAC."""
    return [(F.lit(True), [F.nullif(F.col(mac), F.lit(""))]), (F.lit(True), [valid_wifi_mac(wifi)])]


def model_rules(
    shared_models: Sequence[str], mac: str = "mac", wifi: str = "wifi_mac", model: str = "product_model", only_listed: bool = False
) -> list[Rule]:
    """The one key that an account's Wi-Fi MAC and model select; with ``only_listed`` other models look up nothing."""
    listed = F.coalesce(F.col(model).isin(list(shared_models)), F.lit(False)) if only_listed else F.lit(True)
    rules, earlier = [], F.lit(False)
    for condition, parts in model_device_key(shared_models, mac, wifi, model):
        applies = F.coalesce(condition, F.lit(False))
        rules.append((applies & ~earlier & listed, list(parts.values())))
        earlier = earlier | applies
    return rules


def sequential_dedup(accounts: DataFrame, rules: Sequence[Rule], order: str = "id") -> DataFrame:
    """Mark accounts that match an account kept before them, in the order of ``order``.

    A rule is (condition, key parts). An account looks up the keys of the rules
    whose condition it meets, and is a duplicate if an earlier account that was
    itself kept has an equal key of that rule, whatever that one's conditions.
    Keys with a null part match nothing. Adds ``is_duplicate`` and ``original``,
    the smallest such account. ``order`` is unique and not null; rows that
    repeat a value of it are one account.

    Decided in rounds instead of row by row. In each round an account is kept
    when it is the first undecided one under all keys it looks up and no kept
    one precedes it there; it is a duplicate as soon as a kept one does. The
    first undecided account of all is always decided, and a key that very many
    accounts share is settled together with its first account. The number of
    rounds is the longest chain of accounts that wait for one another, not the
    number of accounts under a key. Each round reads only what is still open,
    and its result is a reliable checkpoint.
    """
    ensure_checkpoint_dir(accounts.sparkSession)
    entries = []
    for number, (condition, parts) in enumerate(rules):
        texts = [p.cast("string") for p in parts]
        complete = ~F.greatest(*[t.isNull() for t in texts], F.lit(False))
        entries.append(F.when(complete, F.struct(F.array(F.lit(str(number)), *texts).alias("key"), F.coalesce(condition, F.lit(False)).alias("looks"))))
    keyed = accounts.select(F.col(order).alias("id"), F.filter(F.array(*entries), lambda e: e.isNotNull()).alias("keys")).where("id IS NOT NULL")
    # accounts that look nothing up are kept at once and only offer their keys
    searching = F.exists("keys", lambda e: e["looks"])
    listed = lambda df: df.select("id", F.explode("keys").alias("e")).select("id", "e.key", "e.looks").distinct()
    owners = listed(keyed.where(~searching)).groupBy("key").agg(F.min("id").alias("owner"))
    waiting = listed(keyed.where(searching)).checkpoint()
    owners, duplicates = owners.checkpoint(), None
    while not waiting.isEmpty():
        first = waiting.groupBy("key").agg(F.min("id").alias("first"))
        seen = waiting.where("looks").join(first, "key").join(owners, "key", "left")
        decided = seen.groupBy("id").agg(
            F.max(F.coalesce(F.col("owner") < F.col("id"), F.lit(False))).alias("duplicate"), F.min(F.col("first") >= F.col("id")).alias("leads")
        )
        decided = decided.where("duplicate OR leads").checkpoint()
        kept = waiting.join(decided.where("NOT duplicate"), "id", "left_semi").select("key", F.col("id").alias("owner"))
        owners = owners.unionAll(kept).groupBy("key").agg(F.min("owner").alias("owner")).checkpoint()
        gone = decided.where("duplicate").select("id")
        duplicates = gone if duplicates is None else duplicates.unionAll(gone)
        waiting = waiting.join(decided, "id", "left_anti").checkpoint()
    if duplicates is None:
        return accounts.withColumns({"is_duplicate": F.lit(False), "original": F.lit(None).cast(accounts.schema[order].dataType)})
    looked = listed(keyed.join(duplicates, "id", "left_semi")).where("looks").join(owners, "key").where("owner < id")
    found = looked.groupBy(F.col("id").alias("_id")).agg(F.min("owner").alias("original"))
    marked = accounts.join(found, F.col(order) == F.col("_id"), "left")
    return marked.select(*accounts.columns, F.col("original").isNotNull().alias("is_duplicate"), "original")


