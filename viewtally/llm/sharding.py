"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has its own order of the slots of a prime-sized table: it starts at
an offset and goes on in steps, both from its name. The shards take turns, each
claiming its next slot that is still free, until the table is full. A key is
hashed to a slot, so its shard is found by one lookup; when a shard leaves, few
keys of the others move.

The table has ``size`` slots whatever the number of rows (at most ``MAX_SLOTS``)
and is broadcast. Rows are placed with DataFrame functions only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtally.llm.textarrays import quoted

SLOTS = 65_537
MAX_SLOTS = 1_000_003


def lookup_table(shards: Sequence[str], size: int = SLOTS) -> list[int]:
    """The number of the shard of each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be named, each once")
    if not len(shards) <= size <= MAX_SLOTS or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError("the size must be a prime, no less than the shards and no more than MAX_SLOTS")
    digests = [hashlib.md5(name.encode()).digest() for name in shards]
    at = [int.from_bytes(d[:8], "big") % size for d in digests]
    step = [int.from_bytes(d[8:], "big") % (size - 1) + 1 for d in digests]
    table, free = [-1] * size, size
    while free:
        for shard in range(len(shards)):
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % size
            table[at[shard]] = shard
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, size: int = SLOTS) -> Column:
    """The slot of a key: the first eight digits of the md5 of its text; null counts as empty."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 8)
    return (F.conv(digits, 16, 10).cast("long") % size).cast("int")


def place(df: DataFrame, shards: Sequence[str], *, key: str = "doc_id", size: int = SLOTS, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """Append the slot and the shard of each row; columns of these names, without regard to case, give way.

    Rows of one key share a shard, repeated rows too. A key that a third of the
    rows share therefore fills one shard: take a finer key (an id) where that
    matters.
    """
    if slot.lower() == shard.lower():
        raise ValueError("slot and shard need two names")
    kept = [c for c in df.columns if c.lower() not in (slot.lower(), shard.lower())]
    names = F.array(*[F.lit(s) for s in shards])
    numbers = F.split(F.lit(",".join(map(str, lookup_table(shards, size)))), ",")
    table = (
        df.sparkSession.range(1).select(F.posexplode(numbers).alias("slot", "number"))
        .select("slot", F.element_at(names, F.col("number").cast("int") + 1).alias("shard"))
    )
    rows = df.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)], slot_of(F.col(quoted(key)), size).alias("slot"))
    placed = rows.join(F.broadcast(table), "slot")
    return placed.select(*[f"c{i}" for i in range(len(kept))], "slot", "shard").toDF(*kept, slot, shard)
