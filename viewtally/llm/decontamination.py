"""Benchmark passages in documents: found, and removed as spans or documents.

Words are runs of digits, letters and characters outside ASCII, with A-Z in
lower case. A window is ``width`` consecutive words of a benchmark item; an item
with fewer words, but not none, is one window. Documents are scanned once
against a broadcast set of window hashes; a hit counts after its words have been
compared. A word inside any occurrence of a window is hit.

The broadcast holds about ``block_bytes`` of benchmark text and its windows, 20
bytes each. A larger benchmark is cut into blocks of that size by a hash of the
items. Each is gathered, scanned and its hits kept in the shared folder before
the next one, so the driver and a worker hold one block at a time; the hits of
all blocks add up, so nothing depends on their number.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtally.llm.components import saved
from viewtally.llm.textarrays import LOWER, map_text, mix, quoted, span_hashes, text_chunks, words

WIDTH = 10
BLOCK_BYTES = 32 << 20
_SIEVE_BITS = 20
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
RESULTS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("hit_spans", SPANS),
    ]
)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A number for each ``size`` consecutive words."""
    n = max(len(hashes) - size + 1, 0)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * _STEP + hashes[k : k + n]
    return mix(total)


class Windows:
    """The windows of some benchmark items: for each size the sorted hashes with the place of their words and their item.

    The words of all items lie in one byte string, once, so a window takes 20
    bytes beside its text. ``sieves`` answer most documents' windows at once.
    """

    def __init__(self, items: Sequence[tuple[str, str]], width: int):
        self.items = sorted({x[0] for x in items})
        number = {x: i for i, x in enumerate(self.items)}
        names = np.array([number[x[0]] for x in items], np.int32)
        pieces, filled = [], 0
        found: dict[int, list[tuple[np.ndarray, ...]]] = defaultdict(list)
        for low, _, raw, offsets in text_chunks(pa.array([x[1] for x in items], pa.string())):
            raw = LOWER[raw]
            starts, ends, rows = words(raw, offsets)
            hashes, data = span_hashes(raw, starts, ends), raw.tobytes()
            pieces.append(b" ".join(data[i:j] for i, j in zip(starts.tolist(), ends.tolist(), strict=True)))
            last = filled + np.cumsum(ends - starts + 1) - 1
            first = last - (ends - starts)
            filled += len(pieces[-1]) + 1
            counts = np.bincount(rows, minlength=len(offsets) - 1)
            for size in np.unique(np.minimum(counts[counts > 0], width)).tolist():
                wanted = window_hashes(hashes, size)
                at = np.flatnonzero(rows[: len(wanted)] == rows[size - 1 :][: len(wanted)])
                at = at[np.minimum(counts[rows[at]], width) == size]
                found[size].append((wanted[at], first[at], last[at + size - 1], names[low + rows[at]]))
        self.text = b" ".join(pieces)
        self.tables = {size: self._table([np.concatenate(x) for x in zip(*parts, strict=True)]) for size, parts in sorted(found.items())}
        self.sieves = {}
        for size, (hashes, *_) in self.tables.items():
            self.sieves[size] = np.zeros(1 << _SIEVE_BITS, bool)
            self.sieves[size][hashes & np.uint64((1 << _SIEVE_BITS) - 1)] = True

    def _table(self, columns: list[np.ndarray]) -> list[np.ndarray]:
        """Hashes in order, begin, end and item of their words; a window that an item repeats is there once."""
        hashes, starts, ends, owners = columns
        order = np.lexsort((owners, hashes))
        hashes, starts, ends, owners = hashes[order], starts[order], ends[order], owners[order]
        kept = np.ones(len(hashes), bool)
        for i in (np.flatnonzero((hashes[1:] == hashes[:-1]) & (owners[1:] == owners[:-1])) + 1).tolist():
            kept[i] = self.text[starts[i] : ends[i]] != self.text[starts[i - 1] : ends[i - 1]]
        return [hashes[kept], starts[kept].astype(np.uint32), ends[kept].astype(np.uint32), owners[kept]]

    def scan(self, raw: np.ndarray, offsets: np.ndarray, hit: np.ndarray | None, found: list[set[str]]):
        """Mark the words of occurrences in ``hit`` and add the items to ``found``; returns the words and ``hit``."""
        raw = LOWER[raw]
        starts, ends, rows = words(raw, offsets)
        hashes, data = span_hashes(raw, starts, ends), None
        hit = np.zeros(len(starts), bool) if hit is None else hit
        for size, (known, begins, stops, owners) in self.tables.items():
            wanted = window_hashes(hashes, size)
            at = np.flatnonzero(self.sieves[size][wanted & np.uint64((1 << _SIEVE_BITS) - 1)])
            low, high = np.searchsorted(known, wanted[at]), np.searchsorted(known, wanted[at], "right")
            near = (low < high) & (rows[at] == rows[at + size - 1])
            for i, a, b in zip(at[near].tolist(), low[near].tolist(), high[near].tolist(), strict=True):
                data = data or raw.tobytes()
                text = b" ".join(data[starts[j] : ends[j]] for j in range(i, i + size))
                same = [k for k in range(a, b) if self.text[begins[k] : stops[k]] == text]
                if same:
                    hit[i : i + size] = True
                    found[rows[i]].update(self.items[owners[k]] for k in same)
        return starts, ends, rows, hit


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Append ``n_words``, ``n_hit``, ``item_ids`` and ``hit_spans`` to each document.

    ``item_ids`` are the items with occurring windows, as strings in order;
    ``hit_spans`` are the runs of hit words, in code points of the text. Null
    and empty texts have no words. Items without id or text are not used; items
    of one id add up. Repeated rows get equal results.
    """
    keep = list(docs.columns if keep is None else keep)
    items = benchmark.select(
        F.col(quoted(item_id)).cast("string").alias("i"), F.col(quoted(item_text)).cast("string").alias("t")
    ).where("i IS NOT NULL AND t IS NOT NULL")
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // block_bytes))
    carried = [f"c{i}" for i in range(len(keep))]
    out = docs.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(keep)], F.col(quoted(text)).cast("string").alias("t"))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block).collect()
        shared = docs.sparkSession.sparkContext.broadcast(Windows([(r["i"], r["t"]) for r in rows], width))
        last = block == blocks - 1
        inputs = {"before": F.struct("n_words", "n_hit", "item_ids", "hit_spans")} if block else {}
        out = map_text(out, "t", RESULTS, _scanner(shared), keep=carried + ([] if last else ["t"]), inputs=inputs)
        if not last:
            out = saved(out)
            shared.destroy()
    names = {f.name.lower() for f in RESULTS}
    return out.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep) if c.lower() not in names], *[f.name for f in RESULTS]
    )


def _scanner(shared):
    """The scan of one broadcast block, on top of the results of the blocks before."""

    def worker():
        windows = shared.value

        def scan(raw, offsets, before=None):
            found = [set() for _ in offsets[1:]]
            hit = None
            if before is not None:
                hit = _marked(raw, offsets, before)
                for row, x in zip(found, before.to_pylist(), strict=True):
                    row.update(x["item_ids"])
            starts, ends, rows, hit = windows.scan(raw, offsets, hit, found)
            return _results(raw, offsets, starts, ends, rows, hit, found)

        return scan

    return worker


def _results(raw, offsets, starts, ends, rows, hit, found):
    n = len(offsets) - 1
    spans: list[list[dict]] = [[] for _ in range(n)]
    if hit.any():
        heads = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((raw & 0xC0) != 0x80, out=heads[1:])
        goes_on = hit[1:] & hit[:-1] & (rows[1:] == rows[:-1])
        first = np.flatnonzero(hit & ~np.append(False, goes_on))
        last = np.flatnonzero(hit & ~np.append(goes_on, False))
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            base = heads[offsets[rows[a]]]
            spans[rows[a]].append({"start": int(heads[starts[a]] - base), "end": int(heads[ends[b]] - base)})
    return [np.bincount(rows, minlength=n), np.bincount(rows[hit], minlength=n), [sorted(x) for x in found], spans]


def _marked(raw, offsets, before) -> np.ndarray:
    """The words that earlier blocks have hit."""
    starts, _, rows = words(raw, offsets)
    heads = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=heads[1:])
    place = heads[starts] - heads[offsets[rows]]
    hit = np.zeros(len(starts), bool)
    for row, x in enumerate(before.to_pylist()):
        for span in x["hit_spans"]:
            hit |= (rows == row) & (place >= span["start"]) & (place < span["end"])
    return hit


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, spans: bool = False, text: str = "text", **options) -> DataFrame:
    """Documents without benchmark passages, with the columns they came with.

    Contaminated documents go; with ``spans`` they stay and lose the hit words
    and what stands between them.
    """
    names = [f"k{i}" for i in range(len(docs.columns))]
    own = names[docs.columns.index(text)]
    found = find_contamination(docs.toDF(*names), benchmark, text=own, **options)
    if not spans:
        return found.where("n_hit = 0").select(*names).toDF(*docs.columns)
    whole = F.col(own).cast("string")
    cut = F.aggregate(
        "hit_spans",
        F.struct(F.lit("").alias("kept"), F.lit(0).alias("at")),
        lambda acc, x: F.struct(
            F.concat(acc["kept"], F.substring(whole, acc["at"] + 1, x["start"] - acc["at"])).alias("kept"), x["end"].alias("at")
        ),
        lambda acc: F.concat(acc["kept"], F.substring(whole, acc["at"] + 1, F.length(whole))),
    )
    cut = F.when(F.col("n_hit") > 0, cut).otherwise(F.col(own))
    return found.select(*[cut.alias(c) if c == own else F.col(c) for c in names]).toDF(*docs.columns)
