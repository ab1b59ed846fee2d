"""Text columns as numpy arrays, in chunks of bounded size.

Spark splits the rows and hands a task Arrow batches of bounded size
(``session.bound_batches``). Inside a task a batch of texts is cut into chunks of
whole texts and each chunk is worked on with array operations. A chunk holds
at most ``CHUNK_BYTES`` bytes unless a single text is longer, so the memory of a
task depends on its longest text, not on its number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtally.session import bound_batches

CHUNK_BYTES = 1 << 20
CHUNK_DOCS = 1000

#: Bytes of words: digits, letters and everything outside ASCII.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[ord("0") : ord("9") + 1] = True
WORD_BYTES[ord("A") : ord("Z") + 1] = True
WORD_BYTES[ord("a") : ord("z") + 1] = True
WORD_BYTES[128:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES, max_docs: int = CHUNK_DOCS):
    """Yield (first row, end row, bytes, offsets) of consecutive rows; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64, len(column) + 1 + column.offset)[column.offset :]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + max_bytes, "right")) - 1
        high = min(max(high, low + 1), low + max_docs, len(column))
        yield low, high, raw[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def map_text(
    df: DataFrame,
    text: str,
    results: T.StructType,
    worker: Callable[[], Callable[..., Sequence]],
    *,
    keep: Sequence[str] | None = None,
    inputs: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Append the columns ``results`` that a function of whole texts gives.

    ``worker()`` is called once in each task and returns ``f(bytes, offsets,
    **inputs)``, which returns one array per result column. ``keep`` names the
    columns to carry along (all by default). A kept column whose name, without
    regard to case, is that of a result gives way to the result.
    """
    bound_batches(df.sparkSession)
    inputs = dict(inputs or {})
    names = list(inputs)
    taken = {f.name.lower() for f in results}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    n = len(kept)
    source = df.select(
        *[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)],
        *[c.alias(f"i{i}") for i, c in enumerate(inputs.values())],
        F.col(quoted(text)).cast("string").alias("t"),
    )
    carried = source.schema.fields[:n]
    schema = T.StructType([*carried, *[T.StructField(f"r{i}", f.dataType) for i, f in enumerate(results)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        f, arrow = worker(), to_arrow_schema(schema)
        for batch in batches:
            *columns, texts = batch.columns
            for low, high, raw, offsets in text_chunks(texts):
                extra = {k: columns[n + i].slice(low, high - low) for i, k in enumerate(names)}
                got = f(raw, offsets, **extra)
                yield pa.RecordBatch.from_arrays(
                    [c.slice(low, high - low) for c in columns[:n]]
                    + [pa.array(x, arrow.field(n + i).type) for i, x in enumerate(got)],
                    names=schema.names,
                )

    return source.mapInArrow(run, schema).toDF(*kept, *[f.name for f in results])


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), _BASE if kind == "up" else _BASE_INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps)
    return _powers[kind][:n]


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit number for each span of bytes; equal spans have equal numbers.

    Polynomial hash from running sums, so that the cost is one pass over the
    bytes plus one step for each span, however the spans lie.
    """
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _power("up", len(raw)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power("down", len(raw) + 1)[starts] + (ends - starts).astype(np.uint64))


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each run of word bytes; a run ends with its text."""
    inside = WORD_BYTES[raw]
    joined = np.zeros(len(raw) + 1, bool)  # a word goes on from the byte before
    joined[1:-1] = inside[1:] & inside[:-1]
    joined[offsets] = False
    starts = np.flatnonzero(inside & ~joined[:-1])
    ends = np.flatnonzero(inside & ~joined[1:]) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i+1]] for each i, empty ones too."""
    sums = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def gather(blob: np.ndarray, starts: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``ids`` of ``blob`` one after another, and where each begins (one end more)."""
    sizes = lengths[ids]
    ends = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    return blob[np.repeat(starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])], ends
