"""Byte-level BPE encoding and decoding with a given vocabulary of ranks.

Texts are cut into pre-tokens by classes of characters. Tier one looks every
pre-token up as a whole in a minimal perfect hash over the vocabulary, for a
chunk of texts at once. Tier two merges the bytes of a pre-token that is no
token itself: a heap holds the ranks of neighbouring pairs over a linked list of
parts. Its results are kept for the most recent pre-tokens of the worker.

The vocabulary is broadcast; its size is that of the rank file (some 50,000
short tokens), whatever the corpus.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtally.llm.perfect_hash import PerfectHash
from viewtally.llm.textarrays import gather, map_text, quoted, span_hashes

#: Pre-tokens whose merges a worker remembers.
REMEMBERED = 200_000

#: White_Space of Unicode, the ``\s`` of the pre-token pattern.
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
#: What the pre-token pattern takes after an apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

#: Letters and numbers of Unicode 16.0, which the unicodedata of some Pythons does not know yet.
LATE_LETTERS = (
    "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B-1138B 1138E-1138E 11390-113B5 "
    "113B7-113B7 113D1-113D1 113D3-113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF-18CFF 1E5D0-1E5ED 1E5F0-1E5F0"
)
LATE_NUMBERS = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3

NO_RANK = -1
_PLACE_BITS = 31
_PLACES = (1 << _PLACE_BITS) - 1


@dataclass
class Vocabulary:
    """Token bytes by rank, with a perfect hash from bytes to rank."""

    blob: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    hashed: PerfectHash
    ranks: np.ndarray  # by slot
    classes: np.ndarray  # by code point
    _merges: dict[int, int] = field(default_factory=dict)
    _singles: list[int] = field(default_factory=list)
    _known: dict[bytes, tuple[int, ...]] = field(default_factory=dict)

    @property
    def size(self) -> int:
        return len(self.starts)

    def whole(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The rank of each span that is a token, else -1."""
        ranks = self.ranks[self.hashed.slots(hashes)]
        same = self.lengths[ranks] == ends - starts
        out = np.full(len(starts), -1, np.int64)
        at = np.flatnonzero(same)
        sizes = (ends - starts)[at]
        offsets = np.zeros(len(at) + 1, np.int64)
        np.cumsum(sizes, out=offsets[1:])
        step = np.arange(offsets[-1])
        equal = raw[step + np.repeat(starts[at] - offsets[:-1], sizes)] == self.blob[step + np.repeat(self.starts[ranks[at]] - offsets[:-1], sizes)]
        wrong = np.zeros(offsets[-1] + 1, np.int64)
        np.cumsum(~equal, out=wrong[1:])
        right = wrong[offsets[1:]] == wrong[offsets[:-1]]
        out[at[right]] = ranks[at[right]]
        return out

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """The ranks that merging leaves of a pre-token; the lowest pair first, the leftmost among equals."""
        got = self._known.get(piece)
        if got is not None:
            return got
        if not self._merges:
            self._prepare()
        merges, singles, size, n = self._merges.get, self._singles, self.size, len(piece)
        ids = [singles[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [merges(a * size + b, NO_RANK) for a, b in zip(ids, ids[1:])]  # of each part and the next one
        pair.append(NO_RANK)
        heap = [r << _PLACE_BITS | i for i, r in enumerate(pair) if r != NO_RANK]
        heapify(heap)
        while heap:
            low = heappop(heap)
            rank, i = low >> _PLACE_BITS, low & _PLACES
            if pair[i] != rank:
                continue  # one of the two has been merged since
            j = after[i]
            k = after[i] = after[j]
            ids[i], pair[i], pair[j] = rank, NO_RANK, NO_RANK
            if k < n:
                before[k] = i
                r = merges(rank * size + ids[k])
                if r is not None:
                    pair[i] = r
                    heappush(heap, r << _PLACE_BITS | i)
            h = before[i]
            if h >= 0:
                r = pair[h] = merges(ids[h] * size + rank, NO_RANK)
                if r != NO_RANK:
                    heappush(heap, r << _PLACE_BITS | h)
        left, i = [], 0
        while i < n:
            left.append(ids[i])
            i = after[i]
        if len(self._known) >= REMEMBERED:
            self._known.clear()
        got = self._known[piece] = tuple(left)
        return got

    def _prepare(self) -> None:
        """For two neighbouring ranks the rank of their joined bytes."""
        blob = self.blob.tobytes()
        tokens = [blob[s : s + n] for s, n in zip(self.starts.tolist(), self.lengths.tolist(), strict=True)]
        ranks = {t: i for i, t in enumerate(tokens)}
        self._singles = [ranks[bytes([b])] for b in range(256)]
        for rank, token in enumerate(tokens):
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self._merges[left * len(tokens) + right] = rank

    def __getstate__(self):
        return self.__dict__ | {"_merges": {}, "_singles": [], "_known": {}}


def load_vocabulary(path: str) -> Vocabulary:
    """Read a rank file (base64 token and rank in each line; ranks 0, 1, 2, ...)."""
    with open(path, "rb") as lines:
        rows = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines))
    if [r for r, _ in rows] != list(range(len(rows))) or {bytes([b]) for b in range(256)} - {t for _, t in rows}:
        raise ValueError("ranks have gaps, or a single byte has none")
    blob = np.frombuffer(b"".join(t for _, t in rows), np.uint8)
    lengths = np.array([len(t) for _, t in rows], np.int64)
    starts = np.cumsum(lengths) - lengths
    hashes = span_hashes(blob, starts, starts + lengths)
    hashed = PerfectHash(hashes)
    ranks = np.empty(len(rows), np.int64)
    ranks[hashed.slots(hashes)] = np.arange(len(rows))
    return Vocabulary(blob, starts, lengths, hashed, ranks, character_classes())


def character_classes() -> np.ndarray:
    """Letter, number, white space or other, by code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    classes = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8)
    for kind, ranges in ((LETTER, LATE_LETTERS), (NUMBER, LATE_NUMBERS)):
        for low, high in (r.split("-") for r in ranges.split()):
            classes[int(low, 16) : int(high, 16) + 1] = kind
    classes[list(WHITE_SPACE)] = SPACE
    return classes


def pre_tokens(points: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where the pre-tokens begin: runs of one class, with these exceptions.

    A space right before a run of another class belongs to that run; what is
    left of white space before it stands alone. An apostrophe at the beginning
    of a run takes a contraction's letters with it.
    """
    n = len(points)
    kind = classes[points]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    first = first[:-1]
    new = first.copy()
    new[1:] |= kind[1:] != kind[:-1]
    white = kind == SPACE
    # the last of some white space before a run of another class
    last = np.zeros(n, bool)
    last[:-1] = white[:-1] & ~white[1:] & ~first[1:]
    begin = new | last
    after_space = np.zeros(n, bool)
    after_space[1:] = last[:-1] & (points[:-1] == 32)
    begin &= ~after_space
    marks = np.flatnonzero((points == 39) & begin)
    if len(marks):
        begin = _contractions(points, begin, first, marks)
    return np.flatnonzero(begin)


def _contractions(points: np.ndarray, begin: np.ndarray, first: np.ndarray, marks: np.ndarray) -> np.ndarray:
    padded = np.concatenate([points, np.zeros(2, points.dtype)])
    barrier = np.concatenate([first, np.ones(2, bool)])
    letters = [[ord(c) for c in x] for x in CONTRACTIONS]
    size = np.zeros(len(marks), np.int64)
    for word in letters:
        fits = size == 0
        for k, c in enumerate(word, 1):
            fits &= (padded[marks + k] == c) & ~barrier[marks + k]
        size[fits] = len(word)
    hit, size = marks[size > 0], size[size > 0]
    begin = np.concatenate([begin, [True]])
    begin[hit + 1] = False  # the letters stay with the apostrophe
    begin[hit + size + 1] = True
    return begin[:-1]


def encode_chunk(raw: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ranks of all texts of a chunk, and where each text's begin (one end more)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    heads = np.flatnonzero((raw & 0xC0) != 0x80)  # first byte of each character
    starts = heads[pre_tokens(points, np.searchsorted(heads, offsets), vocabulary.classes)]
    ends = np.append(starts[1:], len(raw))
    hashes = span_hashes(raw, starts, ends)
    ranks = vocabulary.whole(raw, starts, ends, hashes)
    missing = np.flatnonzero(ranks < 0)
    sizes = np.ones(len(starts), np.int64)
    if not len(missing):
        return ranks, np.searchsorted(starts, offsets)
    data = raw.tobytes()
    pieces = [data[a:b] for a, b in zip(starts[missing].tolist(), ends[missing].tolist(), strict=True)]
    place = {p: i for i, p in enumerate(set(pieces))}
    parts = [vocabulary.merged(p) for p in place]
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    which = np.fromiter(map(place.__getitem__, pieces), np.int64, len(pieces))
    flat = np.fromiter(chain.from_iterable(parts), np.int64, int(counts.sum()))
    sizes[missing] = counts[which]
    begins = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=begins[1:])
    out = np.repeat(ranks, sizes)
    out[out < 0] = gather(flat, np.cumsum(counts) - counts, counts, which)[0]
    return out, begins[np.searchsorted(starts, offsets)]


def decimal_names(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers 0..n-1 written one after another, each followed by a space: bytes, starts, lengths."""
    names = [b"%d " % i for i in range(n)]
    lengths = np.array([len(x) for x in names], np.int64)
    return np.frombuffer(b"".join(names), np.uint8), np.cumsum(lengths) - lengths, lengths


DIGESTS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def _over_ids(df: DataFrame, text: str, results: T.StructType, make, keep) -> DataFrame:
    """``make(vocabulary)`` returns f(ids, begins), which returns the result columns."""

    def with_vocabulary(vocabulary):
        shared = df.sparkSession.sparkContext.broadcast(vocabulary)

        def worker():
            words = shared.value
            f = make(words)
            return lambda raw, offsets: f(*encode_chunk(raw, offsets, words))

        return map_text(df, text, results, worker, keep=keep)

    return with_vocabulary


def encode(df: DataFrame, vocabulary: Vocabulary, *, text: str = "text", ids: str = "token_ids", keep: Sequence[str] | None = None) -> DataFrame:
    """Append the ranks of each whole text as array<int>; null and empty texts give an empty array."""
    results = T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def make(_):
        return lambda got, begins: [pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(got, pa.int32()))]

    return _over_ids(df, text, results, make, keep)(vocabulary)


def count_tokens(df: DataFrame, vocabulary: Vocabulary, *, text: str = "text", n: str = "n_tokens", keep: Sequence[str] | None = None) -> DataFrame:
    """Append the number of tokens of each whole text; null and empty texts have none."""
    results = T.StructType([T.StructField(n, T.LongType())])
    return _over_ids(df, text, results, lambda _: lambda got, begins: [np.diff(begins)], keep)(vocabulary)


def decode(df: DataFrame, vocabulary: Vocabulary, *, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """Append the text of each array of ranks; a null array gives null.

    Bytes that are no UTF-8 (of ranks that were not made from a text) become the
    replacement character; a rank outside the vocabulary is an error.
    """
    kept = [c for c in df.columns if c.lower() != text.lower()]
    source = df.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)], F.col(quoted(ids)).cast("array<int>").alias("ids"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("t", T.StringType())])
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            texts = []
            for row in batch.column(len(kept)):
                if not row.is_valid:
                    texts.append(None)
                    continue
                got = row.values.to_numpy(zero_copy_only=False).astype(np.int64)
                if len(got) and not 0 <= got.min() <= got.max() < words.size:
                    raise ValueError("a rank is outside the vocabulary")
                texts.append(gather(words.blob, words.starts, words.lengths, got)[0].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(texts, pa.string())], names=schema.names)

    return source.mapInArrow(run, schema).toDF(*kept, text)


def round_trip_digests(df: DataFrame, vocabulary: Vocabulary, *, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of each whole text.

    The ranks are decoded again, and the second digest is of those bytes. Null
    and empty texts have no tokens and the digests of no bytes.
    """

    def make(words):
        names = decimal_names(words.size)

        def digests(got, begins):
            written, at = gather(*names, got)
            decoded, by = gather(words.blob, words.starts, words.lengths, got)
            written, decoded = written.tobytes(), decoded.tobytes()
            spans = list(zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True))
            at, by = at.tolist(), by.tolist()
            return [
                np.diff(begins),
                [hashlib.sha256(written[at[a] : max(at[b] - 1, at[a])]).hexdigest() for a, b in spans],
                [hashlib.sha256(decoded[by[a] : by[b]]).hexdigest() for a, b in spans],
            ]

        return digests

    return _over_ids(df, text, DIGESTS, make, keep)(vocabulary)
