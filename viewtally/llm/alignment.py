"""Alignment of the tokens that two tokenizers make of one text.

Both token sequences cover the same bytes, so each is an incidence matrix of
tokens and bytes in compressed sparse rows (CSR). Gustavson's row products
A · Bᵀ have an entry for every pair of tokens that share bytes: the overlap
links. Offsets where tokens of both end cut the text into groups; the product of
the two token and group incidences has an entry for every pair inside a group:
the shared-group links.

Tokenizers run once for each text, one chunk of whole texts at a time. What a
document links (distinct id pairs and how often) goes to a table in the shared
folder, because how many documents hold a pair is known only after the last one.
The most frequent pairs, at most ``HEAD_PAIRS``, are then looked up in a
broadcast array; the others are joined, and each of those has fewer documents
than any pair of the array, so no key of that join is hot.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtally.llm.components import saved
from viewtally.llm.textarrays import gather, map_text, quoted
from viewtally.session import ensure_checkpoint_dir

#: Id pairs that are looked up in a broadcast array, 17 bytes each.
HEAD_PAIRS = 1 << 20
#: Entries of a product that are held at once.
PRODUCT_ENTRIES = 1 << 21


@dataclass
class Csr:
    """Rows of column numbers; ``values`` counts how often an entry was added."""

    starts: np.ndarray
    columns: np.ndarray
    width: int
    values: np.ndarray | None = None

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    def rows(self, low: int, high: int) -> Csr:
        a, b = self.starts[low], self.starts[high]
        return Csr(self.starts[low : high + 1] - a, self.columns[a:b], self.width)

    def entry_rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.starts))


def gustavson(left: Csr, right: Csr) -> Csr:
    """left · right row by row: the rows of ``right`` that a row of ``left`` names, added up."""
    sizes = np.diff(right.starts)
    columns, ends = gather(right.columns, right.starts[:-1], sizes, left.columns)
    keys = np.repeat(left.entry_rows(), np.diff(ends)) * right.width + columns
    if (keys[1:] < keys[:-1]).any():
        keys = np.sort(keys)
    new = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
    values = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    return Csr(np.searchsorted(keys, np.arange(left.height + 1) * right.width), keys % right.width, right.width, values)


def product_sizes(left: Csr, right: Csr) -> np.ndarray:
    """How many entries each row product adds up, without making them."""
    sums = np.concatenate([[0], np.cumsum(np.diff(right.starts)[left.columns])])
    return sums[left.starts[1:]] - sums[left.starts[:-1]]


def token_bytes(ends: np.ndarray, size: int) -> Csr:
    """Tokens by bytes: token i holds the bytes from the end of the one before it."""
    return Csr(np.concatenate([[0], ends]), np.arange(size), size)


def bytes_token(ends: np.ndarray, size: int) -> Csr:
    """Bytes by tokens, the transpose."""
    return Csr(np.arange(size + 1), np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)), len(ends))


def group_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Offsets where a token of each ends."""
    return np.intersect1d(a_ends, b_ends, assume_unique=True)


def token_group(ends: np.ndarray, groups: np.ndarray) -> Csr:
    """Tokens by groups, one each."""
    return Csr(np.arange(len(ends) + 1), np.searchsorted(groups, ends), len(groups))


def group_tokens(ends: np.ndarray, groups: np.ndarray) -> Csr:
    """Groups by tokens, the transpose."""
    return Csr(np.concatenate([[0], np.searchsorted(ends, groups, "right")]), np.arange(len(ends)), len(ends))


# -- the two tokenizers ------------------------------------------------------


@dataclass
class TokenTable:
    """The bytes of every id, one after another."""

    blob: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, tokens: Sequence[bytes]) -> TokenTable:
        lengths = np.array([len(t) for t in tokens], np.int64)
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths)

    def __len__(self) -> int:
        return len(self.lengths)


@dataclass
class Tokenizer:
    """``make()`` returns, once in a task, what encodes a list of texts to ids and where each text's begin; ``lead`` is put before each."""

    tokens: TokenTable
    make: Callable[[], Callable[[list[str]], tuple[np.ndarray, np.ndarray]]]
    lead: str = ""


def _byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_level_tokenizer(path: str, pattern: str) -> Tokenizer:
    """A byte-level BPE from its JSON file; merges run in their order on each match of ``pattern``.

    Ids of added tokens hold the bytes of their text and are never made: their
    text in a document is plain text.
    """
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    letters, vocabulary = _byte_letters(), parts["model"]["vocab"]
    added = {t["id"]: t["content"].encode() for t in parts.get("added_tokens", [])}
    by_id = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items() if i not in added} | added
    tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    merges = [m.split(" ") if isinstance(m, str) else m for m in parts["model"]["merges"]]
    order = [c for c in letters if c in vocabulary] + ["".join(m) for m in merges]
    place = {bytes(letters[c] for c in token): rank for rank, token in reversed(list(enumerate(order)))}
    ids = np.zeros(len(order), np.int64)
    for token, rank in place.items():
        ids[rank] = vocabulary["".join(_letter(b) for b in token)]

    def make():
        import tiktoken

        encoding = tiktoken.Encoding(f"merges-{uuid.uuid4().hex}", pat_str=pattern, mergeable_ranks=place, special_tokens={})

        def encode(texts: list[str]):
            ranks, at = _flat([encoding.encode_ordinary(t) for t in texts])
            return ids[ranks], at

        return encode

    return Tokenizer(TokenTable.of(tokens), make, lead=" ")


def _letter(byte: int, _names: dict[int, str] = {}) -> str:  # noqa: B006
    if not _names:
        _names.update({b: c for c, b in _byte_letters().items()})
    return _names[byte]


def piece_tokenizer(path: str) -> Tokenizer:
    """A sentence-piece model with byte fallback; it puts a space before a text itself."""
    import sentencepiece

    with open(path, "rb") as file:
        model = file.read()
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    tokens = []
    for i in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode())

    def make():
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        return lambda texts: _flat(processor.encode(texts, num_threads=1))

    return Tokenizer(TokenTable.of(tokens), make)


@dataclass
class Pair:
    """A chunk of texts in both tokenizers; documents whose tokens do not give the text have none."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray  # last byte of each token, one more, in the bytes of all documents with tokens
    b_ends: np.ndarray
    a_at: np.ndarray  # where each document's tokens begin (one end more)
    b_at: np.ndarray
    size: int


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    at = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=at[1:])
    return np.fromiter(chain.from_iterable(lists), np.int64, int(at[-1])), at


def _without(ids: np.ndarray, at: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(at)
    return ids[np.repeat(good, sizes)], np.concatenate([[0], np.cumsum(np.where(good, sizes, 0))])


def encode_pair(raw: np.ndarray, offsets: np.ndarray, first: Tokenizer, second: Tokenizer, encoders) -> Pair:
    data = raw.tobytes()
    bounds = offsets.tolist()
    some = np.diff(offsets) > 0
    texts = [data[a:b].decode("utf-8") for a, b in zip(bounds, bounds[1:])]  # noqa: B905
    whole = [b" " + data[a:b] if b > a else b"" for a, b in zip(bounds, bounds[1:])]  # noqa: B905
    want = np.frombuffer(b"".join(whole), np.uint8)
    sizes = np.diff(offsets) + some
    kept = [_without(*f([t.lead + x for x in texts]), some) for t, f in zip((first, second), encoders, strict=True)]
    good = some.copy()
    for t, (ids, at) in zip((first, second), kept, strict=True):
        sums = np.concatenate([[0], np.cumsum(t.tokens.lengths[ids])])
        good &= sums[at[1:]] - sums[at[:-1]] == sizes
    for t, (ids, at) in zip((first, second), kept, strict=True):
        got = gather(t.tokens.blob, t.tokens.starts, t.tokens.lengths, _without(ids, at, good)[0])[0]
        wrong = np.concatenate([[0], np.cumsum(got != want[np.repeat(good, sizes)])])
        ends = np.cumsum(np.where(good, sizes, 0))
        good = good & (wrong[ends] == wrong[ends - np.where(good, sizes, 0)])
    (a, a_at), (b, b_at) = (_without(ids, at, good) for ids, at in kept)
    return Pair(a, b, np.cumsum(first.tokens.lengths[a]), np.cumsum(second.tokens.lengths[b]), a_at, b_at, int(np.where(good, sizes, 0).sum()))


def _names(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers 0..n-1, a comma behind each: bytes, starts, lengths."""
    table = TokenTable.of([b"%d," % i for i in range(n)])
    return table.blob, table.starts, table.lengths


def written_groups(pair: Pair, groups: np.ndarray, names) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each document: the ids of both tokenizers, group by group."""
    in_a, in_b = np.searchsorted(groups, pair.a_ends), np.searchsorted(groups, pair.b_ends)
    a_place = np.arange(len(in_a)) + np.searchsorted(in_b, in_a, "left")
    b_place = np.arange(len(in_b)) + np.searchsorted(in_a, in_b, "right")
    ids = np.empty(len(in_a) + len(in_b), np.int64)
    ids[a_place], ids[b_place] = pair.a, pair.b
    text, at = gather(*names, ids)
    last = lambda x: np.flatnonzero(np.append(x[1:] != x[:-1], True)) if len(x) else np.zeros(0, np.int64)
    text[at[a_place[last(in_a)] + 1] - 1] = ord("|")
    text[at[b_place[last(in_b)] + 1] - 1] = ord(";")
    text, at = text.tobytes(), at[pair.a_at + pair.b_at].tolist()
    return [text[x : max(y - 1, x)] for x, y in zip(at, at[1:])]  # noqa: B905


def overlap_links(pair: Pair) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, shared bytes) for every overlap, in the order of the tokens."""
    product = gustavson(token_bytes(pair.a_ends, pair.size), bytes_token(pair.b_ends, pair.size))
    return product.entry_rows(), product.columns, product.values


def shared_group_links(pair: Pair, groups: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(token of A, token of B) for every pair in one group, in blocks of tokens of A."""
    left, right = token_group(pair.a_ends, groups), group_tokens(pair.b_ends, groups)
    sums = np.concatenate([[0], np.cumsum(product_sizes(left, right))])
    low = 0
    while low < left.height:
        high = max(int(np.searchsorted(sums, sums[low] + PRODUCT_ENTRIES, "right")) - 1, low + 1)
        product = gustavson(left.rows(low, high), right)
        yield product.entry_rows() + low, product.columns
        low = high


def _documents(links: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(at, links, "right") - 1


STATS = T.StructType(
    [
        *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_group_links")],
        T.StructField("groups_sha256", T.StringType()),
        *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("pair_a", "pair_b", "times")],
    ]
)


def _aligned(df: DataFrame, first: Tokenizer, second: Tokenizer, text: str, results: T.StructType, measure, keep) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast((first.tokens, second.tokens))

    def worker():
        a, b = (Tokenizer(tokens, t.make, t.lead) for tokens, t in zip(shared.value, (first_make, second_make), strict=True))
        encoders = a.make(), b.make()
        f = measure(len(a.tokens), len(b.tokens))
        return lambda raw, offsets: f(encode_pair(raw, offsets, a, b, encoders))

    # the tables travel by broadcast, only the makers with the task
    first_make, second_make = Tokenizer(None, first.make, first.lead), Tokenizer(None, second.make, second.lead)
    return map_text(df, text, results, worker, keep=keep)


def align_documents(df: DataFrame, first: Tokenizer, second: Tokenizer, *, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Append to each whole text its numbers of tokens, groups and links, a digest of its groups, and its distinct id pairs.

    ``pair_a``, ``pair_b`` and ``times`` hold the linked id pairs in order and
    how often each is linked. Texts that are null or empty, or whose tokens'
    bytes differ from space and text, have no tokens: zeros, no pairs, ''.
    """

    def measure(n_first: int, n_second: int):
        names = _names(max(n_first, n_second))

        def f(pair: Pair):
            groups = group_ends(pair.a_ends, pair.b_ends)
            a, b, _ = overlap_links(pair)
            n_a, n_b = np.diff(pair.a_at), np.diff(pair.b_at)
            documents = len(n_a)
            docs = _documents(a, pair.a_at)
            keys, times = np.unique((docs * n_first + pair.a[a]) * n_second + pair.b[b], return_counts=True)
            at = pa.array(np.searchsorted(keys, np.arange(documents + 1) * n_first * n_second), pa.int32())
            inside = product_sizes(token_group(pair.a_ends, groups), group_tokens(pair.b_ends, groups))
            digests = [hashlib.sha256(x).hexdigest() if x else "" for x in written_groups(pair, groups, names)]
            lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (keys // n_second % n_first, keys % n_second, times)]
            per_doc = lambda which, weights=None: np.bincount(which, weights, documents).astype(np.int64)
            return [
                n_a, n_b, per_doc(_documents(np.searchsorted(pair.a_ends, groups), pair.a_at)), per_doc(docs),
                per_doc(_documents(np.arange(len(pair.a)), pair.a_at), inside), digests, *lists,
            ]

        return f

    return _aligned(df, first, second, text, STATS, measure, keep)


LINKS = T.ArrayType(
    T.StructType([T.StructField(c, T.IntegerType()) for c in ("a_place", "b_place", "a_id", "b_id")]),
)


def token_links(df: DataFrame, first: Tokenizer, second: Tokenizer, *, kind: str = "overlap", text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """One row for each link of each text: ``kind`` is overlap or group; places count a document's tokens from 0."""

    def measure(_, __):
        def f(pair: Pair):
            if kind == "overlap":
                a, b, _ = overlap_links(pair)
            else:
                blocks = list(shared_group_links(pair, group_ends(pair.a_ends, pair.b_ends)))
                a, b = (np.concatenate([x[i] for x in blocks] or [np.zeros(0, np.int64)]) for i in (0, 1))
            docs = _documents(a, pair.a_at)
            columns = [a - pair.a_at[docs], b - pair.b_at[docs], pair.a[a], pair.b[b]]
            rows = pa.StructArray.from_arrays([pa.array(x, pa.int32()) for x in columns], [field.name for field in LINKS.elementType])
            at = np.searchsorted(docs, np.arange(len(pair.a_at)))
            return [pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows)]

        return f

    if kind not in ("overlap", "group"):
        raise ValueError("kind is overlap or group")
    found = _aligned(df, first, second, text, T.StructType([T.StructField("links", LINKS)]), measure, keep)
    kept = [F.col(quoted(c)) for c in found.columns[:-1]]
    return found.select(*kept, F.explode("links").alias("link")).select(*kept, "link.a_place", "link.b_place", "link.a_id", "link.b_id")


def written(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder, and read again."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pair_documents(aligned: DataFrame) -> DataFrame:
    """(a, b, docs, best): documents that link an id pair, and whether no pair of its A id has more."""
    pairs = aligned.select(F.explode(F.arrays_zip("pair_a", "pair_b")).alias("p")).groupBy(F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"))
    counted = saved(pairs.agg(F.count("*").alias("docs")))
    most = counted.groupBy("a").agg(F.max("docs").alias("most"))
    return counted.join(most, "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))


def _head_floor(pairs: DataFrame, limit: int) -> int:
    """The smallest power of two such that at most ``limit`` pairs have as many documents."""
    sizes = pairs.groupBy(F.floor(F.log2("docs")).cast("int").alias("power")).count().collect()  # 64 rows at most
    floor, held = 64, 0
    for power, n in sorted(((r["power"], r["count"]) for r in sizes), reverse=True):
        held += n
        if held > limit:
            break
        floor = power
    return 1 << min(floor, 62)


def score_links(aligned: DataFrame, *, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """Append ``n_best`` and ``count_sum`` to ``align_documents``' rows in place of the pairs.

    A link's count is the number of documents that link its id pair.
    ``count_sum`` adds the counts of all links; ``n_best`` is the number of links
    whose count is the highest of their A id, ties included.
    """
    kept = [c for c in aligned.columns if c not in ("pair_a", "pair_b", "times")]
    names = [f"c{i}" for i in range(len(kept))]
    lists = ["pair_a", "pair_b", "times"]
    table = written(aligned.select(F.monotonically_increasing_id().alias("row"), *[F.col(quoted(c)).alias(n) for c, n in zip(kept, names, strict=True)], *lists))
    pairs = saved(pair_documents(table))
    floor = _head_floor(pairs, head_pairs)
    head = pairs.where(F.col("docs") >= floor).select((F.col("a").cast("long") * (1 << 32) + F.col("b")).alias("key"), "docs", "best").toArrow()
    keys, docs, best = (head.column(i).to_numpy() for i in range(3))
    order = np.argsort(keys)
    shared = aligned.sparkSession.sparkContext.broadcast((keys[order], docs[order], best[order].astype(np.int64)))

    def looked_up(batch: pa.RecordBatch, at: int):
        a, b, times = (batch.column(at + i).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
        known, docs, best = shared.value
        keys = (a << 32) + b
        place = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        found = known[place] == keys if len(known) else np.zeros(len(keys), bool)
        lengths = batch.column(at).value_lengths().to_numpy(zero_copy_only=False)
        return a, b, times, place, found, np.repeat(np.arange(len(batch)), lengths), docs, best

    n = len(names) + 1
    frequent_schema = T.StructType([*table.schema.fields[:n], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, times, place, found, row, docs, best = looked_up(batch, n)
            sums = []
            for values in (best, docs):
                total = np.zeros(len(batch), np.int64)
                np.add.at(total, row[found], times[found] * values[place[found]])
                sums.append(pa.array(total))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *sums], names=frequent_schema.names)

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, times, _, found, row, _, _ = looked_up(batch, 1)
            rows = batch.column(0).to_numpy()
            columns = [rows[row[~found]], a[~found], b[~found], times[~found]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["row", "a", "b", "times"])

    result = table.mapInArrow(frequent, frequent_schema)
    n_best, count_sum = F.col("n_best"), F.col("count_sum")
    if floor > 1:
        rest = table.select("row", *lists).mapInArrow(rare, "row long, a long, b long, times long")
        rest = rest.join(pairs.where(F.col("docs") < floor).select(F.col("a").cast("long"), F.col("b").cast("long"), "docs", "best"), ["a", "b"])
        rest = rest.groupBy("row").agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"), F.sum(F.col("times") * F.col("docs")).alias("more"))
        result = result.join(rest, "row", "left")
        n_best, count_sum = n_best + F.coalesce("more_best", F.lit(0)), count_sum + F.coalesce("more", F.lit(0))
    return result.select(*[F.col(x) for x in names], n_best.alias("n_best"), count_sum.alias("count_sum")).toDF(*kept, "n_best", "count_sum")
