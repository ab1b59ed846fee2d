"""Near-duplicate texts by ProbMinHash, banding and exact verification.

A text is the weighted set of its shingles (``size`` consecutive words, weighted
by how often they occur). Similarity is the probability Jaccard

    J(x, y) = sum over i in both of 1 / sum over j of max(x_j / x_i, y_j / y_i)

which is the plain Jaccard similarity when no shingle repeats. Every shingle is
a Poisson process whose rate is its weight; its arrivals go to registers at
random, and a register keeps the shingle that arrived first. Two texts agree in
a register with probability J. A shingle stops once its next arrival is later
than every register of its text.

Texts with equal words are one text, whatever the ids of their rows. A byte of
each register is kept; the bytes are cut into bands, and equal bands put texts
into a bucket. Pairs are verified exactly, and what verified pairs connect is a
group. Large groups are joined in a few rounds first: the texts of a bucket are
sorted by their registers, each is compared with the ``WINDOW`` ones before it and
with the first one of its stretch, and the best pair of each text is verified,
one pair a text and round. Buckets whose texts are all in one group are done. The
texts of different groups in the others are then compared by their registers, in
blocks of ``BLOCK`` texts, and those that agree often enough are verified there
(``MARGIN`` below the wanted similarity is four standard deviations of that
estimate). No pair within a group is tried then, a pair is tried in the first
band only in which it agrees, and a block tells only links that join two groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtally.llm.components import connected_components, saved
from viewtally.llm.decontamination import window_hashes
from viewtally.llm.textarrays import LOWER, map_text, mix, quoted, span_hashes, words

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 8
BLOCK = 1000
#: Texts before it that a text is compared with in its bucket.
WINDOW = 4
#: Bands whose buckets the rounds look at; later rounds only see what is still open.
ROUND_BANDS = (6, 32)
MARGIN = 0.10

#: A text in which this occurs has a word, as ``WORD_BYTES`` has it.
SOME_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"

_STEP = np.uint64(0xA0761D6478BD642F)
_TURN = np.uint64(0xE7037ED1A0B428DB)


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes | None]]:
    """(row, shingle, weight) in order of the rows, and for each row a digest of its words.

    A text with fewer words than ``size``, but not none, is one shingle. A text
    without words has no shingle and no digest.
    """
    raw = LOWER[raw]
    starts, ends, rows = words(raw, offsets)
    hashes = span_hashes(raw, starts, ends)
    first = np.searchsorted(rows, np.arange(len(offsets)))
    counts = np.diff(first)
    digests = [xxhash.xxh3_128_digest(hashes[a:b].tobytes()) if b > a else None for a, b in zip(first[:-1], first[1:], strict=True)]
    found, owners = [], []
    for n in range(1, size + 1):
        wanted = window_hashes(hashes, n)
        at = np.flatnonzero(rows[: len(wanted)] == rows[n - 1 :][: len(wanted)])
        at = at[counts[rows[at]] >= size] if n == size else at[counts[rows[at]] == n]
        found.append(wanted[at])
        owners.append(rows[at])
    found, owners = np.concatenate(found), np.concatenate(owners)
    _, index, weights = np.unique(found ^ mix(owners.astype(np.uint64)), return_index=True, return_counts=True)
    order = np.argsort(owners[index], kind="stable")
    return owners[index][order], found[index][order], weights[order], digests


def registers(owners: np.ndarray, elements: np.ndarray, weights: np.ndarray, rows: int, n: int) -> np.ndarray:
    """The element that wins each of ``n`` registers of each row; rows without elements are all zero."""
    times = np.full(rows * n, np.inf)
    winners = np.zeros(rows * n, np.uint64)
    latest = np.full(rows, np.inf)
    clock = np.zeros(len(elements))
    turn = np.zeros(1, np.uint64)
    while len(elements):
        turn += _STEP
        draw = mix(elements + turn)
        clock -= np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights
        early = clock < latest[owners]
        owners, elements, weights, clock, draw = owners[early], elements[early], weights[early], clock[early], draw[early]
        at = owners * n + (mix(draw ^ _TURN) % np.uint64(n)).astype(np.int64)
        np.minimum.at(times, at, clock)
        won = times[at] == clock
        winners[at[won]] = elements[won]
        busy = np.unique(owners)
        latest[busy] = times.reshape(rows, n)[busy].max(axis=1)
    return winners.reshape(rows, n)


def sketches(docs: DataFrame, *, id: str, text: str, size: int, n: int) -> DataFrame:
    """(id, digest of the words, a byte of each of ``n`` registers); both null for a text without words."""
    results = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("sketch", T.BinaryType())])

    def worker():
        def sketch(raw, offsets):
            owners, elements, weights, digests = shingles(raw, offsets, size)
            won = (mix(registers(owners, elements, weights, len(digests), n)) & np.uint64(255)).astype(np.uint8)
            return [digests, [None if d is None else row.tobytes() for d, row in zip(digests, won, strict=True)]]

        return sketch

    return map_text(docs, text, results, worker, keep=[id]).toDF("id", "digest", "sketch")


def weighted_shingles(docs: DataFrame, *, text: str, size: int) -> DataFrame:
    """(digest, s, w): of each text its words' digest, its shingles in order, six bytes each, and their weights, null if all are one."""
    results = T.StructType([T.StructField(c, T.BinaryType()) for c in ("digest", "s", "w")])

    def worker():
        def sets(raw, offsets):
            owners, elements, weights, digests = shingles(raw, offsets, size)
            elements >>= np.uint64(16)
            order = np.lexsort((elements, owners))
            elements, weights = elements[order], weights[order].astype(np.int32)
            cut = np.searchsorted(owners, np.arange(len(offsets)))
            spans = list(zip(cut[:-1], cut[1:], strict=True))
            packed = elements.view(np.uint8).reshape(-1, 8)[:, :6]
            return [
                digests, [packed[i:j].tobytes() for i, j in spans],
                [None if (weights[i:j] == 1).all() else weights[i:j].tobytes() for i, j in spans],
            ]

        return sets

    return map_text(docs, text, results, worker, keep=[])


def word_digests(docs: DataFrame, *, text: str, name: str) -> DataFrame:
    """``docs`` with the digest of each text's words, null for a text without words."""

    def worker():
        def digests(raw, offsets):
            raw = LOWER[raw]
            starts, ends, rows = words(raw, offsets)
            hashes = span_hashes(raw, starts, ends)
            first = np.searchsorted(rows, np.arange(len(offsets))).tolist()
            return [[xxhash.xxh3_128_digest(hashes[a:b].tobytes()) if b > a else None for a, b in zip(first, first[1:])]]  # noqa: B905

        return digests

    return map_text(docs, text, T.StructType([T.StructField(name, T.BinaryType())]), worker)


def unpacked(s: bytes, w: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Shingles and weights of a packed set."""
    wide = np.zeros((len(s) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(s, np.uint8).reshape(-1, 6)
    elements = wide.view(np.uint64).ravel()
    return elements, np.ones(len(elements), np.int32) if w is None else np.frombuffer(w, np.int32)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """The similarity of two weighted sets, given as sorted elements and their weights."""
    common, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if x.max() == x.min() and y.max() == y.min():
        return len(common) / (len(a) + len(b) - len(common))  # each element of the union counts one
    ratio = x[i] / y[j]
    order = np.argsort(ratio, kind="stable")
    ratio, xs, ys = ratio[order], x[i][order].astype(float), y[j][order].astype(float)
    low = np.searchsorted(ratio, ratio, "left")  # before: smaller ratio, y decides; from here on: x decides
    sums_x, sums_y = np.append(0.0, np.cumsum(xs)), np.append(0.0, np.cumsum(ys))
    only_x, only_y = x.sum() - xs.sum(), y.sum() - ys.sum()
    total = (only_x + sums_x[-1] - sums_x[low]) / xs + (only_y + sums_y[low]) / ys
    return float((1 / total).sum())


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b, ...) whose exact similarity is at least ``similarity``."""
    left = sets.select(F.col("node").alias("a"), F.col("s").alias("s1"), F.col("w").alias("w1"))
    right = sets.select(F.col("node").alias("b"), F.col("s").alias("s2"), F.col("w").alias("w2"))
    both = pairs.join(left, "a").join(right, "b").select(*pairs.columns, "s1", "w1", "s2", "w2")
    n = len(pairs.columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = zip(*[c.to_pylist() for c in batch.columns[n:]], strict=True)
            found = np.array([probability_jaccard(*unpacked(s1, w1), *unpacked(s2, w2)) for s1, w1, s2, w2 in sets])
            yield batch.select(list(range(n))).filter(pa.array(found >= similarity - 1e-9))

    return both.mapInArrow(compare, pairs.schema)


def text_classes(rows_of: DataFrame, docs: DataFrame, *, text: str, size: int, similarity: float, bands: int, rows: int) -> DataFrame:
    """(digest, text_id, class_id, root) of every text of ``rows_of`` (id, digest, sketch), the sketches of ``docs``."""
    texts = rows_of.where("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("text_id"), F.min("sketch").alias("sketch"))
    texts = saved(texts.withColumn("node", F.monotonically_increasing_id()))
    banded = texts.select("node", "sketch", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"))
    key = F.xxhash64("band", F.substring("sketch", F.col("band") * rows + 1, F.lit(rows)))
    shared = banded.select("node", "band", key.alias("bucket"))
    several = shared.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = saved(shared.join(several, "bucket", "left_semi"))
    compared = texts.join(members.select("node").distinct(), "node", "left_semi").select("digest", "node")
    # copies become one row before the shuffle, and the join finds the sets where the digests have put them
    sets = weighted_shingles(docs, text=text, size=size).where("digest IS NOT NULL").groupBy("digest")
    sets = saved(sets.agg(F.min("s").alias("s"), F.min("w").alias("w")).join(compared, "digest").select("node", "s", "w"))
    groups = grouped(members, sets, texts.select("node", "sketch"), similarity, rows, bands)
    rooted = texts.join(groups, "node", "left").select("digest", "text_id", F.coalesce("root", "node").alias("root"))
    return saved(rooted.join(rooted.groupBy("root").agg(F.min("text_id").alias("class_id")), "root"))


def near_duplicates(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(id, text_id, class_id) for each row of ``docs``.

    ``text_id`` is the smallest id with the same words, ``class_id`` the smallest
    id that links lead to. Texts are compared whatever the ids of their rows:
    rows that repeat an id each have the class of their own text, and those
    without an id can be in the class of others; the ids of a class of which no
    row has one are null. A text without words (null, empty, marks only) is a
    class of its own, its row's id. Jobs run while this is called: steps go to
    the folder of ``spark.checkpoint.dir``.
    """
    own = docs.select(F.col(quoted(id)).alias("id"), F.col(quoted(text)).cast("string").alias("t"))
    sketched = saved(sketches(own, id="id", text="t", size=size, n=bands * rows))
    classes = text_classes(sketched, own, text="t", size=size, similarity=similarity, bands=bands, rows=rows)
    told = sketched.where("digest IS NOT NULL").select("id", "digest").join(classes, "digest").select("id", "text_id", "class_id")
    wordless = sketched.where("digest IS NULL").select("id", F.col("id").alias("text_id"), F.col("id").alias("class_id"))
    return told.unionAll(wordless).select(F.col("id").alias(id), "text_id", "class_id")


def one_of_each(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text",
    size: int = SHINGLE, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """One row of ``docs`` for each class of near duplicates, and every row without words.

    The row with the smallest id of its class stays (a null id is larger than
    others; of texts without any id the one with the smallest digest). Of several
    rows with that id and the same words the one with the first text stays. Rows
    that only share an id with another text are not touched.
    """
    own = docs.select(F.col(quoted(id)).alias("id"), F.col(quoted(text)).cast("string").alias("t"))
    sketched = saved(sketches(own, id="id", text="t", size=size, n=bands * rows))
    classes = text_classes(sketched, own, text="t", size=size, similarity=similarity, bands=bands, rows=rows)
    first = F.min(F.struct(F.col("text_id").isNull().alias("nameless"), "text_id", "digest")).alias("k")
    keepers = classes.groupBy("root").agg(first).select("k.digest", F.col("k.text_id").alias("keeper"))
    repeated = sketched.where("digest IS NOT NULL").groupBy("digest", F.col("id").alias("keeper")).agg(F.count("*").alias("n")).where("n > 1")
    again = repeated.select(F.col("digest").alias("d2"), F.col("keeper").alias("k2"), F.lit(True).alias("again"))
    keepers = keepers.join(again, (F.col("digest") == F.col("d2")) & F.col("keeper").eqNullSafe(F.col("k2")), "left")
    keepers = keepers.select(F.col("digest").alias("d"), F.col("keeper").alias("k"), F.coalesce("again", F.lit(False)).alias("again"))

    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.select(*[F.col(quoted(c)).alias(n) for c, n in zip(docs.columns, names, strict=True)])
    at = {c: n for c, n in zip(docs.columns, names, strict=True)}
    # map_text takes the text out of the columns, so it goes in twice
    marked = word_digests(plain.withColumn("t", F.col(at[text]).cast("string")), text="t", name="d1").drop("t")
    # what has no byte of a word is seen without a second pass of the digests
    wordless = plain.where(~F.coalesce(F.col(at[text]).cast("string").rlike(SOME_WORD), F.lit(False)))
    kept = marked.where("d1 IS NOT NULL").join(keepers, (F.col("d1") == F.col("d")) & F.col(at[id]).eqNullSafe(F.col("k")))
    alone = kept.where("NOT again").select(*names)
    order = F.struct(F.col(at[text]).cast("string"), F.xxhash64(*[F.to_json(F.struct(n)) for n in names]))
    one = kept.where("again").groupBy("d1", at[id]).agg(F.min_by(F.struct(*names), order).alias("r")).select("r.*")
    return wordless.unionAll(alone).unionAll(one.select(*names)).toDF(*docs.columns)


def grouped(members: DataFrame, sets: DataFrame, registers_of: DataFrame, similarity: float, rows: int, bands: int) -> DataFrame:
    """(node, root) of the members (node, band, bucket): what verified pairs of one bucket connect has one root."""
    current = members.select("node", F.col("node").alias("root")).distinct()
    for number, few in enumerate(ROUND_BANDS):
        open_ = _mixed(members.where(F.col("band") < few).join(current, "node"))
        near = neighbours(open_.join(registers_of, "node"), similarity - MARGIN, rows, bands, number)
        best = near.groupBy("b").agg(F.max_by(F.struct("a", "x", "y"), F.struct("agreeing", "a")).alias("p")).select("p.a", "b", "p.x", "p.y")
        links = saved(verified(best, sets, similarity).select("x", "y"))
        if links.isEmpty():
            continue
        moved = connected_components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
        current = saved(_renamed(current, moved))
    open_ = _mixed(members.join(current, "node"))
    links = saved(joining_links(open_, similarity, rows, registers_of, sets))
    if links.isEmpty():
        return current
    return _renamed(current, connected_components(links.select(F.col("x").alias("a"), F.col("y").alias("b"))))


def _mixed(members: DataFrame) -> DataFrame:
    """Members of buckets whose members are in more than one group."""
    mixed = members.groupBy("bucket").agg(F.min("root").alias("p"), F.max("root").alias("q")).where("p <> q").select("bucket")
    return members.join(mixed, "bucket", "left_semi")


def neighbours(members: DataFrame, agreement: float, rows: int, bands: int, turn: int) -> DataFrame:
    """(a, b, x, y, agreeing): of each member and bucket its best pair with a member of another group near it.

    The members (node, bucket, band, root, sketch) of a bucket are sorted by
    their registers, beginning behind the band (another place each ``turn``), in
    range partitions that cut large buckets. A member meets the ``WINDOW`` ones
    before it and the first one of its bucket in the partition.
    """
    start = F.pmod(F.col("band") + 1 + turn * 11, F.lit(bands)) * rows
    turned = F.concat(F.substring("sketch", start + 1, F.lit(bands * rows)), F.substring("sketch", F.lit(1), start))
    rows_of = members.select("bucket", turned.alias("turned"), "node", "root")
    dealt = rows_of.repartitionByRange("bucket", "turned", "node").sortWithinPartitions("bucket", "turned", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the last rows of the batch before: bucket, node, root, registers
        lead = None  # the first row of the bucket that goes on
        for batch in batches:
            if not len(batch):
                continue
            part = [batch.column(i).to_numpy() for i in (0, 2, 3)]
            part.append(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(len(batch), -1))
            old = 0 if before is None else len(before[0])
            bucket, node, root, bits = part if before is None else [np.concatenate(x) for x in zip(before, part, strict=True)]
            n = len(bucket)
            best, other, its = np.full(n, -1.0), np.zeros(n, np.int64), np.zeros(n, np.int64)

            def meet(at, agreeing, who, whose):
                better = agreeing > best[at]  # noqa: B023
                best[at[better]], other[at[better]], its[at[better]] = agreeing[better], who[better], whose[better]  # noqa: B023

            for step in range(1, min(WINDOW, n - 1) + 1):
                at = np.arange(max(step, old), n)
                at = at[(bucket[at] == bucket[at - step]) & (root[at] != root[at - step])]
                meet(at, (bits[at] == bits[at - step]).mean(axis=1), node[at - step], root[at - step])
            new = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            for low, high in zip(new, np.append(new[1:], n), strict=True):
                if lead is None or lead[0] != bucket[low]:
                    lead = bucket[low], node[low], root[low], bits[low]
                at = np.arange(max(low, old), high)
                at = at[root[at] != lead[2]]
                meet(at, (bits[at] == lead[3]).mean(axis=1), np.full(len(at), lead[1]), np.full(len(at), lead[2]))
            at = np.flatnonzero(best >= agreement)
            yield pa.RecordBatch.from_arrays([pa.array(v[at]) for v in (other, node, its, root, best)], names=["a", "b", "x", "y", "agreeing"])
            before = [v[-WINDOW:] for v in (bucket, node, root, bits)]

    return dealt.mapInArrow(run, "a long, b long, x long, y long, agreeing double")


def joining_links(members: DataFrame, similarity: float, rows: int, *of_node: DataFrame) -> DataFrame:
    """(x, y): roots that a pair of (bucket, band, node, root, sketch, s, w) in one bucket connects.

    ``of_node`` are frames of ``node`` with columns that ``members`` lacks; they
    join the members of the cells, so registers and sets are shuffled once.

    A pair of different roots is tried in the first band of ``rows`` registers in
    which it agrees, if it agrees in enough registers, and its sets are compared
    exactly. A bucket is cut into blocks of about ``BLOCK`` members, and each
    pair of blocks is a cell of its own, so that no task holds a whole large
    bucket. A cell tries no pair whose groups it has joined already, and tells
    one link less than it has groups at most.
    """
    blocks = members.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    cells = members.join(blocks, "bucket").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    for frame in of_node:
        cells = cells.join(frame, "node")
    cells = cells.select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "band", "root", "sketch", "s", "w"
    )
    dealt = cells.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    agreement = similarity - MARGIN

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            own, roots = cell.column(3).to_numpy(), cell.column(5).to_numpy()
            bits = np.frombuffer(b"".join(cell.column(6).to_pylist()), np.uint8).reshape(len(cell), -1)
            s, w = cell.column(7), cell.column(8)
            within, band = cell.column(1)[0] == cell.column(2)[0], cell.column(4)[0].as_py()
            group = roots.copy()  # the roots as far as this cell has joined them
            told = []
            for k in range(len(cell)):
                rest = group != group[k]
                if within:
                    rest[: k + 1] = False
                else:
                    rest &= own > own[k]
                at = np.flatnonzero(rest)
                equal = bits[at] == bits[k]
                new = equal.mean(axis=1) >= agreement
                new[new] = equal[new].reshape(int(new.sum()), bits.shape[1] // rows, rows).all(axis=2).argmax(axis=1) == band
                mine = None
                for j in at[new].tolist():
                    if group[j] == group[k]:
                        continue
                    mine = mine or unpacked(s[k].as_py(), w[k].as_py())
                    if probability_jaccard(*mine, *unpacked(s[j].as_py(), w[j].as_py())) >= similarity - 1e-9:
                        told.append((roots[k], roots[j]))
                        group[group == group[j]] = group[k]
            yield pa.RecordBatch.from_arrays([pa.array([t[i] for t in told], pa.int64()) for i in (0, 1)], names=["x", "y"])

    return dealt.mapInArrow(compare, "x long, y long")


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each cell (the first three columns) as one batch; they come in order."""
    left = None
    for batch in batches:
        if left is not None:
            batch = pa.concat_batches([left, batch])
        if not len(batch):
            continue
        keys = [batch.column(i).to_numpy() for i in range(3)]
        cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
            yield batch.slice(a, b - a)
        left = batch.slice(cuts[-1] if len(cuts) else 0)
    if left is not None and len(left):
        yield left


def _renamed(df: DataFrame, moved: DataFrame) -> DataFrame:
    """``df`` with the new root of each root."""
    new = moved.select(F.col("node").alias("root"), F.col("root").alias("new"))
    return df.join(new, "root", "left").select(*[F.coalesce("new", "root").alias("root") if c == "root" else c for c in df.columns])
