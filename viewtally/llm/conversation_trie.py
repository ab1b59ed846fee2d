"""The prefix trie of conversations: which turns many conversations begin with.

Conversations are sorted as sequences of turn digests, so that members of a node
lie side by side and the longest common prefix (LCP) of two neighbours is the
depth at which their paths part. Inside a block of neighbours union-find takes
the LCP edges in descending depth: every merge of two components makes the
branching node of that depth, or widens it. What a block cannot finish are the
nodes on the paths of its first and its last conversation. Each block hands on
only those, contracted to one row a depth, and equal ones of all blocks are
merged by the digest of their prefix.

A block is some thousands of neighbours of a range partition, and copies of one
conversation are spread over partitions by their ids, so no task sees a whole
group. One conversation is one row of 16 bytes for each of its turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtally.llm.components import saved
from viewtally.llm.textarrays import quoted

#: Conversations, and turns of them, that one union-find works on.
BLOCK_ROWS = 10_000
BLOCK_TURNS = 1_000_000

TOKEN = 16
NOTHING = hashlib.sha256().hexdigest()


def sequences(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns) for every conversation; ``turns`` holds (digest, bytes of the text) in order.

    Turns are in the order of their numbers, null first; those of equal number
    in the order of their digests (of role and text; null counts as empty).
    Repeated rows are turns of their own. Rows without an id take no part.
    """
    who, what = (F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in (role, text))
    said = turns.select(
        F.col(quoted(conv)).cast("long").alias("conv_id"),
        F.col(quoted(turn)).cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, what).cast("binary"))).alias("token"),
        F.octet_length(what).cast("long").alias("bytes"),
    ).where("conv_id IS NOT NULL")
    ordered = said.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "token", "bytes"))).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda x: F.struct(x["token"].alias("token"), x["bytes"].alias("bytes"))).alias("turns"))


def share_heads(seqs: DataFrame, family: int, heads: int) -> DataFrame:
    """Conversations whose first turns are those of the first of their family.

    The first h turns of conversation c - c % family (all if it has fewer, none
    if it is absent), then c's own turns after its first h; h is the crc32 of
    the decimal c modulo ``heads``. One of no turn at all stays, empty.
    """
    first = F.col("conv_id") - F.col("conv_id") % family
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    leaders = seqs.where(first == F.col("conv_id")).select(F.col("conv_id").alias("first"), F.slice("turns", 1, heads - 1).alias("head"))
    nothing = F.slice("turns", 1, F.lit(0))
    head = F.slice(F.coalesce("head", nothing), F.lit(1), h)
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    joined = seqs.withColumn("first", first).join(leaders, "first", "left")
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


FOREST = T.StructType(
    [
        T.StructField("block", T.LongType()),  # the first conversation of the block
        T.StructField("side", T.IntegerType()),  # open: 0 on the path of the first conversation, 1 on that of the last; null: closed
        T.StructField("depth", T.LongType()),
        T.StructField("conv_id", T.LongType()),
        T.StructField("parent_conv_id", T.LongType()),
        T.StructField("parent_side", T.IntegerType()),  # of a closed node below an open one
        T.StructField("n_convs", T.LongType()),
        T.StructField("n_children", T.LongType()),  # open: without open ones
        T.StructField("n_leaves", T.LongType()),  # open: those of closed children
        T.StructField("saved", T.LongType()),  # open: that of closed children
        T.StructField("ends", T.StringType()),  # closed: digest; open: ids
        T.StructField("first_end", T.LongType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("parent_key", T.BinaryType()),
        T.StructField("bytes", T.LongType()),  # of the last text
    ]
)


def neighbour_depths(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many first tokens each sequence shares with the one before it (none for the first)."""
    lengths = np.diff(offsets)
    shared = np.zeros(len(lengths), np.int64)
    common = np.minimum(lengths[1:], lengths[:-1])
    some = np.flatnonzero(common)
    if len(some):
        counts = common[some]
        begins = np.cumsum(counts) - counts
        step = np.arange(counts.sum()) - np.repeat(begins, counts)
        left, right = np.repeat(offsets[some], counts) + step, np.repeat(offsets[some + 1], counts) + step
        differs = (tokens[left] != tokens[right]).any(axis=1)
        shared[some + 1] = np.minimum.reduceat(np.where(differs, step, np.repeat(counts, counts)), begins)
    return shared


class Forest:
    """The trie of one block of sorted conversations, by union-find over the edges between neighbours."""

    def __init__(self, ids: np.ndarray, tokens: np.ndarray, offsets: np.ndarray, sizes: np.ndarray):
        n = len(ids)
        self.ids, self.tokens, self.offsets, self.sizes = ids.tolist(), tokens, offsets.tolist(), sizes.tolist()
        # a node for each conversation where it ends; merges add the branching ones
        self.depth = np.diff(offsets).tolist()
        self.member = list(range(n))  # one conversation below the node
        self.least = list(self.ids)
        self.count = [1] * n
        self.children, self.leaves, self.kept = [0] * n, [0] * n, [0] * n
        self.ends = [[c] for c in self.ids]
        self.first, self.last = [i == 0 for i in range(n)], [i == n - 1 for i in range(n)]
        self.into = {}  # a node that became part of another one of its depth
        self.closed: list[tuple] = []
        self.open: tuple[dict, dict] = ({}, {})
        self._grow(neighbour_depths(tokens, offsets))

    def _grow(self, shared: np.ndarray) -> None:
        n = len(self.ids)
        root, top = list(range(n)), list(range(n))  # of components; the top node of a component

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        depths = shared.tolist()
        for edge in (np.argsort(-shared[1:], kind="stable") + 1).tolist():
            a, b, depth = find(edge - 1), find(edge), depths[edge]
            x, y = top[a], top[b]
            at_x, at_y = self.depth[x] == depth, self.depth[y] == depth
            if at_x and at_y:
                self._join(x, y)
                node = x
            elif at_x or at_y:
                node, below = (x, y) if at_x else (y, x)
                self._attach(below, node)
            else:
                node = self._branch(depth, x)
                self._attach(x, node)
                self._attach(y, node)
            root[b] = a
            top[a] = node
        self._finish(top[find(0)], -1, None)

    def _branch(self, depth: int, below: int) -> int:
        for values, new in (
            (self.depth, depth), (self.member, self.member[below]), (self.least, self.least[below]), (self.count, 0), (self.children, 0),
            (self.leaves, 0), (self.kept, 0), (self.ends, []), (self.first, False), (self.last, False),
        ):
            values.append(new)
        return len(self.depth) - 1

    def _join(self, x: int, y: int) -> None:
        """y becomes part of x, a node of the same prefix; ids stay in order when y lies behind x."""
        self.into[y] = x
        self.children[x] += self.children[y]
        self.leaves[x] += self.leaves[y]
        self.kept[x] += self.kept[y]
        self.ends[x] += self.ends[y]
        self._widen(x, y)

    def _attach(self, below: int, node: int) -> None:
        leaves, kept, still_open = self._finish(below, self.depth[node], node)
        if not still_open:
            self.children[node] += 1
            self.leaves[node] += leaves
            self.kept[node] += kept
        self._widen(node, below)

    def _widen(self, x: int, y: int) -> None:
        self.count[x] += self.count[y]
        self.least[x] = min(self.least[x], self.least[y])
        self.first[x] |= self.first[y]
        self.last[x] |= self.last[y]

    def _finish(self, node: int, above: int, parent: int | None) -> tuple[int, int, bool]:
        """All members of ``node`` are known: note it and the nodes of one child between it and ``above``."""
        depth, others, least = self.depth[node], self.count[node] - 1, self.least[node]
        at, children, ends = self.offsets[self.member[node]] - 1, self.children[node], self.ends[node]
        leaves, kept = self.leaves[node], self.kept[node]
        if self.first[node] or self.last[node]:
            for d in range(depth, above, -1):
                row = (least, others + 1, children, leaves, kept, ends, self.sizes[at + d] if d else 0)
                if self.first[node]:
                    self.open[0][d] = row
                if self.last[node]:
                    self.open[1][d] = None if self.first[node] else row
                children, leaves, kept, ends = 0, 0, 0, ()
            return 0, 0, True
        leaves = leaves or 1
        for d in range(depth, above, -1):
            kept += others * self.sizes[at + d]
            self.closed.append((d, least, parent if d == above + 1 else None, others + 1, children, leaves, kept, ends))
            children, ends = 1, ()
        return leaves, kept, False

    def rows(self) -> Iterator[tuple]:
        """In the columns of ``FOREST``."""
        block = self.ids[0]
        for d, least, parent, count, children, leaves, kept, ends in self.closed:
            side, above = None, least
            if parent is not None:
                while parent in self.into:
                    parent = self.into[parent]
                if self.first[parent] or self.last[parent]:
                    side, above = (0 if self.first[parent] else 1), None
                else:
                    above = self.least[parent]
            digest = hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest() if ends else NOTHING
            yield block, None, d, least, above, side, count, children, leaves, kept, digest, None, None, None, None
        for side, path in enumerate(self.open):
            lies = 0 if side == 0 else len(self.ids) - 1
            low = self.offsets[lies]
            running, before = hashlib.md5(), None
            for d in range(len(path)):
                if d:
                    running.update(self.tokens[low + d - 1].tobytes())
                key = running.digest()
                least, count, children, leaves, kept, ends, size = path[d] or (None, 0, 0, 0, 0, (), None)
                ends = sorted(ends)
                yield (
                    block, side, d, least, None, None, count, children, leaves, kept,
                    ",".join(map(str, ends)) if ends else None, ends[0] if ends else None, key, before, size,
                )
                before = key


def _forests(block_rows: int, block_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(FOREST)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            joined, sizes = batch.column(1).cast(pa.large_binary()), batch.column(2)
            ends = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1 + joined.offset)[joined.offset :] // TOKEN
            data = joined.buffers()[2]
            data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            tokens = data[ends[0] * TOKEN : ends[-1] * TOKEN].view(np.uint64).reshape(-1, 2)
            lengths = np.diff(ends)
            texts = sizes.flatten().to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            low = 0
            while low < len(ids):
                high = int(np.searchsorted(offsets, offsets[low] + block_turns, "right")) - 1
                high = min(max(high, low + 1), low + block_rows, len(ids))
                a, b = offsets[low], offsets[high]
                forest = Forest(ids[low:high], tokens[a:b], offsets[low : high + 1] - a, texts[a:b])
                rows = list(forest.rows())
                for k in range(0, len(rows), 10_000):
                    columns = zip(*rows[k : k + 10_000], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
                low = high

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of ids sorted by key and first id; a key's pieces pass through one running digest."""
    key, running = None, None

    def done(keys, digests):
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["key", "ends"])

    for batch in batches:
        keys, digests = [], []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if k != key:
                if running is not None:
                    keys.append(key)
                    digests.append(running.hexdigest())
                key, running = k, hashlib.sha256(ids.encode())
            else:
                running.update(b",")
                running.update(ids.encode())
        yield done(keys, digests)
    if running is not None:
        yield done([key], [running.hexdigest()])


def prefix_trie(seqs: DataFrame, *, block_rows: int = BLOCK_ROWS, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The nodes of the trie over ``seqs`` (conv_id, turns (token, bytes)); ids are unique.

    A node is a distinct sequence of the first ``depth`` turns, from the root at
    depth 0; a conversation of no turn is a member of the root alone. Columns:
    ``conv_id`` (smallest member; with the depth it names the node), ``depth``,
    ``parent_conv_id`` (null: root), ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes of last texts times the members but one, summed over
    the subtree) and ``ends_sha256`` (of the ids of those that end there). No
    conversation: no node.
    """
    joined = F.unhex(F.array_join(F.transform("turns", lambda x: F.hex(x["token"])), ""))
    flat = seqs.select("conv_id", joined.alias("seq"), F.transform("turns", lambda x: x["bytes"]).alias("bytes"))
    ordered = flat.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id").select("conv_id", "seq", "bytes")
    found = saved(ordered.mapInArrow(_forests(block_rows, block_turns), FOREST))
    closed, paths = found.where("side IS NULL"), found.where("side IS NOT NULL")

    # equal open nodes of all blocks are one node; its home is the first path it lies on
    merged = paths.groupBy("key").agg(
        F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inner"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("bytes").alias("bytes"),
        F.min(F.struct("block", "side")).alias("home"),
    )
    outer = merged.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("outer"))
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    nodes = saved(
        merged.join(outer, "key", "left").join(above, "parent_key", "left").select(
            "key", "depth", "conv_id", "parent_conv_id", "n_convs", "home", (F.col("inner") + F.coalesce("outer", F.lit(0))).alias("n_children"), "leaves",
            (F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        )
    )

    # a subtree is the sum of what each path through its top has below it, every node counted on its home path
    at_home = F.col("home") == F.struct("block", "side")
    below = Window.partitionBy("block", "side").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    leaf = F.col("leaves") + (F.col("n_children") == 0).cast("long")
    on_paths = paths.select("block", "side", "depth", "key").join(nodes.select("key", "home", "conv_id", "n_children", "leaves", "saved"), "key")
    sums = on_paths.select(
        "key",
        F.sum(F.when(at_home, leaf).otherwise(0)).over(below).alias("n_leaves"),
        F.sum(F.when(at_home, F.col("saved")).otherwise(0)).over(below).alias("saved_tokens"),
    ).groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    pieces = paths.where("ends IS NOT NULL").select("key", "first_end", "ends").repartition("key").sortWithinPartitions("key", "first_end")
    digests = pieces.mapInArrow(_digests, "key binary, ends string")
    shared = nodes.drop("saved").join(sums, "key").join(digests, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256")
    )

    # the parent of a closed node: known in its block, or a node of one of the block's two paths
    tops = on_paths.select("block", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("top"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
    inside = closed.where("parent_side IS NULL").select(*columns)
    hanging = closed.where("parent_side IS NOT NULL").join(tops, ["block", "parent_side", "depth"])
    hanging = hanging.withColumn("parent_conv_id", F.col("top")).select(*columns)
    return inside.unionByName(hanging).unionByName(shared)
