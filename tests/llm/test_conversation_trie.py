import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness import connect
from viewtally.llm import checks, queries
from viewtally.llm.conversation_trie import neighbour_depths, prefix_trie, sequences, share_heads

TURNS = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
)
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    """Turns of each conversation, as the operator orders them."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, (role, text)))
    return {c: [x[-1] for x in sorted(t)] for c, t in own.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(convs):
    """Every node by its whole prefix."""
    members, ends, children = defaultdict(set), defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[x] for x in children[node]]
        saved = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        sums[node] = (sum(x[0] for x in below) or 1, saved + sum(x[1] for x in below))
    rows = []
    for node, own in members.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(own), len(node), parent, len(own), len(children[node]), *sums[node], digest))
    return sorted(rows, key=str)


def found(nodes):
    return sorted((tuple(r) for r in nodes.select(*COLUMNS).collect()), key=str)


def random_rows(seed, convs, words=3, longest=12):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        c = c * 3 if rng.random() < 0.3 else c
        for t in range(rng.choice([0, 1, 2, 4, 8, longest])):
            rows.append((c, rng.choice([t, None]) if rng.random() < 0.1 else t, rng.choice(["user", None]), rng.choice([None, "", "é", "text"][:words])))
    return rows


@pytest.mark.parametrize(("block", "turns"), [(1, 10**6), (3, 10**6), (7, 20), (10_000, 10**6)])
def test_nodes_are_those_of_all_prefixes(spark, block, turns):
    rows = random_rows(block, 150)
    seqs = sequences(spark.createDataFrame(rows, TURNS))
    assert found(prefix_trie(seqs, block_rows=block, block_turns=turns)) == brute(ordered(rows))


def test_shared_heads(spark):
    rows = random_rows(11, 120) + [(-7, 1, "user", "below zero"), (None, 1, "user", "no id")]
    seqs = share_heads(sequences(spark.createDataFrame(rows, TURNS)), family=5, heads=9)
    own = ordered(rows)
    first = {c: (c - c % 5 if c >= 0 else -(-c - -c % 5)) for c in own}
    convs = {c: own.get(first[c], [])[: zlib.crc32(str(c).encode()) % 9] + t[zlib.crc32(str(c).encode()) % 9 :] for c, t in own.items()}
    assert found(prefix_trie(seqs, block_rows=5)) == brute(convs)


def test_one_conversation_holds_most_turns_and_one_text_most_conversations(spark):
    rows = [(0, t, "user", f"turn {t}") for t in range(3000)] + [(c, t, "user", f"turn {t}") for c in range(1, 400) for t in range(3)] + [(400, 0, "user", "other")]
    seqs = sequences(spark.createDataFrame(rows, TURNS))
    assert found(prefix_trie(seqs, block_rows=50)) == brute(ordered(rows))


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], TURNS)
    assert found(prefix_trie(share_heads(sequences(empty), 5, 9))) == []
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 0, "user", "a")]
    df = spark.createDataFrame(rows, TURNS).withColumns({"token": F.lit(1), "turns": F.lit("x"), "key": F.lit(0), "a.b": F.lit(2)})
    assert found(prefix_trie(sequences(df))) == brute(ordered(rows))


def test_neighbour_depths():
    rng = random.Random(5)
    seqs = sorted([rng.randrange(2) for _ in range(rng.randrange(5))] for _ in range(60))
    tokens = np.array([[x, 7] for s in seqs for x in s], np.uint64).reshape(-1, 2)
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])

    def common(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))  # noqa: B905

    assert neighbour_depths(tokens, offsets).tolist() == [0] + [common(a, b) for a, b in zip(seqs, seqs[1:], strict=False)]


def test_query_and_its_sql(spark, sf_dir):
    got = queries.op11_conversation_trie(spark, sf_dir)
    told = connect(sf_dir).sql(checks.SQL["op11_conversation_trie"])
    assert told.columns == got.columns
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert found(got) == sorted(told.fetchall(), key=str) == brute(rebuilt(ordered(rows)))
