"""Byte-level BPE against the tiktoken library, and round trips."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import ODD  # noqa: F401
from pyspark.sql import functions as F

from viewtally.llm import bpe
from viewtally.llm.perfect_hash import PerfectHash
from viewtally.llm.queries import QUERIES, VOCABULARY_FILE
from viewtally.llm.textarrays import text_chunks


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(VOCABULARY_FILE)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY_FILE, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts, vocabulary, **options):
    out = []
    for _, _, raw, offsets in text_chunks(pa.array(texts), **options):
        ids, begins = bpe.encode_chunk(raw, offsets, vocabulary)
        out += [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:], strict=True)]
    return out


def test_encodes_like_the_library(vocabulary, library):
    random.seed(5)
    parts = ["'", "s", "t", "re", "ve", "'ll", "d", " ", "  ", "\n", "\t", "a", "Z", "é", "中", "9", "²", "!", "..", "\x1c", "😀", "'S", "m", "　", "\x85"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 25))) for _ in range(4000)]
    texts += ["", "'s", "''s", " 's", "'s's", "I'll 've we'd", "a" * 3000, " " * 50, "x" + " " * 50 + "y", "<|endoftext|>", "don't  stop\n'd"]
    for size in (1 << 20, 64):
        got = encoded(texts, vocabulary, max_bytes=size)
        assert [t for t, ids in zip(texts, got, strict=True) if ids != library.encode_ordinary(t)] == []


def test_perfect_hash_is_minimal_and_refuses_repeats():
    numbers = np.random.default_rng(3).integers(0, 2**63, 5000).astype(np.uint64)
    hashed = PerfectHash(numbers)
    assert sorted(hashed.slots(numbers).tolist()) == list(range(5000))
    with pytest.raises(ValueError):
        PerfectHash(np.array([1, 1], np.uint64))


def test_whole_pre_tokens_need_no_merge(vocabulary, monkeypatch):
    monkeypatch.setattr(bpe.Vocabulary, "merged", lambda *_: pytest.fail("a token was merged"))
    assert encoded([" the", "and"], vocabulary) == [[262], [392]]


def test_query_equals_library(spark, sf_dir, documents, library):
    got = {r.doc_id: r for r in QUERIES["op2_byte_bpe"](spark, sf_dir).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        told = got[r.doc_id]
        assert told.n_tokens == len(ids)
        assert told.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert told.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_odd_rows_round_trip(odd, vocabulary, library):
    clashing = odd.withColumn("TOKEN_IDS", F.lit("mine")).withColumn("decoded", F.lit("mine"))
    frame = bpe.decode(bpe.encode(clashing, vocabulary), vocabulary)
    assert [c for c in frame.columns if c.lower() in ("token_ids", "decoded")] == ["token_ids", "decoded"]
    rows = frame.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r.decoded == (r.text or "")
        assert list(r.token_ids) == library.encode_ordinary(r.text or "")
    counts = bpe.count_tokens(odd, vocabulary).collect()
    assert sorted(r.n_tokens for r in counts) == sorted(len(r.token_ids) for r in rows)


def test_empty_table(odd, vocabulary):
    none = odd.where("doc_id < 0")
    assert bpe.round_trip_digests(none, vocabulary).columns[-3:] == ["n_tokens", "ids_sha256", "decoded_sha256"]
    assert bpe.round_trip_digests(none, vocabulary).count() == 0


def test_decode_refuses_unknown_ranks(spark, vocabulary):
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(spark.createDataFrame([([50_999],)], "token_ids array<int>"), vocabulary).collect()


def test_every_code_point_is_of_the_class_the_library_gives_it(vocabulary, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}a1{chr(c)}1 {chr(c)}'d {chr(c)} !{chr(c)}!" for c in points]
    bad = [hex(c) for c, t, ids in zip(points, texts, encoded(texts, vocabulary), strict=True) if ids != library.encode_ordinary(t)]
    assert bad == []
