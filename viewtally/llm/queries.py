"""One query for each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally.llm import alignment, bpe, conversation_trie, decontamination, language, lattice, near_duplicates, nearest, quality, secrets, sharding, token_counts, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

VOCABULARY_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str, parts: int) -> Column:
    """The part of a row: crc32 of its id as text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and digests of its ids and of what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip_digests(docs, bpe.load_vocabulary(VOCABULARY_FILE), keep=["doc_id"])


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four of five parts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit_language_model(docs.where(remainder("doc_id", 5) != 0))
    found = language.identify_language(docs, model, keep=["doc_id"])
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "bits_per_byte")


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document: texts of equal words, and texts linked by a similarity of 0.8 or more."""
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with weak candidates that complementary parts confirm."""
    return secrets.secret_digests(table(spark, sf_dir, "documents"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from three of four parts."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = toxicity.fit_toxicity(docs, labels.where(remainder("doc_id", 4) != 2))
    scored = toxicity.score_toxicity(docs, model, keep=["doc_id"])
    return toxicity.with_decision(scored, remainder("doc_id", 4) == 2, 0.3)


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from four of five parts."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = quality.fit_quality(docs, labels.where(remainder("doc_id", 5) != 0))
    scored = quality.score_quality(docs, model, keep=["doc_id"])
    return toxicity.with_decision(scored, remainder("doc_id", 5) == 0, 0.3)


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every length in tokens that occurs, what a context of that length holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = bpe.count_tokens(docs, bpe.load_vocabulary(VOCABULARY_FILE), keep=["doc_id"])
    return token_counts.length_table(token_counts.length_histogram(counted))


SHARD_NAMES = tuple(f"shard-{i:03d}" for i in range(64))


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot and the shard of every document."""
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), SHARD_NAMES)


@query
def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    return nearest.nearest_vectors(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the conversations, rebuilt with the heads of their families."""
    seqs = conversation_trie.sequences(table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(conversation_trie.share_heads(seqs, family=5, heads=9))


@query
def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector by a cosine of 0.9 or more."""
    return lattice.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers in every document, with corpus-wide counts of id pairs."""
    first = alignment.byte_level_tokenizer(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    second = alignment.piece_tokenizer(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = alignment.score_links(alignment.align_documents(docs, first, second, keep=["doc_id"]))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links")
