"""From raw documents to encoded training text, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as
Parquet to the shared folder and reads it again as the next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtally.llm import bpe, decontamination, language, near_duplicates, secrets
from viewtally.llm.queries import VOCABULARY_FILE, remainder, table
from viewtally.llm.textarrays import quoted
from viewtally.session import ensure_checkpoint_dir

#: A text with fewer letters is not called foreign: a name or a quotation may be all it has.
FOREIGN_LETTERS = 40


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that may be in one of the learned languages.

    Texts without a result (null, without letters) go, and texts of at least
    ``FOREIGN_LETTERS`` letters, none of which any learned language uses. How
    many bits a text needs decides nothing: keys, numbers and capitals are dear
    in a short text of any language.
    """
    model = language.fit_language_model(docs.where(remainder("doc_id", 5) != 0))
    # numbered columns: the results' names would hide those of documents
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.select(*[F.col(quoted(c)).alias(n) for c, n in zip(docs.columns, names, strict=True)])
    text = names[docs.columns.index("text")]
    found = language.identify_language(plain.withColumn("t", F.col(text)), model, text="t", keep=names).where(F.col("lang_pred") != language.UNDETERMINED)
    letters = language.learned_letters(model)
    if letters:
        used = F.col(text).rlike("[" + "".join(rf"\x{{{ord(x):X}}}" for x in letters) + "]")
        found = found.where(used | (F.length(F.regexp_replace(text, r"\P{L}+", "")) < FOREIGN_LETTERS))
    return found.select(*names).toDF(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every class of near duplicates, and documents without words."""
    return near_duplicates.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the table ``benchmark``."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of each secret; ``n_chars`` follows the text."""
    hidden = secrets.redact_secrets(docs)
    return hidden.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ranks of each text, their number, and the digests of ids and of the decoded bytes."""
    vocabulary = bpe.load_vocabulary(VOCABULARY_FILE)
    return bpe.round_trip_digests(docs, vocabulary, keep=["doc_id", "lang", "source"])


STAGES = [
    ("language_id", keep_known_languages),
    ("near_dedup", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("secret_scan", hide_secrets),
    ("byte_bpe", encode_texts),
]

ORACLE_SQL = None  # SQL cannot score language models, sketches or merges; tests hold it against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; the rows of the last one."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
