"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ``max_order`` bytes. A byte
that was seen after the longest known context costs ``-log2(c / (n + d))`` bits
(c: times it followed, n: bytes that followed, d: different ones); otherwise an
escape of ``-log2(d / (n + d))`` bits is paid and the next shorter context is
asked, down to eight bits for a byte that the language never showed. Counts are
frozen after training, and no symbols are excluded after an escape, so the cost
of a byte depends only on the bytes right before it. That makes the cost of a
text an exact sum over its distinct byte groups. A context before the beginning
of a text is padded with zero bytes.

Training counts groups of ``max_order + 1`` bytes in Spark; the models are built
from the counts. A model holds ``block`` languages and at most ``max_grams``
groups of each. More languages are scored in several passes, one model at a
time, and the results are those of one pass over all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtally.llm.components import saved
from viewtally.llm.textarrays import map_text, quoted, row_sums, text_chunks
from viewtally.session import bound_batches

UNDETERMINED = "und"
#: Languages of one model, and byte groups of one language: two million groups in a model at most.
BLOCK = 8
MAX_GRAMS = 250_000

RESULTS = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("bits_per_byte", T.DoubleType()),
    ]
)


def byte_groups(raw: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """For each byte the number made of the ``order`` bytes before it and itself."""
    kind = np.uint32 if order < 4 else np.uint64
    place = np.arange(len(raw)) - np.repeat(offsets[:-1], np.diff(offsets))
    codes = raw.astype(kind)
    for k in range(1, order + 1):
        before = np.zeros(len(raw), kind)
        before[k:] = raw[: max(len(raw) - k, 0)]
        before[place < k] = 0
        codes |= before << kind(8 * k)
    return codes


@dataclass
class LanguageModel:
    """``grams[k]``, ``bits[k]``: groups of k+1 bytes and their cost in each language; ``contexts``, ``escapes`` likewise."""

    languages: list[str]
    order: int
    grams: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]

    def cost(self, codes: np.ndarray, order: int | None = None) -> np.ndarray:
        """Bits of the last byte of each group, a column for each language."""
        order = self.order if order is None else order
        if order < 0:
            return np.full((len(codes), len(self.languages)), 8.0, np.float32)
        at, known = _find(self.grams[order], codes)
        out = np.empty((len(codes), len(self.languages)), np.float32)
        out[known] = self.bits[order][at[known]]
        if not known.all():
            rest = codes[~known]
            out[~known] = self.escape(rest >> type(rest[0])(8), order) + self.cost(_last(rest, order), order - 1)
        return out

    def escape(self, contexts: np.ndarray, order: int) -> np.ndarray:
        at, known = _find(self.contexts[order], contexts)
        return np.where(known[:, None], self.escapes[order][at], np.float32(0))


def _last(codes: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` bytes of each group (none: zero)."""
    return codes & type(codes[0])((1 << (8 * n)) - 1) if len(codes) else codes


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def build(languages: list[str], counts: pa.Table, order: int) -> LanguageModel:
    """The model of the rows (l: language, g: byte group, n: count)."""
    kind = np.uint32 if order < 4 else np.uint64
    of = pc.index_in(counts.column("l"), pa.array(languages, pa.string())).to_numpy()
    groups = counts.column("g").to_numpy().astype(kind)
    n = counts.column("n").to_numpy().astype(np.float64)
    model = LanguageModel(languages, order, [], [], [], [])
    for k in range(order + 1):
        suffix = _last(groups, k + 1)
        grams, at = np.unique(suffix, return_inverse=True)
        table = np.zeros((len(grams), len(languages)))
        np.add.at(table, (at, of), n)
        contexts, own = np.unique(grams >> kind(8), return_inverse=True)
        total = np.zeros((len(contexts), len(languages)))
        different = np.zeros_like(total)
        np.add.at(total, own, table)
        np.add.at(different, own, table > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escapes = np.where(total > 0, -np.log2(different / (total + different)), 0.0)
            seen = -np.log2(table / (total + different)[own])
        shorter = model.cost(_last(grams, k), k - 1)
        model.grams.append(grams)
        model.bits.append(np.where(table > 0, seen, escapes[own] + shorter).astype(np.float32))
        model.contexts.append(contexts)
        model.escapes.append(escapes.astype(np.float32))
    return model


@dataclass
class Learned:
    """Counted byte groups (l, g, n), and the languages in blocks, in order of their names."""

    blocks: list[list[str]]
    counts: DataFrame
    order: int

    @cached_property
    def _only(self) -> LanguageModel:
        return build(self.blocks[0], self.counts.toArrow(), self.order)

    def model(self, block: int) -> LanguageModel:
        """The model of one block; that of the only block is kept."""
        if len(self.blocks) == 1:
            return self._only
        return build(self.blocks[block], self.counts.where(F.col("l").isin(self.blocks[block])).toArrow(), self.order)


def learned_letters(learned: Learned | None) -> str:
    """The letters of the texts that were learned from, both cases of each (of up to ``order + 1`` bytes in UTF-8)."""
    found = set()
    for block in range(len(learned.blocks) if learned else 0):
        for k, grams in enumerate(learned.model(block).grams[:4]):
            lead = (grams >> grams.dtype.type(8 * k)).astype(np.int64)
            low, high = ((0, 0x80), (0xC2, 0xE0), (0xE0, 0xF0), (0xF0, 0xF5))[k]
            for code in grams[(lead >= low) & (lead < high)].tolist():
                letter = code.to_bytes(k + 1, "big").decode("utf-8", "ignore")
                if len(letter) == 1 and letter.isalpha():
                    found.update(letter, *(x for x in (letter.lower(), letter.upper()) if len(x) == 1))
    return "".join(sorted(found))


def fit_language_model(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    max_order: int = 3,
    sample_docs: int = 400,
    max_grams: int = MAX_GRAMS,
    block: int = BLOCK,
) -> Learned | None:
    """Count byte groups of about ``sample_docs`` whole texts of each language.

    The sample is taken by a hash of ``key``. Rows without a text or language
    are not used; without any row the result is None. Of a language the
    ``max_grams`` most frequent groups are learned, whatever the other languages
    have. The driver gets the names and sizes of the languages, and the counts of
    one block of languages at a time.
    """
    bound_batches(docs.sparkSession)
    labelled = docs.select(
        F.col(quoted(lang)).cast("string").alias("l"),
        F.col(quoted(text)).cast("string").alias("t"),
        (F.pmod(F.xxhash64(F.col(quoted(key))), F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("u"),
    ).where("l IS NOT NULL AND t IS NOT NULL")
    sizes = labelled.groupBy("l").count().collect()
    if not sizes:
        return None
    # as many rows as there are languages, whose names the driver has
    shares = docs.sparkSession.createDataFrame([(r["l"], min(1.0, sample_docs / r["count"])) for r in sizes], "l string, share double")
    sample = labelled.join(F.broadcast(shares), "l").where("u < share").select("l", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, at = np.unique(batch.column(0).to_pylist(), return_inverse=True)
            for low, high, raw, offsets in text_chunks(batch.column(1)):
                codes = byte_groups(raw, offsets, max_order).astype(np.int64)
                spoken = np.repeat(at[low:high], np.diff(offsets))
                for i in np.unique(spoken):
                    groups, n = np.unique(codes[spoken == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([str(names[i])] * len(groups)), pa.array(groups), pa.array(n.astype(np.int64))],
                        names=["l", "g", "n"],
                    )

    counted = sample.mapInArrow(count, "l string, g long, n long").groupBy("l", "g").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("l").orderBy(F.desc("n"), "g"))
    top = counted.withColumn("rank", rank).where(F.col("rank") <= max_grams).select("l", "g", "n")
    names = sorted(r["l"] for r in sizes)
    blocks = [names[i : i + block] for i in range(0, len(names), block)]
    return Learned(blocks, saved(top) if len(blocks) > 1 else top, max_order)


def identify_language(
    docs: DataFrame, learned: Learned | None, *, text: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """Append ``lang_pred``, ``score`` and ``bits_per_byte``.

    The language with the shortest code wins, the first by name among equals.
    ``score`` is its share when each language weighs two to the minus its code
    length. A text that is null or has no letter is ``und`` with score 0, as is
    every text if no language was learned. ``bits_per_byte`` is null for an
    empty text. Repeated rows get equal results. With more than one block of
    languages the steps between are kept in the shared folder.
    """
    keep = list(docs.columns if keep is None else keep)
    carried = [f"c{i}" for i in range(len(keep))]
    out = docs.select(*[F.col(quoted(c)).alias(n) for c, n in zip(keep, carried, strict=True)], F.col(quoted(text)).cast("string").alias("t"))
    lettered = F.coalesce(F.col("t").rlike(r"\p{L}"), F.lit(False))
    blocks = len(learned.blocks) if learned else 1
    for block in range(blocks):
        shared = docs.sparkSession.sparkContext.broadcast(learned.model(block) if learned else None)
        last = block == blocks - 1
        inputs = {"lettered": lettered, **({"before": F.struct("best", "bits", "mass")} if block else {})}
        out = map_text(out, "t", RESULTS if last else _BETWEEN, _scorer(shared, last), keep=carried + ([] if last else ["t"]), inputs=inputs)
        if not last:
            out = saved(out)
            shared.destroy()
    names = {f.name.lower() for f in RESULTS}
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, carried, strict=True) if c.lower() not in names], *[f.name for f in RESULTS])


_BETWEEN = T.StructType(
    [T.StructField("best", T.StringType()), T.StructField("bits", T.DoubleType()), T.StructField("mass", T.DoubleType())]
)


def _scorer(shared, last: bool):
    """The score of one broadcast block, on top of the best language of the blocks before.

    ``mass`` is the weight of all languages so far, that of the best one being 1.
    """

    def worker():
        model = shared.value

        def score(raw, offsets, lettered, before=None):
            sizes = np.diff(offsets)
            lettered = np.array([bool(x) for x in lettered.to_pylist()])
            if model is None:
                return [[UNDETERMINED] * len(sizes), np.zeros(len(sizes)), [None] * len(sizes)]
            codes, at = np.unique(byte_groups(raw, offsets, model.order), return_inverse=True)
            cost = model.cost(codes)
            bits = np.stack([row_sums(cost[:, i][at], offsets) for i in range(len(model.languages))], axis=1)
            best = bits.argmin(axis=1)
            least = bits[np.arange(len(best)), best]
            mass = np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
            best = [model.languages[i] for i in best]
            if before is not None:
                old = {k: pc.struct_field(before, k) for k in ("best", "bits", "mass")}
                old_bits, old_mass = old["bits"].to_numpy(zero_copy_only=False), old["mass"].to_numpy(zero_copy_only=False)
                best = [a if stays else b for a, b, stays in zip(old["best"].to_pylist(), best, old_bits <= least, strict=True)]
                both = np.minimum(old_bits, least)
                mass = old_mass * np.exp2(np.maximum(both - old_bits, -1000.0)) + mass * np.exp2(np.maximum(both - least, -1000.0))
                least = both
            if not last:
                return [best, least, mass]
            return [
                [b if x else UNDETERMINED for b, x in zip(best, lettered, strict=True)],
                np.where(lettered, 1 / mass, 0.0),
                [b / s if s else None for b, s in zip(least, sizes, strict=True)],
            ]

        return score

    return worker
