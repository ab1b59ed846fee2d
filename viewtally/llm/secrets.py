"""Secrets in texts, and weak candidates that complementary parts make strong.

Base kinds are found by pattern. An unlabelled key-like word or an endpoint says
little alone; it is reported only if a complementary part lies within ``reach``
code points of the same text: an access identifier for a word, an access
identifier or an assigned secret for an endpoint. Spans are matched by an
interval join over blocks of ``reach`` code points, so one text with very many
parts is spread over its blocks.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewtally.llm.components import saved
from viewtally.llm.textarrays import quoted

#: The patterns of the base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
MIN_ASSIGNED = 8

#: Weak kinds: a run of 40 key characters with all three sorts, and an address with a host.
WORD = r"[A-Za-z0-9/+]{40,}"
WORD_SIZE = 40
ENDPOINT = r"https?://[A-Za-z0-9.-]+(:[0-9]+)?(/[A-Za-z0-9._~/?=&%-]*)?"

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "weak_secret", "endpoint")
REACH = 200
SPAN = "array<struct<start:int,end:int>>"
PIECE = "array<struct<low:int,high:int>>"
#: Matches whose positions are counted in one go.
PART = 512
#: Code points of a stretch that a redacted text is put together from.
STRETCH = 1024


def match_spans(text: Column, pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """(start, end) in code points of the leftmost non-overlapping matches, without those that ``keep`` rejects."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(
        F.split(text, pattern, -1), found,
        lambda before, match: F.struct(
            F.length(before).alias("gap"), F.length(match).alias("size"), (keep(match) if keep else F.lit(True)).alias("good")
        ),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        low = acc["at"] + x["gap"]
        span = F.array(F.struct(low.alias("start"), (low + x["size"]).alias("end")))
        return F.struct(
            F.coalesce(low + x["size"], acc["at"]).alias("at"),
            F.when(x["good"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
        )

    def moved(acc: Column, part: Column) -> Column:
        spans = F.transform(part["spans"], lambda x: F.struct((x["start"] + acc["at"]).alias("start"), (x["end"] + acc["at"]).alias("end")))
        return F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["parts"], F.array(spans)).alias("parts"))

    # An array grows by copying, so positions are counted from the start of a part of the matches first, and the
    # parts are put in their places after. The array of one holds the matches, so that they are found once.
    def parts(found: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / PART).cast("int"))
        return F.transform(numbers, lambda i: F.aggregate(F.slice(found, i * PART + 1, F.lit(PART)), start, step))

    matched = F.array(F.filter(steps, lambda x: x["size"].isNotNull()))
    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("parts"))
    spans = F.aggregate(F.flatten(F.transform(matched, parts)), first, moved, lambda acc: F.flatten(acc["parts"]))
    return F.when(F.coalesce(text.rlike(pattern), F.lit(False)), spans).otherwise(F.array().cast(SPAN))


def _mixed(match: Column) -> Column:
    return (F.length(match) == WORD_SIZE) & match.rlike("[A-Z]") & match.rlike("[a-z]") & match.rlike("[0-9]")


def _base(text: Column) -> list[Column]:
    assigned = match_spans(text, ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= MIN_ASSIGNED)
    return [assigned, match_spans(text, ACCESS), match_spans(text, HEX)]


def _labelled(kind: int, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def find_secrets(
    docs: DataFrame, *, text: str = "text", reach: int = REACH, keep: Sequence[str] | None = None, result: str = "secret_spans"
) -> DataFrame:
    """Append ``result``: the spans of each whole text as array<struct<start, kind, end>>, in that order.

    ``kind`` counts the names of ``KINDS`` from 0. Null and empty texts have an
    empty array. Repeated rows get equal results; a kept column named like the
    result, without regard to case, gives way to it.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() != result.lower()]
    source = docs.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(kept)], F.col(quoted(text)).cast("string").alias("t"))
    whole = F.col("t")
    strong = whole.rlike(ACCESS) | whole.rlike(ASSIGN)
    open_ = F.coalesce((whole.rlike(WORD) | whole.rlike(ENDPOINT)) & strong, F.lit(False))

    base = F.concat(*[_labelled(i, x) for i, x in enumerate(_base(whole))])
    plain = source.where(~open_).select("*", base.alias("s")).withColumn("s", F.array_sort("s"))
    weak = F.concat(_labelled(3, match_spans(whole, WORD, _mixed)), _labelled(4, match_spans(whole, ENDPOINT)))
    # few texts have parts to link; they are kept, so that the corpus is read for them once
    candidates = saved(source.where(open_).select("*", F.sha2(whole, 256).alias("k"), base.alias("s"), weak.alias("w")))
    linked = link_parts(candidates.select("k", "s", "w"), reach)
    joined = candidates.drop("w").join(linked, "k", "left").withColumn(
        "s", F.array_sort(F.when(F.col("x").isNull(), F.col("s")).otherwise(F.concat("s", "x")))
    )
    names = [f"c{i}" for i in range(len(kept))]
    return plain.select(*names, "s").unionAll(joined.select(*names, "s")).toDF(*kept, result)


def link_parts(candidates: DataFrame, reach: int) -> DataFrame:
    """(k, x): the weak spans of each text that lie within reach of a complementary part and overlap no base span.

    Equal texts share the key ``k`` and are looked at once.
    """

    def spans(name: str) -> DataFrame:
        one = candidates.select("k", F.explode(name).alias("p"))
        return one.select("k", F.col("p.start").alias("start"), F.col("p.kind").alias("kind"), F.col("p.end").alias("end")).distinct()

    def blocks(df: DataFrame, margin: int, name: str) -> DataFrame:
        low, high = F.floor((F.col("start") - margin) / reach), F.floor((F.col("end") + margin) / reach)
        return df.select("k", F.struct("start", "kind", "end").alias(name), F.explode(F.sequence(low, high)).alias("block"))

    parts, weak = spans("s"), blocks(spans("w"), 0, "x")
    near = blocks(parts.where("kind < 2"), reach, "p")
    fits = (
        (F.greatest(F.col("p.start") - F.col("x.end"), F.col("x.start") - F.col("p.end")) <= reach)
        & ((F.col("p.kind") == 1) | (F.col("x.kind") == 4))
    )
    found = weak.alias("a").join(near.alias("b"), (F.col("a.k") == F.col("b.k")) & (F.col("a.block") == F.col("b.block")) & fits, "left_semi")
    over = (F.col("p.start") < F.col("x.end")) & (F.col("x.start") < F.col("p.end"))
    covered = blocks(parts, 0, "p")
    hidden = weak.alias("a").join(covered.alias("b"), (F.col("a.k") == F.col("b.k")) & (F.col("a.block") == F.col("b.block")) & over, "left_semi")
    alone = found.select("k", "x").distinct().join(hidden.select("k", "x").distinct(), ["k", "x"], "left_anti")
    return alone.groupBy("k").agg(F.collect_list("x").alias("x"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def secret_digests(docs: DataFrame, *, id: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and all spans as text, for each row."""
    found = find_secrets(docs, text=text, reach=reach, keep=[id])
    spans = F.col("secret_spans")

    def count(kind: int) -> Column:
        return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        quoted(id),
        *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)],
        F.sha2(written(F.filter(spans, lambda x: x["kind"] < len(BASE_KINDS))), 256).alias("base_sha256"),
        written(spans).alias("spans"),
    )


def _between(text: Column, spans: Column) -> Column:
    """What is left of a text, as an array of the pieces before, between and behind its spans (start, end), in that order.

    Spans that touch or overlap have no piece between them. A piece is put
    together from stretches of ``STRETCH`` code points, so the time grows with
    the text and the number of spans, not with their product.
    """
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / PART).cast("int")), lambda i: F.slice(spans, i * PART + 1, F.lit(PART)))

    def pieces(parts: Column, stretches: Column, length: Column) -> Column:
        ends = F.aggregate(
            parts, F.array(F.lit(-1)), lambda acc, part: F.array_append(acc, F.greatest(F.element_at(acc, -1), F.array_max(F.transform(part, lambda x: x["end"]))))
        )  # the furthest end before each part, and of all

        def step(acc: Column, x: Column) -> Column:
            piece = F.array(F.struct(F.greatest(acc["at"], F.lit(0)).alias("low"), x["start"].alias("high")))
            return F.struct(
                F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] > acc["at"], F.concat(acc["found"], piece)).otherwise(acc["found"]).alias("found")
            )

        def found(ends: Column) -> Column:
            inner = F.transform(
                parts,
                lambda part, i: F.aggregate(
                    part, F.struct(F.element_at(ends, i + 1).alias("at"), F.array().cast(PIECE).alias("found")), step, lambda acc: acc["found"]
                ),
            )
            return F.concat(F.flatten(inner), F.array(F.struct(F.element_at(ends, -1).alias("low"), length.alias("high"))))

        def cut(x: Column) -> Column:
            first, last = F.floor(x["low"] / STRETCH).cast("int"), F.floor((x["high"] - 1) / STRETCH).cast("int")

            def part(i: Column) -> Column:
                low = F.greatest(x["low"] - i * STRETCH, F.lit(0))
                return F.substring(F.element_at(stretches, i + 1), low + 1, F.least(x["high"] - i * STRETCH, F.lit(STRETCH)) - low)

            return F.when(x["low"] < x["high"], F.array_join(F.transform(F.sequence(first, last), part), "")).otherwise("")

        # an array of one holds what is asked for many times, so that it is made once
        return F.transform(F.flatten(F.transform(F.array(ends), found)), cut)

    held = F.array(F.struct(parts.alias("p"), F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % STRETCH), F.lit(0)).alias("s"), F.length(text).alias("n")))
    return F.flatten(F.transform(held, lambda x: pieces(x["p"], x["s"], x["n"])))


def redact_secrets(docs: DataFrame, *, text: str = "text", reach: int = REACH, mark: str = "[secret]") -> DataFrame:
    """The rows with every span of ``text`` replaced by ``mark``; spans that touch or overlap become one mark."""
    names = [f"k{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text)
    found = find_secrets(docs.toDF(*names), text=names[at], reach=reach)
    cut = F.array_join(_between(F.col(names[at]).cast("string"), F.col("secret_spans")), mark)
    cut = F.when(F.size("secret_spans") > 0, cut).otherwise(F.col(names[at]))
    return found.select(*[cut.alias(c) if c == names[at] else F.col(c) for c in names]).toDF(*docs.columns)
