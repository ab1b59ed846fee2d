"""Play quality: nested documents to rows, and their codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import QOS_DOCUMENT, QOS_SOURCE
from ._keys import join_on_keys
from .counts import with_totals
from .rankings import topn_per_group

# Outcome of a play code.
OUTCOMES = {"success": 200, "parse_failed": -1, "auto_failed": -2, "play_failed": -3}
MISSING_NUMBER = -1
MISSING_TEXT = "none"

_SOURCE_TEXT = ("videoSource", "sourceSwitch")
_TRY_NUMBERS = (
    "parseDuration", "initBufferDuration", "preAdDuration", "mediumAdDuration", "postAdDuration",
    "totalBufferTimes", "totalBufferDuration", "playDuration",
)
_TOP_TEXT = (
    "aid", "pathMain", "pathSpecial", "pathSub", "accountId", "contentType", "videoSid", "episodeSid",
    "playType", "uploadTime",
)
_TOP_NUMBERS = ("initDuration", "getVideoInfoDuration", "playStatus", "avgDownloadSpeed", "playRate")


def _marked(source: Column) -> Column:
    return F.struct(F.lit(True).alias("real"), source.cast(QOS_SOURCE).alias("v"))


def qos_explode(df: DataFrame, json_col: str = "jsonLog", broken: str = "drop", keep: Sequence[str] = ()) -> DataFrame:
    """One row per try of a source.

    A document without sources or without tries gives one row with the
    defaults -1 and 'none' and the flag ``playQos`` or ``sourceCases`` false.
    ``broken="drop"`` drops unreadable documents; ``"keep"`` keeps one row
    with blank keys and code 0, as the code counts want it.
    """
    schema = QOS_DOCUMENT.replace("struct<", "struct<_broken:string,", 1)
    # a text without a closing brace holds no whole object: unreadable, without the parser's costly failure
    whole = F.col(json_col).contains("}")
    parsed = F.when(whole, F.from_json(F.col(json_col), schema, {"columnNameOfCorruptRecord": "_broken"}))
    doc = df.select(*keep, parsed.alias("d"))
    ok = F.col("d").isNotNull() & F.col("d._broken").isNull()
    # only the flat fields travel with the exploded rows, not the document
    flat = doc.select(
        *keep, ok.alias("_ok"), F.coalesce(F.col("d.userId"), F.lit("")).alias("userId"),
        *[F.coalesce(F.col(f"d.{c}"), F.lit("")).alias(c) for c in _TOP_TEXT],
        *[F.coalesce(F.col(f"d.{c}"), F.lit(MISSING_NUMBER)).alias(c) for c in _TOP_NUMBERS],
        F.col("d.playqos").isNotNull().alias("playQos"),
        F.when(ok, F.coalesce(F.transform("d.playqos", _marked), F.array(_marked(F.lit(None))))).alias("_sources"),
    )
    top = ["userId", *_TOP_TEXT, *_TOP_NUMBERS, "playQos"]
    sources = flat.select(*keep, "_ok", *top, F.explode_outer("_sources").alias("s"))
    if broken == "drop":
        # a condition on the exploded value: one on the document itself would
        # be moved below the parsing and parse every text twice
        sources = sources.where(F.col("s.real").isNotNull())
    tries = sources.select(
        *keep, "_ok", *top, F.col("s.v").alias("s"),
        (F.col("playQos") & F.col("s.v.sourcecases").isNotNull()).alias("sourceCases"),
        F.explode_outer("s.v.sourcecases").alias("t"),
    )

    def text(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(MISSING_TEXT))

    def number(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(MISSING_NUMBER))

    code = F.when(~F.col("_ok"), F.lit(0)).otherwise(F.col("t.playCode"))
    return tries.select(
        *keep,
        *top,
        "sourceCases",
        *[(F.when(F.col("_ok"), text(f"s.{c}")).otherwise(F.lit(""))).alias(c) for c in _SOURCE_TEXT],
        number("s.sourceIndex").alias("sourceIndex"),
        code.alias("playCode"),
        text("t.playerType").alias("playerType"),
        *[number(f"t.{c}").alias(c) for c in _TRY_NUMBERS],
        F.col("t.bufferDurations").alias("bufferDurations"),
    )


def qos_codes(
    tries: DataFrame, keys: Sequence[str], totals: Mapping[str, Sequence[str]] | None = None, n: str = "n"
) -> DataFrame:
    """Tries per key, with the totals of coarser keys beside them.

    ``totals`` maps a new column to the keys it is summed over ([] for the
    grand total). Totals are sums of the grouped counts, not of the log.
    """
    counted = tries.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    out = counted
    for name, scope in (totals or {}).items():
        out = with_totals(out, list(scope), n, name, scope=counted)
    return out


def qos_topn(
    tries: DataFrame,
    ranked: DataFrame,
    group: Sequence[str],
    item: str,
    keys: Sequence[str],
    order: str,
    n: int = 200,
    totals: Mapping[str, Sequence[str]] | None = None,
    ties: str = "break",
) -> DataFrame:
    """Codes of the n top items of each group only.

    ``ranked`` holds (group, item, order); its top list is joined back to the
    grouped counts by (group, item).
    """
    top = topn_per_group(ranked, group, order, n, tie_break=[item], ties=ties, rank=None)
    names = [*group, item]
    counted = qos_codes(tries, keys, totals)
    return join_on_keys(counted, top.select(*names), names, "left_semi")


def qos_outcome(tries: DataFrame, keys: Sequence[str | Column], code: str = "playCode", outcomes: Mapping[str, int] = OUTCOMES) -> DataFrame:
    """Total tries and tries per outcome code, in one pass."""
    return tries.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(code) == c).alias(name) for name, c in outcomes.items()]
    )
