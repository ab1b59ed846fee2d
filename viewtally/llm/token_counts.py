"""Exact token counts for every context limit, from one histogram of lengths.

Documents are reduced to (length, number of documents) before anything is
sorted. Sums over all longer lengths then answer, for each limit L: documents
with at least L tokens, their tokens, and the tokens that remain when every
document is cut to L. The sums run inside blocks of ``BLOCK`` lengths and over
the blocks, so no task holds all lengths.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from viewtally.llm.components import saved
from viewtally.llm.textarrays import quoted

BLOCK = 1024


def length_histogram(counted: DataFrame, length: str = "n_tokens", by: Sequence[str] = ()) -> DataFrame:
    """(by..., length, docs); documents without a length are left out."""
    return (
        counted.where(F.col(quoted(length)).isNotNull())
        .groupBy(*[F.col(quoted(c)) for c in by], F.col(quoted(length)).cast("long").alias("length"))
        .agg(F.count("*").alias("docs"))
    )


def length_table(histogram: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A row for each length that occurs, as a context limit.

    ``docs``: documents of that length. ``docs_from``, ``tokens_from``: those of
    that length or more, and their tokens. ``truncated_tokens``: tokens of all
    documents when longer ones are cut to the limit. ``covered``: share of
    documents that fit, so the quantile q is the first limit with covered >= q.
    An empty histogram gives no rows.
    """
    names_by = list(by)
    by = [f"g{i}" for i in range(len(names_by))]  # a column's name may be one of those below
    plain = histogram.select(*[F.col(quoted(c)).alias(g) for c, g in zip(names_by, by, strict=True)], "length", "docs")
    # counted once: both the blocks and their lengths come from it
    parts = saved(plain).withColumn("block", F.floor(F.col("length") / BLOCK)).withColumn("tokens", F.col("length") * F.col("docs"))
    inside = W.partitionBy(*by, "block").orderBy(F.desc("length")).rowsBetween(W.unboundedPreceding, W.currentRow)
    longer = W.partitionBy(*by).orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy(*by)
    blocks = parts.groupBy(*by, "block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t")).select(
        *by, "block",
        F.coalesce(F.sum("d").over(longer), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("t").over(longer), F.lit(0)).alias("tokens_after"),
        F.sum("d").over(every).alias("all_docs"), F.sum("t").over(every).alias("all_tokens"),
    )
    names = [F.col(f"p.{quoted(c)}") for c in by]
    same = F.col("p.block") == F.col("b.block")
    for c in by:
        same &= F.col(f"p.{quoted(c)}").eqNullSafe(F.col(f"b.{quoted(c)}"))
    docs_from = F.sum("docs").over(inside)
    tokens_from = F.sum("tokens").over(inside)
    summed = parts.withColumn("docs_from", docs_from).withColumn("tokens_from", tokens_from)
    joined = summed.alias("p").join(blocks.alias("b"), same).select(
        *names, F.col("length").alias("context_limit"), "docs",
        (F.col("docs_from") + F.col("docs_after")).alias("docs_from"),
        (F.col("tokens_from") + F.col("tokens_after")).alias("tokens_from"), "all_docs", "all_tokens",
    )
    return joined.select(
        *by, "context_limit", "docs", "docs_from", "tokens_from",
        (F.col("all_tokens") - F.col("tokens_from") + F.col("context_limit") * F.col("docs_from")).alias("truncated_tokens"),
        ((F.col("all_docs") - F.col("docs_from") + F.col("docs")) / F.col("all_docs")).alias("covered"),
    ).toDF(*names_by, "context_limit", "docs", "docs_from", "tokens_from", "truncated_tokens", "covered")


def truncated_totals(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """(context_limit, tokens, docs_cut) for any limits, also between lengths that occur."""
    each = histogram.select("length", "docs", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("context_limit"))
    return each.groupBy("context_limit").agg(
        F.sum(F.least("length", "context_limit") * F.col("docs")).alias("tokens"),
        F.sum(F.when(F.col("length") > F.col("context_limit"), F.col("docs")).otherwise(0)).alias("docs_cut"),
    )
