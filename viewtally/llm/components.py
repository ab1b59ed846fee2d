"""Connected components of a link table, and tables that cut lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtally.session import ensure_checkpoint_dir


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node that links lead to.

    Large stars and small stars take turns: every node hands its larger, then
    its smaller neighbours to the smallest one, until each component is a star.
    A node of very many links is only ever an aggregate and the unique side of a
    join. Links to itself and null ends do not count.
    """
    stars = saved(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:  # no step makes more rows than there are links
        # in one pass over the links, not as a union: half the tasks and files
        turned = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
        both = stars.select(F.explode(F.array(F.struct("u", "v"), turned)).alias("e")).select("e.*")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        stars = saved(small.where("u <> v"))
        after = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionAll(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
