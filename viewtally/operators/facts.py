"""The play fact and its narrow form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import paths as P
from ..sources.merge import merge_sources, project_whitelist
from ..sources.schemas import PLAY
from .dictionaries import name_categories
from .enrich import dim_enrich
from .quality import FLOOD_LIMIT, flood_filter

CATEGORIES = ("main_category", "second_category", "third_category")


def with_path_dims(play: DataFrame, product: str) -> DataFrame:
    """entryType, subject code and name, and the list-page categories."""
    if product == "3x":
        categories = P.list_category_3x("pathMain")
        added = {
            "entryType": P.entrance_3x("pathMain"),
            "playKind": P.play_kind_3x("pathSpecial"),
            "subjectCode": P.subject_code_3x("pathSpecial"),
            "subjectName": P.subject_name("pathSpecial"),
        }
    else:
        categories = P.list_category_2x("path")
        added = {
            "entryType": P.entrance_2x("path"),
            "playKind": P.play_kind_2x("path"),
            "subjectCode": P.subject_code_2x("path"),
            "subjectName": F.lit(None).cast("string"),
        }
    out = play.select("*", *[e.alias(n) for n, e in added.items()], categories.alias("_c"))
    levels = [F.col(f"_c.level{i}").alias(name) for i, name in enumerate(CATEGORIES, start=1)]
    return out.select("*", *levels).drop("_c")


def play_fact(
    play3x: DataFrame | None,
    play2x: DataFrame | None,
    subjects: DataFrame | None = None,
    categories: DataFrame | None = None,
    limit: int = FLOOD_LIMIT,
) -> DataFrame:
    """Both play logs as one fact, as one lazy plan.

    Paths become dimensions; a subject named without its code gets the code
    from ``subjects`` (subject_name, subject_code), spaces around the names
    aside; categories are checked and named by ``categories``, the dictionary
    of ``category_dictionary``, second and third level in one join each;
    floods are dropped.
    """
    parts: list[tuple[DataFrame, str]] = []
    for product, log in (("3x", play3x), ("2x", play2x)):
        if log is not None:
            parts.append((with_path_dims(project_whitelist(log, PLAY), product), product))
    fact = merge_sources(parts)
    if subjects is not None:
        unnamed = F.coalesce(F.col("subjectCode") == "", F.lit(True))
        fact = dim_enrich(
            fact, subjects, {"_name": (F.col("subjectName"), F.col("subject_name"))}, {"_code": "subject_code"},
            guard=unnamed, trim=True,
        )
        fact = fact.withColumn("subjectCode", F.when(unnamed, F.col("_code")).otherwise(F.col("subjectCode"))).drop("_code")
    if categories is not None:
        fact = name_categories(fact, categories)
    return flood_filter(fact, ["day", "userId", "videoSid"], limit)


NULL_MARK = "\u0001"


def md5_key(cols: Sequence[str]) -> Column:
    """md5 of several columns; a missing part has a mark of its own, so
    ('a', null) and ('a') do not meet and one null does not erase the key."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def surrogate_exchange(
    fact: DataFrame,
    groups: Mapping[str, Sequence[str]],
    dims: Sequence[tuple[DataFrame, Mapping, str, str, Column | None]] = (),
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Replace groups of columns by keys: (narrow fact, dictionaries).

    ``groups`` maps the key column to the columns it stands for; each gives a
    dictionary of its distinct values. ``dims`` are existing dimensions as
    (dim, join keys, surrogate column, new name, guard); keys are trimmed.
    """
    keyed = fact.select("*", *[md5_key(cols).alias(key) for key, cols in groups.items()])
    dicts = {key: keyed.select(key, *cols).distinct() for key, cols in groups.items()}
    narrow = keyed
    for dim, on, surrogate, name, guard in dims:
        narrow = dim_enrich(narrow, dim, on, {name: surrogate}, trim=True, guard=guard)
    hidden = [c for cols in groups.values() for c in cols]
    return narrow.drop(*hidden), dicts
