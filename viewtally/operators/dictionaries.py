"""Codes to names by one stacked dictionary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ._keys import as_column
from .enrich import dim_enrich

ENTRY = ("dictionary", "parent", "code", "value")


@dataclass(frozen=True)
class Part:
    """One dictionary: where its parent, code and value come from."""

    frame: DataFrame
    parent: Column | str
    code: Column | str
    value: Column | str
    where: Column | None = None


@dataclass(frozen=True)
class Lookup:
    """Which rows ask which dictionary, under which parent, by which code."""

    when: Column
    dictionary: str
    parent: Column | str
    code: Column | str


def current_rows(frame: DataFrame, valid_col: str = "dim_invalid_time") -> DataFrame:
    return frame.where(F.col(valid_col).isNull()) if valid_col in frame.columns else frame


def stack_dictionaries(parts: Mapping[str, Part], pick: str = "max") -> DataFrame:
    """(dictionary, parent, code, value), one row per key: the largest value (``pick``).

    Only current rows count. Entries without a parent, code or value are left
    out: they answer no question, or answer it as if they were not there.
    """
    chooser = {"max": F.max, "min": F.min}[pick]
    frames = []
    for name, part in parts.items():
        rows = current_rows(part.frame)
        if part.where is not None:
            rows = rows.where(part.where)
        fields = [as_column(c).cast("string").alias(n) for n, c in zip(ENTRY[1:], (part.parent, part.code, part.value))]
        frames.append(rows.select(F.lit(name).alias("dictionary"), *fields).dropna())
    stacked = reduce(DataFrame.unionByName, frames)
    return stacked.groupBy(*ENTRY[:3]).agg(chooser("value").alias("value"))


def translate(fact: DataFrame, dictionary: DataFrame, column: str, lookups: Sequence[Lookup], miss: Column | str | None = None) -> DataFrame:
    """Replace a column by what the dictionaries say, in one join.

    The first lookup whose condition holds is the row's; ``miss`` is the value
    of a row whose code is unknown (null by default). Rows for which no
    condition holds keep their value and take no part in the join.
    """
    # the first lookup whose condition holds is the only one that answers, also where its code is null
    number = F.coalesce(*[F.when(k.when, F.lit(i)) for i, k in enumerate(lookups)])

    def asked(of) -> Column:
        return F.coalesce(*[F.when(F.col("_asked") == i, of(k)) for i, k in enumerate(lookups)])

    fact_keys = {
        "_dictionary": asked(lambda k: F.lit(k.dictionary)),
        "_parent": asked(lambda k: as_column(k.parent)),
        "_code": asked(lambda k: as_column(k.code)),
    }
    found = dim_enrich(
        fact.withColumn("_asked", number), dictionary,
        {key: (expr, F.col(name)) for (key, expr), name in zip(fact_keys.items(), ENTRY)}, {"_found": "value"},
    )
    if miss is None:
        fallback = F.lit(None).cast("string")
    else:
        fallback = miss if isinstance(miss, Column) else F.lit(miss)
    value = F.when(F.col("_asked").isNotNull(), F.coalesce("_found", fallback)).otherwise(F.col(f"`{column}`"))
    return found.select(*[value.alias(c) if c == column else F.col(f"`{c}`") for c in fact.columns])


# ------------------------------------------------------------ list categories
def category_dictionary(sites: DataFrame, entrances: DataFrame, kids_programs: DataFrame) -> DataFrame:
    """All names of list categories in one dictionary.

    ``sites`` is the site tree (site_content_type, main_category_code,
    second_category_code, second_category, third_category_code,
    third_category), ``entrances`` the areas of pages (page_code, area_code,
    area_name), ``kids_programs`` the map of path to program codes (path_code,
    program_code). The names of the kids channel come by way of that map; an
    empty name and the text ``null`` are empty.
    """
    listed = F.col("main_category_code").isin(V.LISTED_SITES)
    names = stack_dictionaries({"area": Part(entrances, F.lit(""), "area_code", "area_name")})
    names = names.select(F.col("code").alias("program_code"), F.col("value").alias("area_name"))
    kids = current_rows(kids_programs).join(names, "program_code")
    shown = F.when(F.col("area_name").isin("", V.KEY_NULL), F.lit("")).otherwise(F.col("area_name"))
    # of the names of one second category the largest is its name; only that one is known
    codes = stack_dictionaries({"site_code": Part(sites, "site_content_type", "second_category_code", "second_category", listed)})
    known = codes.select(F.lit("site_name").alias("dictionary"), "parent", F.col("value").alias("code"), "value").distinct()
    other = stack_dictionaries({
        "sports_area": Part(entrances, "page_code", "area_code", "area_name", F.col("page_code") == V.SPORTS),
        "site_third": Part(sites, "site_content_type", "third_category_code", "third_category"),
        "kids_area": Part(kids, F.lit(V.KIDS), "path_code", shown),
    })
    return codes.unionByName(known).unionByName(other)


def name_categories(fact: DataFrame, dictionary: DataFrame, product: str = "flag") -> DataFrame:
    """Check and name the list categories of both product lines.

    A second category outside sports and kids must be in the site tree: 3.x
    logs hold its name (its code in the music channel), 2.x logs its code; it
    is null where the tree has no such entry, and empty where the log has
    none. Sports and kids hold codes of areas, null where unknown; the third
    category of sports is a code of the tree, but under the horizontal list.
    """
    main, second = F.col("main_category"), F.col("second_category")
    channel = F.coalesce(main, F.lit(""))
    sports, kids = channel == V.SPORTS, channel == V.KIDS
    given = F.coalesce(second != "", F.lit(False))
    by_name = (F.col(product) == "3x") & (channel != V.MUSIC)
    fact = translate(
        fact.withColumn("third_category", F.when(sports & F.coalesce(second == V.HORIZONTAL, F.lit(True)), None).otherwise(F.col("third_category"))),
        dictionary, "third_category", [Lookup(sports, "site_third", main, F.col("third_category"))],
    )
    fact = fact.withColumn("second_category", F.when(sports | kids | given, second).otherwise(F.lit("")))
    return translate(
        fact, dictionary, "second_category",
        [
            Lookup(sports, "sports_area", main, second),
            Lookup(kids, "kids_area", main, second),
            Lookup(given & by_name, "site_name", main, second),
            Lookup(given, "site_code", main, second),
        ],
    )


# --------------------------------------------------------------------- labels
def label_details(fact: DataFrame, labels: DataFrame, page: str = "pageType", detail: str = "pageDetailInfo") -> DataFrame:
    """Label of a page's tab: ``labels`` has (page, code, label).

    A tab the page has no label for keeps its code, and so does a tab without a
    page; the same code can have another label on another page.
    """
    dictionary = stack_dictionaries({"tab": Part(labels, "page", "code", "label")})
    known = F.col(page).isNotNull() & F.col(detail).isNotNull()
    return translate(fact, dictionary, detail, [Lookup(known, "tab", page, detail)], miss=F.col(detail))
