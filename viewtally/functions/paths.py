"""Navigation paths as columns.

A 3.x path is levels joined by ``-`` with fields joined by ``*``; a 2.x path is
parts joined by ``-``. All functions are built from ``split``, ``rlike`` and
``regexp_extract``, so a whole parse stays inside code generation.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V
from .scalars import column, label_of



def _null() -> Column:
    return F.lit(None).cast("string")


def _group(c: Column, pattern: str, group: int) -> Column:
    """A regex group of the first match; null without a match, '' for an empty
    group. One evaluation of the pattern, unlike a test and an extract."""
    return F.get(F.regexp_extract_all(c, F.lit(pattern), F.lit(group)), F.lit(0))


def _contains_any(c: Column, marks: Sequence[str]) -> Column:
    return c.rlike("|".join(re.escape(m) for m in marks))


def _only(c: Column, allowed: Sequence[str] | None) -> Column:
    return c if allowed is None else F.when(c.isin(list(allowed)), c)


def _any_of(words: Sequence[str]) -> str:
    return "|".join(words)


# ------------------------------------------------------------------ splitting
def path_part(path, i: int, j: int | None = None) -> Column:
    """Part ``i`` of a path, or field ``j`` of that part (both from 1).

    Out of range gives null; a path without a separator is its own part 1.
    """
    part = F.get(F.split(column(path), "-"), F.lit(i - 1))
    if j is None:
        return part
    return F.get(F.split(part, r"\*"), F.lit(j - 1))


def path_length(path) -> Column:
    return F.size(F.split(column(path), "-"))


def has_path_shape(path_3x, path_2x) -> Column:
    """Three parts in a 3.x path, or four to five in a 2.x path."""
    return F.coalesce(path_length(path_3x) == 3, F.lit(False)) | F.coalesce(
        path_length(path_2x).between(4, 5), F.lit(False)
    )


def classify_path(path, rules: Sequence[tuple[str, str | None]], default: str | None = None) -> Column:
    """Label of the first LIKE pattern that holds."""
    path = column(path)
    expr = F.when(F.lit(False), _null())
    for pattern, label in rules:
        expr = expr.when(path.like(pattern), F.lit(label))
    return expr.otherwise(F.lit(default))


# ------------------------------------------------------------------- subjects
_CODE_3X = f"(({_any_of(V.SUBJECT_CHANNELS_3X)})[0-9]+)"
_CODE_2X = "(?:" + _any_of([f"{c}\\d+" for c in V.SUBJECT_CHANNELS_2X]) + ")"
_CHANNEL_2X = "(?:" + _any_of(V.SUBJECT_CHANNELS_2X) + ")"

# Where a subject code stands in a 2.x path, most specific
# first. (pattern, groups of the codes in order, group of the source)
SUBJECT_RULES_2X: list[tuple[str, tuple[int, ...], int]] = [
    (rf"home-(hotrecommend)(?:-\d+-\d+)?-({_CODE_2X})-(actor|{_CODE_2X})", (3, 2), 1),
    (rf"home-(hotrecommend)(?:-\d+-\d+)?-({_CODE_2X})", (2,), 1),
    (rf"home-{_CHANNEL_2X}-(\w+)-({_CODE_2X})-(actor|{_CODE_2X})", (2, 3), 1),
    (rf"home-{_CHANNEL_2X}-(\w+)-({_CODE_2X})", (2,), 1),
    (rf"(thirdparty_\d)[\w\-]+-({_CODE_2X})", (2,), 1),
    (r"home-kids_home-(\w+)-(kids\d+)", (2,), 1),
    (r"home-kids_home-\w+-(\w+)-(kids\d+)", (2,), 1),
    (rf"home-(history)-[\w\-]+-({_CODE_2X})-(actor|{_CODE_2X})", (2, 3), 1),
    (rf"home-(history)-[\w\-]+-({_CODE_2X})", (2,), 1),
    (rf"home-({_CHANNEL_2X})-({_CODE_2X})", (2,), 1),
]


def subjects_2x(path) -> Column:
    """All (code, source) pairs of a 2.x path: none, one, or two."""
    path = column(path)
    none = F.expr("cast(array() as array<struct<code:string,source:string>>)")
    expr = F.when(F.lit(False), none)
    for pattern, codes, source in SUBJECT_RULES_2X:
        pairs = F.array(
            *[
                F.struct(
                    F.regexp_extract(path, pattern, g).alias("code"),
                    F.regexp_extract(path, pattern, source).alias("source"),
                )
                for g in codes
            ]
        )
        expr = expr.when(path.rlike(pattern), pairs)
    return expr.otherwise(none)


def subject_code_3x(path_special) -> Column:
    """Numbered subject of ``subject-<name>-<code>``."""
    path = column(path_special)
    return F.when(F.lower(path_part(path, 1, 1)) == "subject", _group(path, _CODE_3X, 1))


def subject_code_2x(path) -> Column:
    return F.get(subjects_2x(path), F.lit(0))["code"]


def subject_name(path_special) -> Column:
    """Name between ``subject-`` and the code, with its own dashes kept."""
    path = column(path_special)
    first_fields = F.transform(F.split(path, "-"), lambda p: F.split(p, r"\*")[0])
    count = F.size(first_fields)
    coded = path.rlike(_CODE_3X) & (count > 2)
    length = count - F.when(coded, 2).otherwise(1)
    name = F.array_join(F.slice(first_fields, F.lit(2), F.greatest(length, F.lit(0))), "-")
    return F.when((F.lower(path_part(path, 1, 1)) == "subject") & (count > 1), name)


def play_kind_3x(path_special) -> Column:
    """First field of the special path; 'subject' in any spelling."""
    kind = path_part(path_special, 1, 1)
    return F.when(F.lower(kind) == "subject", F.lit("subject")).otherwise(kind)


def play_kind_2x(path) -> Column:
    return F.when(column(path).contains("-subject-"), F.lit("subject"))


# ------------------------------------------------------------------ entrances
_ENTRANCE_3X = (
    r"(home\*classification|search|home\*my_tv\*history|home\*my_tv\*collect|home\*recommendation"
    r"|home\*hotSubject|home\*taste|home\*my_tv\*[a-zA-Z0-9&一-龥]{1,})"
)
_ENTRANCE_2X = "(classification|history|hotrecommend|search)"


def entrance_3x(path_main, product: str = "3x") -> Column:
    """Entrance label of a 3.x play."""
    path = column(path_main)
    found = F.regexp_extract(path, _ENTRANCE_3X, 1)
    other = F.when(found.startswith("home*my_tv*"), F.lit(V.ENTRANCE_CUSTOM)).otherwise(
        F.lit(V.ENTRANCE_OTHER_3X)
    )
    return F.when(path.isNull(), F.lit(V.UNKNOWN + product)).otherwise(
        label_of(found, V.ENTRANCE_3X, other)
    )


def entrance_2x(path, product: str = "2x") -> Column:
    path = column(path)
    found = F.regexp_extract(path, _ENTRANCE_2X, 1)
    return F.when(path.isNull(), F.lit(V.UNKNOWN + product)).otherwise(
        label_of(found, V.ENTRANCE_2X, V.ENTRANCE_OTHER_2X)
    )


# ------------------------------------------------------- list-page categories
def kids_levels_3x(path) -> list[Column]:
    """Kids channel: ('kids', category, tab)."""
    path = column(path)
    last = F.element_at(F.split(path, "-"), -1)
    in_parts = path.contains("-") & (path != "-")
    tab = r"([a-zA-Z0-9_]+)\*([一-龥A-Z0-9-]+)"
    search = r"^(.*)-search\*[A-Z]+$"
    before_search = F.regexp_extract(path, search, 1)
    searched = path.rlike(search) & before_search.contains("-")
    raw_tab = F.regexp_extract(path, tab, 2)
    category = (
        F.when(searched, F.substring_index(before_search, "-", -1))
        .when(path.rlike(tab), F.regexp_extract(path, tab, 1))
        .when(in_parts & last.rlike("(kids_home|kids)$"), F.lit("kids_recommend"))
    )
    third = F.when(searched, F.lit(V.KIDS_SEARCH_LABEL)).when(
        path.rlike(tab), label_of(raw_tab, V.KIDS_TAB_FIX, raw_tab)
    )
    is_kids = _contains_any(path, V.KIDS_MARKS)
    return [F.when(is_kids, F.lit("kids")), F.when(is_kids, category), F.when(is_kids, third)]


def sports_levels(path) -> list[Column]:
    """Sports channel: ('sports', area, category, tab)."""
    path = column(path)
    home = r"sports\*(recommend|newsHomePage|welfareHomePage|horizontal)(.*)"
    tree = r"sports\*(collect|League)\*([0-9a-zA-Z_]+)(.*)"
    tab = r"([a-zA-Z0-9_]+)\*([一-龥A-Z0-9]+)"

    def last_part(rest: Column) -> Column:
        return F.when(rest.contains("-"), F.element_at(F.split(rest, "-"), -1))

    home_word = F.regexp_extract(path, rf".*{home}", 1)
    home_rest = F.regexp_extract(path, rf".*{home}", 2)
    collected = (home_word == "horizontal") & home_rest.contains("collect")
    collected_tab = last_part(home_rest)
    tree_rest = last_part(F.regexp_extract(path, rf".*{tree}", 3))
    at_home, in_tree = path.rlike(home), path.rlike(tree)
    area = (
        F.when(in_tree, F.regexp_extract(path, rf".*{tree}", 1))
        .when(at_home & collected, F.lit("collect"))
        .when(at_home, F.lit("horizontal"))
    )
    category = (
        F.when(in_tree, F.regexp_extract(path, rf".*{tree}", 2))
        .when(at_home & collected, F.coalesce(_group(collected_tab, tab, 1), home_word))
        .when(at_home, home_word)
    )
    tab_name = F.coalesce(
        F.when(in_tree, _group(tree_rest, tab, 2)), F.when(at_home & collected, _group(collected_tab, tab, 2))
    )
    is_sports = path.contains("sports*")
    return [F.when(is_sports, c) for c in (F.lit("sports"), area, category, tab_name)]


def music_levels(path) -> list[Column]:
    """Music lists: ('mv', site, tab); the tab may be the empty string."""
    path = column(path)
    pattern = r".*\*(site_.*)(-mv_category|-mv_poster)\**([一-龥A-Z0-9-&]*)"
    is_music = path.contains("mv_category") | path.contains("mv_poster")
    return [
        F.when(is_music, F.lit("mv")),
        F.when(is_music, _group(path, pattern, 1)),
        F.when(is_music, _group(path, pattern, 3)),
    ]


def list_category_3x(path_main) -> Column:
    """Struct (level1, level2, level3) of the list page a 3.x path names."""
    path = column(path_main)
    pages = _any_of(V.LIST_PAGES_3X)
    start = rf"home\*(?:classification|my_tv)\*(?:{pages})-"
    kids, music, sports = kids_levels_3x(path), music_levels(path), sports_levels(path)

    def page_before(words: str) -> Column:
        # the short form also finds what the form with the full start finds
        return _group(path, rf"({pages})[-*]?(?:{words})", 1)

    retrieval, search = page_before("retrieval|筛选"), page_before("search|搜索")
    recommended = rf"home\*recommendation\*\d-({pages})\*(.*)"
    full = rf"{start}(?:{pages})\*[a-zA-Z0-9&一-龥]+"
    short = rf"(?:{pages})\*[a-zA-Z0-9&一-龥]+"

    # the full form anywhere, else the first short form; ends in page*tab
    found = F.regexp_extract(path, rf"^.*?{full}|{short}", 0)
    none = F.expr("cast(array() as array<string>)")
    # one CASE with the levels of each rule: every test and pattern is
    # evaluated once, and only for the rows its rule is for
    levels = (
        F.when(path.isNull() | _contains_any(path, V.NO_LIST_PAGE_MARKS), none)
        .when(~_contains_any(path, V.LIST_PAGE_MARKS), none)
        .when(path.contains("kids"), F.array(*kids))
        .when(path.contains("mv_category") | path.contains("mv_poster"), F.array(*music))
        .when(path.contains("sports*"), F.array(*sports[:3]))
        .when(
            path.contains("retrieval") | path.contains("筛选"),
            F.array(retrieval, F.when(retrieval.isNotNull(), F.lit(V.RETRIEVAL_LABEL))),
        )
        .when(
            path.contains("search") | path.contains("搜索"),
            F.array(search, F.when(search.isNotNull(), F.lit(V.SEARCH_LABEL))),
        )
        .when(path.contains("home*recommendation"), F.array(_group(path, recommended, 1), _group(path, recommended, 2)))
        .otherwise(F.split(F.substring_index(found, "-", -1), r"\*"))
    )
    first, second, third = (F.get(levels, F.lit(i)) for i in range(3))
    return F.struct(F.when(first != "", first).alias("level1"), second.alias("level2"), third.alias("level3"))


def list_category_2x(path) -> Column:
    """Struct (level1, level2, level3) of the list page a 2.x path names.

    The areas above the classification bar name no list page: null.
    """
    path = column(path)
    is_kids = path.contains("kids")
    place, tab = path_part(path, 2), path_part(path, 3)
    deep_tab = F.when(place.isin("kids_home", "sports"), F.concat(tab, F.lit("-"), path_part(path, 4))).otherwise(tab)
    level2 = F.when(place == "search", F.lit("")).otherwise(deep_tab)
    return F.struct(
        F.when(is_kids, F.lit("kids")).otherwise(_only(place, V.LAUNCHER_LOCATIONS_2X)).alias("level1"),
        F.when(~is_kids & tab.isNotNull() & place.isin(V.PAGES_2X), level2).alias("level2"),
        _null().alias("level3"),
    )


# ------------------------------------------------------------ music entry tabs
# Music entries by what follows each other in the path:
# (entry, second part, kind of list) -> labels; "*" is the text after '*'.
MUSIC_TABS: dict[tuple[str, str, str], tuple[str, str, str]] = {
    ("mv*mineHomePage*site_collect", "", "-mv_collection"): (V.MUSIC_ENTRY, "我的收藏", ""),
    ("mv_station", "", ""): (V.MUSIC_ENTRY, "电台", ""),
    ("mv*mvRecommendHomePage", "", ""): (V.MUSIC_ENTRY, "推荐", ""),
    ("mv*mvTopHomePage", "*xinge", ""): (V.MUSIC_ENTRY, "榜单", "新歌榜"),
    ("mv*mvTopHomePage", "*meiguogonggaopai", ""): (V.MUSIC_ENTRY, "榜单", "美国公告榜"),
    ("mv*mvTopHomePage", "*rege", ""): (V.MUSIC_ENTRY, "榜单", "热歌榜"),
    ("mv*mvTopHomePage", "*biaoshen", ""): (V.MUSIC_ENTRY, "榜单", "飙升榜"),
    ("mv*mvTopHomePage", "*site_mvtop", "-mv_poster"): (V.MUSIC_ENTRY, "榜单", "更多榜单"),
    ("mv-search", "", ""): (V.MUSIC_ENTRY, "音乐搜索", ""),
    ("mv*function*site_hotsinger", "", ""): (V.MUSIC_ENTRY, "热门歌手", ""),
    ("mv*function*site_concert", "", "-mv_category"): (V.MUSIC_ENTRY, "演唱会", "*"),
    ("mv*function*site_dance", "", "-mv_category"): (V.MUSIC_ENTRY, "舞蹈", "*"),
    ("mv*function*site_mvsubject", "", "-mv_poster"): (V.MUSIC_ENTRY, "精选集", ""),
    ("mv*mvCategoryHomePage", "*site_mvstyle", "-mv_category"): (V.MUSIC_CATEGORY, "风格", "*"),
    ("mv*mvCategoryHomePage", "*site_mvyear", "-mv_category"): (V.MUSIC_CATEGORY, "年代", "*"),
    ("mv*mvCategoryHomePage", "*site_mvarea", "-mv_category"): (V.MUSIC_CATEGORY, "地区", "*"),
}
_MUSIC_ENTRIES = dict.fromkeys(e for e, _, _ in MUSIC_TABS if e not in ("mv_station", "mv*mvRecommendHomePage"))
_MUSIC_SECONDS = dict.fromkeys(s for _, s, _ in MUSIC_TABS if s)
# the two recommendation forms come first: a station is also a recommendation
_MUSIC_PATTERN = (
    r"(mv\*mvRecommendHomePage\*.+-mv_station|mv\*mvRecommendHomePage\*[a-zA-Z0-9]+|"
    + "|".join(re.escape(e) for e in _MUSIC_ENTRIES)
    + ")("
    + "|".join(re.escape(s) for s in _MUSIC_SECONDS)
    + r")?(-mv_category\*[a-zA-Z0-9&一-龥]+|-mv_poster|-mv_collection)?"
)


def _tab_labels(entry, tab, item) -> Column:
    return F.struct(F.lit(entry).alias("entry"), F.lit(tab).alias("tab"), F.lit(item).alias("item"))


def music_tabs(path) -> Column:
    """Struct (entry, tab, item) of a music path; '' where nothing matches."""
    path = column(path)
    labels = F.create_map(*[x for parts, names in MUSIC_TABS.items() for x in (F.lit("".join(parts)), _tab_labels(*names))])

    def labelled(part: Column) -> Column:
        entry = F.when(part["first"].endswith("-mv_station"), F.lit("mv_station")).otherwise(
            F.regexp_replace(part["first"], r"(mv\*mvRecommendHomePage)\*.*", "$1")
        )
        # most specific first: with the list, without it, the entry alone
        spellings = [F.concat(entry, part["second"], F.substring_index(part["third"], "*", 1)), F.concat(entry, part["second"]), entry]
        found = F.coalesce(*[F.try_element_at(labels, text) for text in spellings], _tab_labels("", "", ""))
        return F.struct(found.alias("found"), F.substring_index(part["third"], "*", -1).alias("listed"))

    # an array of one holds the groups of the pattern, so that each is extracted once
    groups = F.struct(*[F.regexp_extract(path, _MUSIC_PATTERN, g).alias(name) for g, name in enumerate(("first", "second", "third"), start=1)])
    named = F.transform(
        F.transform(F.array(groups), labelled),
        lambda x: F.struct(
            x["found"]["entry"].alias("entry"), x["found"]["tab"].alias("tab"),
            F.when(x["found"]["item"] == "*", x["listed"]).otherwise(x["found"]["item"]).alias("item"),
        ),
    )
    return F.when(path.contains("mv"), F.get(named, F.lit(0))).otherwise(_tab_labels("", "", ""))


def music_home_location(path_main) -> Column:
    """Struct (page, area, location) on the music home page.

    A location with digits names an item, not a place: only its text before
    ``_`` is kept, or null. All three are '' when the path names no place.
    """
    path = F.regexp_replace(column(path_main), "mv-search", "mv*function*search")
    home = F.get(F.filter(F.split(path, "-"), lambda p: p.contains("mv*")), F.lit(0))
    fields = F.split(home, r"\*")
    placed = F.coalesce(F.size(fields) > 2, F.lit(False)) & home.isNotNull()
    place = F.get(fields, F.lit(2))
    location = (
        F.when(place.rlike(r"\d") & place.contains("_"), F.split(place, "_")[0])
        .when(place.rlike(r"\d"), _null())
        .otherwise(place)
    )
    return F.struct(
        F.when(placed, F.lit("mv")).otherwise("").alias("page"),
        F.when(placed, F.get(fields, F.lit(1))).otherwise("").alias("area"),
        F.when(placed, location).otherwise("").alias("location"),
    )


# ----------------------------------------------------------- search, retrieval
def search_keyword_2x(path) -> Column:
    return _group(column(path), r".*-search-([0-9A-Za-z]+)", 1)


def search_origin_2x(path) -> Column:
    path = column(path)
    return F.when(path.rlike("-search-"), path_part(path, 2))


_FILTER_3X = r"retrieval\*(hot|new|score)\*(\S+?)\*(\S+?)\*(all|qita|[0-9]+[*0-9]*)"
_FILTER_2X = r"multi_search-(hot|new|score)-(\S+?)-(\S+?)-(all|qita|[0-9]+[-0-9]*)"


def retrieval_filter(path_3x, path_2x) -> Column:
    """Struct (sort, tag, area, year) chosen on a retrieval page."""
    three, two = column(path_3x), column(path_2x)
    names = ("sort", "tag", "area", "year")
    return F.struct(
        *[
            F.coalesce(_group(three, _FILTER_3X, g), _group(two, _FILTER_2X, g)).alias(name)
            for g, name in enumerate(names, start=1)
        ]
    )


def enter_way(path_main) -> Column:
    """Struct (way, area, location, page, tab): how a page was reached."""
    path = column(path_main)
    return F.struct(
        path_part(path, 1, 1).alias("way"),
        path_part(path, 1, 2).alias("area"),
        path_part(path, 1, 3).alias("location"),
        path_part(path, 2, 1).alias("page"),
        path_part(path, 2, 2).alias("tab"),
    )


# --------------------------------------------------------------- page columns
def page_columns_3x(path_main, path_sub, path_special, page_details: Sequence[str] | None = None) -> Column:
    """All page columns of a 3.x row as one struct; values outside the lists
    are null. ``page_details`` is the list of known tabs (None: any tab)."""
    main, sub, special = column(path_main), column(path_sub), column(path_special)
    area, place = path_part(main, 1, 2), path_part(main, 1, 3)
    page, tab = path_part(main, 2, 1), path_part(main, 2, 2)
    third = path_part(main, 3, 1)
    access = _only(path_part(sub, 1, 1), V.SUB_PATHS)
    kind = _only(path_part(special, 1, 1), V.SPECIAL_PROPERTIES)
    kids_mark = path_part(main, 3, 2)
    kids_search = (kids_mark.isNull() & (path_part(main, 4, 1) == "search")) | (kids_mark == V.KIDS_SEARCH_LABEL)
    detail = (
        F.when(tab.isNotNull(), _only(tab, page_details))
        .when(third.isin("search", "retrieval"), third)
        .when((page == "kids_home") & kids_search, F.lit(V.KIDS_SEARCH_LABEL))
        .when(page == "kids_home", _only(path_part(main, 3), page_details))
    )
    rest = F.transform(
        F.slice(F.split(special, "-"), F.lit(2), F.greatest(path_length(special) - 1, F.lit(0))),
        lambda p: F.split(p, r"\*")[0],
    )
    return F.struct(
        F.when(area.isNull() & page.isin(V.NAVI_2X), F.lit("navi"))
        .otherwise(_only(area, V.LAUNCHER_AREAS_3X))
        .alias("launcherArea"),
        F.when(place.isNull() & page.isin(V.NAVI_2X), page)
        .when(F.coalesce(area, F.lit("")) != "live", _only(place, V.LAUNCHER_LOCATIONS_3X))
        .alias("launcherAccessLocation"),
        _only(page, V.PAGES_3X).alias("pageType"),
        detail.alias("pageDetailInfo"),
        access.alias("accessPath"),
        F.when(access.isNotNull(), path_part(sub, 3, 1)).alias("previousSid"),
        F.when(access.isNotNull(), path_part(sub, 3, 2)).alias("previousContentType"),
        kind.alias("pathProperty"),
        F.when(kind.isNotNull() & (F.size(rest) > 0), F.array_join(rest, "-")).alias("pathIdentification"),
    )


def page_columns_2x(path, page_details: Sequence[str] | None = None) -> Column:
    """The same columns from a 2.x path, which must have at least two parts."""
    path = column(path)
    in_parts = path.contains("-")
    place, tab = path_part(path, 2), path_part(path, 3)
    last = F.element_at(F.split(path, "-"), -1)
    area = (
        F.when(place.isin(V.UPPER_PART_2X), place)
        .when(place.isin(V.NAVI_2X), F.lit("navi"))
        .when(place.isin(V.CLASSIFICATION_2X), F.lit("classification"))
        .otherwise(place)
    )
    location = F.when(place == "hotrecommend", tab).otherwise(_only(place, V.LAUNCHER_LOCATIONS_2X))
    deep_tab = F.when(place.isin("kids_home", "sports"), F.concat_ws("-", tab, path_part(path, 4))).otherwise(tab)
    kind = (
        F.when(path.contains("-tag-"), F.lit("tag"))
        .when(path.contains("-subject-"), F.lit("subject"))
        .when(path.contains("-actor-"), F.lit("star"))
    )
    outs = {
        "launcherArea": area,
        "launcherAccessLocation": location,
        "pageType": _only(place, V.PAGES_2X),
        "pageDetailInfo": F.when(place != "search", _only(deep_tab, page_details)),
        "accessPath": _only(last, V.SUB_PATHS),
        "previousSid": _null(),
        "previousContentType": _null(),
        "pathProperty": kind,
        "pathIdentification": subject_code_2x(path),
    }
    return F.struct(*[F.when(in_parts, c).alias(name) for name, c in outs.items()])


def content_type_2x(path) -> Column:
    """Content type of a 2.x channel visit: the second part."""
    return path_part(path, 2)


# ------------------------------------------------------------- launcher labels
def launcher_area_label(area, product) -> Column:
    area, product = column(area), column(product)
    return F.when(
        area.isNotNull(),
        F.when(product == "3x", label_of(area, V.LAUNCHER_AREA_LABELS_3X, V.OTHER)).when(
            product == "2x", label_of(area, V.LAUNCHER_AREA_LABELS_2X, V.OTHER)
        ),
    )


def _position_label(number: Column) -> Column:
    known = number.between(1, V.LAUNCHER_POSITIONS)
    return F.when(known, F.concat(F.lit("第"), number.cast("string"), F.lit("个位置"))).otherwise(
        F.lit(V.OTHER_POSITION)
    )


def launcher_position_label(index) -> Column:
    """Label of a position counted from 1."""
    return _position_label(column(index).try_cast("int"))


def channel_label(content_type) -> Column:
    """Label of a channel; anything else, null too, is unknown."""
    return label_of(content_type, V.CHANNEL_LABELS, V.CHANNEL_UNKNOWN)


def launcher_location_label_3x(location) -> Column:
    """Label of a location; only the channels are also spelled with ``site_``."""
    location = column(location)
    plain = F.regexp_replace(location, "^site_", "")
    known = (plain == location) | plain.isin(V.LAUNCHER_SITE_LOCATIONS_3X)
    label = label_of(F.when(known, plain).otherwise(location), V.LAUNCHER_LOCATION_LABELS_3X, V.OTHER)
    return F.when(location.isNotNull(), label)


def launcher_location_label_2x(area, location) -> Column:
    """2.x positions count from 0; area 5 is the classification bar."""
    area, location = column(area), column(location)
    number = location.try_cast("int")
    bar = label_of(
        location, {str(i): name for i, name in enumerate(V.CLASSIFICATION_POSITIONS_2X)},
        _position_label(number + 1),
    )
    return F.when(
        area.isNotNull() & location.isNotNull(), F.when(area == "5", bar).otherwise(_position_label(number + 1))
    )
