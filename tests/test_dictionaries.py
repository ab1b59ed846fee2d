"""Codes to names, and the categories of the play fact, on written-out cases."""

from pyspark.sql import functions as F

from viewtally.operators.dictionaries import Lookup, Part, category_dictionary, label_details, name_categories, stack_dictionaries, translate


def test_one_current_value_per_key(spark):
    frame = spark.createDataFrame(
        [("p", "a", "one", None), ("p", "a", "two", None), ("p", "a", "zoo", "2023"), ("q", "a", "q", None), (None, "a", "x", None), ("p", None, "x", None), ("p", "b", None, None)],
        "parent string, code string, name string, dim_invalid_time string",
    )
    both = stack_dictionaries({"d": Part(frame, "parent", "code", "name"), "e": Part(frame, F.lit("all"), "code", "name", F.col("parent") == "q")})
    assert sorted(tuple(r) for r in both.collect()) == [("d", "p", "a", "two"), ("d", "q", "a", "q"), ("e", "all", "a", "q")]
    empty = stack_dictionaries({"d": Part(frame.limit(0), "parent", "code", "name")})
    assert empty.count() == 0


def test_first_lookup_answers_alone(spark):
    dictionary = spark.createDataFrame([("d", "p", "a", "A"), ("e", "p", "a", "other"), ("e", "p", "z", "Z")], "dictionary string, parent string, code string, value string")
    fact = spark.createDataFrame(
        [(1, "p", "a", "z"), (2, "p", None, "z"), (3, "q", "a", "z"), (4, None, "a", "z"), (5, "r", "a", "z")], "id int, parent string, code string, `extra.code` string",
    )
    lookups = [Lookup(F.col("parent").isin("p", "q"), "d", "parent", "code"), Lookup(F.col("parent") != "r", "e", F.lit("p"), "`extra.code`")]
    got = translate(fact, dictionary, "code", lookups)
    assert got.columns == fact.columns
    assert {r["id"]: r["code"] for r in got.collect()} == {1: "A", 2: None, 3: None, 4: "a", 5: "a"}
    kept = translate(fact, dictionary, "code", lookups, miss=F.col("code"))
    assert {r["id"]: r["code"] for r in kept.collect()} == {1: "A", 2: None, 3: "a", 4: "a", 5: "a"}
    assert translate(fact.limit(0), dictionary, "code", lookups).count() == 0


def test_categories_channel_by_channel(spark):
    sites = spark.createDataFrame(
        [
            ("movie", "site_movie", "m1", "hot films", None, None), ("movie", "site_movie", "m1", "a smaller name", None, None),
            ("movie", "site_other", "m2", "not listed", None, None), ("mv", "mv_site", "style", "styles", None, None),
            ("sports", "site_sport", None, None, "cup", "the cup"),
        ],
        "site_content_type string, main_category_code string, second_category_code string, second_category string, third_category_code string, third_category string",
    )
    entrances = spark.createDataFrame([("sports", "league", "leagues"), ("x", "league", "zzz"), ("kids", "prog", "cartoons"), ("kids", "gone", "null")], "page_code string, area_code string, area_name string")
    programs = spark.createDataFrame([("kids_anim", "prog"), ("kids_old", "gone"), ("kids_lost", "nowhere")], "path_code string, program_code string")
    cases = [
        # flag, main, second, third -> second, third
        ("3x", "movie", "hot films", "t", "hot films", "t"), ("3x", "movie", "m1", None, None, None), ("3x", "movie", "a smaller name", None, None, None),
        ("2x", "movie", "m1", None, "hot films", None), ("2x", "movie", "m2", None, None, None), ("2x", "movie", "hot films", None, None, None),
        ("3x", "mv", "style", "POP", "styles", "POP"), ("3x", "mv", "styles", None, None, None), ("3x", "movie", "", None, "", None),
        ("3x", None, None, None, "", None), ("2x", None, "m1", None, None, None), ("3x", "sports", "league", "cup", "leagues", "the cup"),
        ("3x", "sports", "horizontal", "cup", None, None), ("3x", "sports", None, "cup", None, None), ("2x", "sports", "x", "x", None, None),
        ("3x", "kids", "kids_anim", "A", "cartoons", "A"), ("2x", "kids", "kids_old", None, "", None), ("3x", "kids", "kids_lost", None, None, None),
        ("3x", "kids", None, "B", None, "B"),
    ]
    fact = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(cases)], "id int, flag string, main_category string, second_category string, third_category string")
    got = name_categories(fact, category_dictionary(sites, entrances, programs))
    assert got.columns == fact.columns
    assert {r["id"]: (r["second_category"], r["third_category"]) for r in got.collect()} == {i: c[4:] for i, c in enumerate(cases)}


def test_one_code_has_a_label_on_each_page(spark):
    labels = spark.createDataFrame([("movie", "collect", "saved"), ("history", "collect", "saved shows")], "page string, code string, label string")
    rows = spark.createDataFrame([("movie", "collect"), ("history", "collect"), ("tv", "collect"), (None, "collect"), ("movie", None)], "pageType string, pageDetailInfo string")
    got = label_details(rows, labels)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("movie", "saved"), ("history", "saved shows"), ("tv", "collect"), (None, "collect"), ("movie", None)], key=str
    )
