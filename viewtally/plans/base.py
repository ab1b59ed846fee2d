"""Small reports that show one operator or a group of functions each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import network as N
from ..functions import paths as P
from ..functions import periods as D
from ..functions import scalars as S
from ..operators.counts import funnel_join, pv_uv, sum_of, users_where
from ..operators.distributions import event_gaps
from ..operators.enrich import dim_enrich, geo_enrich, mac_brand_enrich, network_enrich
from ..operators.facts import surrogate_exchange
from ..operators.quality import blacklist_filter, flood_filter
from ..operators.rankings import topn_per_group
from ..operators.reconcile import reconcile, reconcile_counts
from ..sources.access_log import parse_access_log, split_ids
from ..sources.merge import merge_sources, project_whitelist
from .registry import report


# ------------------------------------------------------------------- sources
@report("project_whitelist", "SRC11", "F16")
def project(t):
    wanted = {"userId": "string", "duration": "bigint", "apkVersion": "int", "groupId": "string", "day": "date"}
    cut = project_whitelist(t.play3, wanted)
    return cut.groupBy("day").agg(
        F.count("userId").alias("users"), F.sum("duration").alias("duration"),
        F.count("apkVersion").alias("readable_versions"), F.count("groupId").alias("groups"),
    )


@report("merge_two_products", "S1", "S2", "SRC10")
def merge_two(t):
    merged = merge_sources([(t.play3.drop("template"), "3x"), (t.play2.drop("template"), "2x")])
    return merged.groupBy("flag", "event", "contentType").agg(
        F.count(F.lit(1)).alias("n"), F.count("pathMain").alias("main_paths"), F.count("path").alias("paths")
    )


@report("scan_log_days", "SRC1", "SRC2", "SRC3", "SRC4", "F14")
def scan_days(t):
    log = t.login.where(F.col("day").between(F.lit("2024-01-03").cast("date"), F.lit("2024-01-09").cast("date")))
    log = log.where(~F.col("log_type").isin("error", "signup"))
    return pv_uv(log, ["day", "log_type"])


@report("id_bounds", "FN16")
def bounds(t):
    from ..sources.logs import id_bounds

    return id_bounds(t.account)


# ------------------------------------------------------------------- filters
@report("channels_normalized", "F6")
def channels_normalized(t):
    return pv_uv(t.login, [S.normalize_key("promotionChannel", r"^\w+$").alias("channel")], null_user="count")


@report("key_guards", "F7", "U51")
def key_guards(t):
    texts = t.documents.select(
        S.has_non_ascii("text").alias("non_ascii"), S.fits("text", 500).alias("is_short"),
        F.length(S.strip_invalid("source")).alias("source_length"),
    )
    return texts.groupBy("non_ascii", "is_short", "source_length").agg(F.count(F.lit(1)).alias("n"))


@report("white_channels", "F8")
def white_channels(t):
    kept = blacklist_filter(
        t.login, "promotionChannel", black=["ch3", "ch4", "ch5"], white=["ch4"], pattern=r"^\w+$"
    )
    return pv_uv(kept, ["promotionChannel"])


@report("white_versions", "F9")
def white_versions(t):
    kept = blacklist_filter(
        t.login, "version", black=["Box_TVApp3.0_X_3.1.2"], pattern=r"^Box_[\w.]+_\d{1,3}\.\d{1,3}\.\d{1,3}(\.\d{1,3})?$"
    )
    return pv_uv(kept, [S.apk_version("version").alias("version")], null_user="count")


@report("without_test_devices", "F10")
def without_test_devices(t):
    testers = t.account.where(F.col("userType") == 3).select("mac")
    return pv_uv(blacklist_filter(t.login, "mac", testers), ["day"])


@report("version_bands", "F11", "F12")
def version_bands(t):
    version = S.apk_version("version")
    log = t.login.select("userId", version.alias("v"))
    return pv_uv(
        log,
        [
            S.version_band("v", ["3.1.4", "3.1.5", "3.1.6"], oldest="3.1.4").alias("band"),
            S.version_at_least("v", "3.1.4").alias("since_text"),
            S.version_at_least("v", "3.1.4", numeric=True).alias("since_number"),
        ],
        null_user="count",
    )


@report("plays_of_path_shape", "F15", "F4")
def path_shape(t):
    return pv_uv(t.play, ["flag", "event"], where=P.has_path_shape("pathMain", "path"))


@report("flood_filter", "M19", "A8", "J7", "J8")
def without_floods(t):
    calm = flood_filter(t.login.select("userId", "k", "day", "log_type"), ["userId", "k"], limit=3)
    return pv_uv(calm, ["day"], null_user="count")


# --------------------------------------------------------------------- joins
@report("play_titles", "J2", "J3", "J4", "A11", "U40")
def play_titles(t):
    named = dim_enrich(t.play, t.program, {"videoSid": "sid"}, {"title": "title"}, default=F.col("videoSid"))
    return pv_uv(named, ["title"])


@report("users_by_network", "J14", "U20", "F5", "SRC5")
def users_by_network(t):
    placed = network_enrich(
        t.login, t.location, "ip", {"country": "country", "province": "province"}, default=None
    )
    area = F.when(F.col("country") == "中国", F.col("province")).otherwise(F.lit("国外及其他"))
    return pv_uv(placed, [area.alias("area")], null_user="count")


@report("users_by_ip_range", "J15", "U21", "SRC12")
def users_by_ip_range(t):
    placed = geo_enrich(t.login, "ip", t.ip_range, t.ip_prefix)
    return pv_uv(placed, ["country", "province", "city"], null_user="count")


@report("padded_ips", "U22", "U23")
def padded_ips(t):
    ips = t.login.where(F.col("ip") != "x.y").select(N.client_ip(F.concat("ip", F.lit(", 10.0.0.1")), F.lit("1.1.1.1")).alias("ip"))
    return ips.groupBy(N.padded_ip("ip").alias("padded"), N.ip_number("ip").alias("number")).agg(F.count(F.lit(1)).alias("n"))


@report("brand_of_mac", "U36")
def brand_of_mac(t):
    branded = mac_brand_enrich(t.login, t.mac_brand, "mac", default="none")
    return pv_uv(branded, ["brand"], null_user="count")


@report("entrance_by_two_or_three_keys", "J17")
def entrance_keys(t):
    visits = t.visit.select(
        "userId", "contentType", F.when(F.col("event") == "enter", F.col("subjectCode")).alias("code"),
    )
    known = t.visit.groupBy("contentType", F.when(F.col("event") == "enter", F.col("subjectCode")).alias("code")).agg(
        F.max("videoSid").alias("best")
    )
    joined = dim_enrich(visits, known, ["contentType", "code"], {"best": "best"}, null_safe=["code"])
    return pv_uv(joined, ["best"])


# -------------------------------------------------------------- aggregations
@report("duration_totals", "A15", "G4", "G8")
def duration_totals(t):
    return sum_of(t.home, "duration", ["day"], name="duration")


@report("conditional_users", "A12")
def conditional_users(t):
    return users_where(
        t.play, ["contentType"], {"all_users": F.lit(True), "new_version": F.col("apkVersion") >= "3.1.4"},
        rows={"starts": F.col("event") == "startplay"},
    )


@report("distinct_users", "A10")
def distinct_users(t):
    return t.login.select("day", "productModel").distinct()


@report("gaps_between_events", "W6", "D14", "U52")
def gaps(t):
    between = event_gaps(t.login, ["userId", "k"], "datetime")
    return between.groupBy("userId", "k").agg(
        F.sum("times").alias("gaps"), F.min("gap_seconds").alias("shortest"),
        F.max("gap_seconds").alias("longest"), F.sum(F.col("gap_seconds") * F.col("times")).alias("span"),
    )


@report("largest_user_counts", "W7", "W3")
def largest(t):
    counted = pv_uv(t.play, ["videoSid"])
    return topn_per_group(counted, [], "uv", 20, tie_break=["videoSid"])


@report("reconcile_two_results", "S6")
def reconcile_two(t):
    a = pv_uv(t.play3, ["contentType"])
    b = pv_uv(t.play3, ["contentType"], where=F.col("duration").isNull() | (F.col("contentType") != "tv"))
    return reconcile(a, b)


@report("reconcile_days", "S6")
def reconcile_days(t):
    return reconcile_counts(t.play3, t.play2, ["day", "contentType"])


# ----------------------------------------------------------- scalar functions
@report("paths_3x", "U1", "U3", "U4", "U6", "U7", "U8", "U9", "U11", "U12", "U13", "U14", "U15", "U16")
def paths_3x(t):
    c = P.list_category_3x("pathMain")
    parsed = t.play3.select(
        "template", P.entrance_3x("pathMain").alias("entrance"), c["level1"].alias("level1"), c["level2"].alias("level2"),
        c["level3"].alias("level3"), P.music_tabs("pathMain").alias("m"), P.music_home_location("pathMain").alias("h"),
        P.path_part("pathMain", 1, 3).alias("place"), P.path_part("pathMain", 2, 1).alias("page"),
    )
    return parsed.groupBy(
        "template", "entrance", "level1", "level2", "level3", "place", "page",
        F.col("m.entry").alias("music_entry"), F.col("m.tab").alias("music_tab"), F.col("m.item").alias("music_item"),
        F.col("h.area").alias("home_area"), F.col("h.location").alias("home_location"),
    ).agg(F.count(F.lit(1)).alias("n"))


@report("page_columns_3x", "U3")
def pages_3x(t):
    page = P.page_columns_3x("pathMain", "pathSub", "pathSpecial")
    return t.play3.select("template", page.alias("p")).select("template", "p.*").groupBy(
        "template", "launcherArea", "launcherAccessLocation", "pageType", "pageDetailInfo", "accessPath",
        "previousContentType", "pathProperty",
    ).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("previousSid").alias("sids"), F.count_distinct("pathIdentification").alias("identifications"))


@report("subjects_3x", "U4", "U6", "U7")
def subjects_3x(t):
    return t.play3.groupBy(
        P.subject_code_3x("pathSpecial").alias("code"), P.subject_name("pathSpecial").alias("name"),
        P.play_kind_3x("pathSpecial").alias("kind"),
    ).agg(F.count(F.lit(1)).alias("n"))


@report("paths_2x", "U2", "U5", "U8", "U10", "U11", "U17")
def paths_2x(t):
    c = P.list_category_2x("path")
    return t.play2.groupBy(
        "template", P.entrance_2x("path").alias("entrance"), c["level1"].alias("level1"), c["level2"].alias("level2"),
        P.search_keyword_2x("path").alias("keyword"), P.search_origin_2x("path").alias("origin"),
        P.path_part("path", 2).alias("place"),
    ).agg(F.count(F.lit(1)).alias("n"))


@report("page_columns_2x", "U3")
def pages_2x(t):
    page = P.page_columns_2x("path")
    return t.play2.select("template", page.alias("p")).select("template", "p.*").groupBy(
        "template", "launcherArea", "launcherAccessLocation", "pageType", "pageDetailInfo", "accessPath", "pathProperty",
    ).agg(F.count(F.lit(1)).alias("n"), F.count("pathIdentification").alias("identified"))


@report("subject_pairs_2x", "U5")
def subject_pairs(t):
    pairs = t.play2.select("userId", F.explode(P.subjects_2x("path")).alias("s")).select("userId", "s.*")
    return pv_uv(pairs, ["code", "source"])


@report("retrieval_filters", "U18", "U19")
def retrieval_filters(t):
    chosen = t.play.select("userId", P.retrieval_filter("pathMain", "path").alias("f")).select("userId", "f.*")
    return pv_uv(chosen, ["sort", "tag", "area", "year"])


@report("launcher_labels", "U41", "U42")
def launcher_labels(t):
    three = t.home.select(
        "userId", P.launcher_area_label("accessArea", F.lit("3x")).alias("area"),
        P.launcher_location_label_3x("accessLocation").alias("location"), P.launcher_position_label("locationIndex").alias("position"),
    )
    two = t.home.select(
        "userId", P.launcher_area_label("locationIndex", F.lit("2x")).alias("area"),
        P.launcher_location_label_2x(F.when(F.col("userId").endswith("1"), "5").otherwise("4"), "locationIndex").alias("location"),
        F.lit("-").alias("position"),
    )
    return pv_uv(three.unionByName(two), ["area", "location", "position"])


@report("version_parts", "U25", "U26")
def version_parts(t):
    return pv_uv(
        t.login, [S.apk_version("version").alias("version"), S.series_part("version").alias("series"),
                  S.major_version(F.nullif(S.apk_version("version"), F.lit("null"))).alias("major")], null_user="count",
    )


@report("duration_units", "U27")
def duration_units(t):
    return t.visit.where(F.col("duration").isNotNull()).groupBy(
        S.duration_in("duration", "q").alias("quarters"), S.duration_in(F.col("duration") * 4, "h").alias("hours"),
    ).agg(F.count(F.lit(1)).alias("n"))


@report("scalar_functions", *[f"FN{i}" for i in range(1, 16)], "U32", "U33", "U47", "U49")
def scalars(t):
    log = t.login.withColumn("datetime", F.date_trunc("second", "datetime"))
    return log.select(
        F.trim(F.concat(F.lit(" "), "productModel", F.lit(" "))).alias("trimmed"),
        F.concat("mac", F.lit("/"), "log_type").alias("joined"),
        F.substring("mac", 1, 6).alias("prefix"), F.length("mac").alias("mac_length"),
        F.round(F.col("duration") / 7, 2).alias("rounded"), F.col("k").cast("string").alias("k_text"),
        F.when(F.col("k").between(10, 20), "mid").when(F.col("mac").like("001A9A%"), "a").otherwise("other").alias("kind"),
        F.coalesce("userId", F.lit("null")).alias("user_or_null"), F.col("wifiMac").isNull().alias("no_wifi"),
        F.datediff("day", F.lit("2023-12-25").cast("date")).alias("days"), F.to_date("datetime").alias("as_date"),
        S.hour_of("datetime").alias("hour"), F.minute("datetime").alias("minute"), F.year("day").alias("year"), F.month("day").alias("month"),
        F.unix_timestamp("datetime").alias("seconds"), F.timestamp_seconds(F.unix_timestamp("datetime")).alias("back"),
        S.event_alias(F.when(F.col("k") % 3 == 0, "up").when(F.col("k") % 3 == 1, "down").otherwise("x")).alias("thumb"),
        S.floor_minute("datetime").alias("minute_floor"), S.ceil_minute("datetime").alias("minute_ceil"),
    )


@report("period_labels", "U48", "B8")
def period_labels(t):
    days = t.play.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    span = days.withColumn("in_week", F.size(D.period_range(D.period_start("day", "week"), D.period_end("day", "week"))))
    return span.select(
        "day", "n", *[D.period_label("day", p).alias(p) for p in D.PERIODS if p != "day"], "in_week",
        D.is_period_close("day", "week").alias("closes_week"), D.is_period_close("day", "month").alias("closes_month"),
    )


@report("search_clicks_by_map_key", "U45")
def map_lookup(t):
    mapped = t.search.withColumn("params", F.create_map(F.lit("resultSid"), "resultSid", F.lit("resultName"), "resultName"))
    return pv_uv(mapped, [F.col("params")["resultSid"].alias("sid"), F.col("params")["nothing"].alias("missing")])


@report("access_log_records", "M25", "SRC9", "U49")
def access_log(t):
    rows = parse_access_log(t.access, keep=("page_id",))
    return rows.select(
        "page_id", "ip", "datetime", "day", "logType", "userId", "duration", "accountId",
        F.col("params")["productModel"].alias("productModel"), F.col("params")["corruptKey"].alias("corrupt"),
    )


@report("split_user_ids", "U35")
def ids(t):
    text = F.when(F.col("k") % 3 == 0, F.col("mac")).when(
        F.col("k") % 3 == 1, F.concat_ws("-", "mac", F.lit("7"))
    ).otherwise(F.concat_ws("-", "mac", F.lit(""), F.col("k").cast("string")))
    split = t.login.select(split_ids(text).alias("i")).select("i.*")
    return split.groupBy("accountId", "groupId").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("userId").alias("users"))


@report("surrogate_keys", "M22", "U50", "J6")
def surrogates(t):
    narrow, dicts = surrogate_exchange(
        t.play.select("userId", "videoSid", "contentType", "entryType", "second_category", "flag"),
        {"entry_sk": ["entryType", "second_category"]},
        [(t.program, {"videoSid": "sid"}, "program_sk", "program_sk", F.col("contentType") != "game")],
    )
    named = narrow.join(dicts["entry_sk"], "entry_sk")
    return named.groupBy("flag", "entryType", "second_category").agg(
        F.count(F.lit(1)).alias("n"), F.count("program_sk").alias("known"), F.sum("program_sk").alias("sk_sum"),
        F.count_distinct("entry_sk").alias("keys"),
    )


@report("surrogate_dictionary", "M22", "U50")
def surrogate_dictionary(t):
    _, dicts = surrogate_exchange(t.play, {"path_sk": ["flag", "entryType", "main_category"]})
    return dicts["path_sk"]


@report("presence_by_product", "J11", "J12", "J13")
def presence(t):
    parts = [
        pv_uv(t.play, ["productModel"]).select("productModel", F.col("uv").alias("players")),
        pv_uv(t.login, ["productModel"]).select("productModel", F.col("uv").alias("logins")),
    ]
    return funnel_join(parts, ["productModel"], how="full")


@report("province_names", "U24")
def province_names(t):
    """Cut and foreign names; the stand-in takes them from the nation number."""
    raw = F.when(F.col("n_nationkey") == 0, "黑龙").when(F.col("n_nationkey") == 1, "内蒙").when(F.col("n_nationkey") == 2, "北京").when(
        F.col("n_nationkey") > 3, F.col("n_name")
    )
    fixed = N.full_province(raw)
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return people.groupBy(fixed.alias("province"), N.home_province(fixed).alias("area")).agg(F.count(F.lit(1)).alias("n"))
