from .core import EXTRA, check, current, one_per_key, pv_uv, pv_uv_null, side_by_side

check("project_whitelist", """SELECT CAST(day AS VARCHAR) AS day, count(userId) AS users, CAST(sum(duration) AS BIGINT) AS duration,
  count(TRY_CAST(apkVersion AS INT)) AS readable_versions, 0 AS groups FROM play3 GROUP BY 1""")
check("merge_two_products", """SELECT '3x' AS flag, event, contentType, count(*) AS n, count(pathMain) AS main_paths, 0 AS paths FROM play3 GROUP BY 2, 3
UNION ALL SELECT '2x', event, contentType, count(*), 0, count(path) FROM play2 GROUP BY 2, 3""")
check("scan_log_days", pv_uv("login", ["day", "log_type"], "day BETWEEN DATE '2024-01-03' AND DATE '2024-01-09' AND log_type NOT IN ('error', 'signup')"))
check("id_bounds", "SELECT min(p_partkey) AS min_id, max(p_partkey) AS max_id FROM part")

NORMAL = "CASE WHEN promotionChannel IS NULL THEN 'null' WHEN promotionChannel = '' THEN 'kong' WHEN promotionChannel LIKE '%-%' THEN 'corrupt' ELSE promotionChannel END"
check("channels_normalized", pv_uv_null("login", [f"{NORMAL} AS channel"]))
check("key_guards", r"""SELECT regexp_matches(text, '[^\x00-\x7F]') AS non_ascii, length(text) <= 500 AS is_short,
  length(regexp_replace(source, '[^A-Za-z0-9_.:-]', '', 'g')) AS source_length, count(*) AS n FROM documents GROUP BY 1, 2, 3""")
check("white_channels", pv_uv("login", ["promotionChannel"], "promotionChannel IS NULL OR promotionChannel = '' OR (promotionChannel NOT LIKE '%-%' AND promotionChannel NOT IN ('ch3', 'ch5'))"))
VERSION = "CASE WHEN version IS NULL THEN 'null' WHEN version = '' THEN 'kong' ELSE list_last(string_split(version, '_')) END"
check("white_versions", pv_uv_null("login", [f"{VERSION} AS version"], "version IS NULL OR version <> 'Box_TVApp3.0_X_3.1.2'"))
check("without_test_devices", pv_uv("login", ["day"], "mac NOT IN (SELECT mac FROM account WHERE userType = 3)"))
check("version_bands", pv_uv_null(f"(SELECT userId, {VERSION} AS v FROM login)", [
    "CASE WHEN v IN ('3.1.4', '3.1.5', '3.1.6') THEN v WHEN v < '3.1.4' THEN 'old' ELSE 'other' END AS band",
    "v >= '3.1.4' AS since_text",
    "coalesce(TRY_CAST(list_last(string_split(v, '.')) AS INT), 0) >= 4 AND v LIKE '3.%' AS since_number"]))
check("plays_of_path_shape", pv_uv("play", ["flag", "event"], "len(string_split(pathMain, '-')) = 3 OR len(string_split(path, '-')) IN (4, 5)"))
check("flood_filter", """SELECT CAST(day AS VARCHAR) AS day, count(*) AS pv, count(DISTINCT userId) + max(CASE WHEN userId IS NULL THEN 1 ELSE 0 END) AS uv
FROM (SELECT *, count(*) OVER (PARTITION BY userId, k) AS c FROM login) WHERE userId IS NULL OR c < 3 GROUP BY 1""")

check("play_titles", f"""SELECT coalesce(title, videoSid) AS title, count(userId) AS pv, count(DISTINCT userId) AS uv
FROM play LEFT JOIN {one_per_key('program', 'sid', 'title')} p ON videoSid = sid GROUP BY 1""")
NET = """CASE WHEN ip = 'x.y' THEN 0 ELSE ((CAST(split_part(ip, '.', 1) AS BIGINT) * 256 + CAST(split_part(ip, '.', 2) AS BIGINT)) * 256
  + CAST(split_part(ip, '.', 3) AS BIGINT)) * 256 END"""
EXTRA["placed_login"] = f"SELECT login.*, province, country FROM login LEFT JOIN {current('location')} ON web_location_key = {NET}"
check("users_by_network", pv_uv_null("placed_login", ["CASE WHEN country = '中国' THEN province ELSE '国外及其他' END AS area"]))
check("users_by_ip_range", """SELECT coalesce(p.country, r.country, '未知') AS country, coalesce(p.province, r.province, '未知') AS province,
  coalesce(p.city, r.city, '未知') AS city, count(*) AS pv, count(DISTINCT userId) + max(CASE WHEN userId IS NULL THEN 1 ELSE 0 END) AS uv
FROM login LEFT JOIN ip_prefix p ON starts_with(ip, p.prefix || '.')
LEFT JOIN ip_range r ON split_part(ip, '.', 1) = split_part(lo, '.', 1) AND TRY_CAST(split_part(ip, '.', 2) AS INT) <= 1 GROUP BY 1, 2, 3""")
check("padded_ips", """SELECT array_to_string(list_transform(string_split(ip, '.'), lambda o: lpad(o, 3, '0')), '.') AS padded,
  ((CAST(split_part(ip, '.', 1) AS BIGINT) * 256 + CAST(split_part(ip, '.', 2) AS BIGINT)) * 256 + CAST(split_part(ip, '.', 3) AS BIGINT)) * 256
  + CAST(split_part(ip, '.', 4) AS BIGINT) AS number, count(*) AS n FROM login WHERE ip <> 'x.y' GROUP BY 1, 2""")
check("brand_of_mac", """SELECT coalesce(a.brand, b.brand, 'none') AS brand, count(*) AS pv, count(DISTINCT userId) + max(CASE WHEN userId IS NULL THEN 1 ELSE 0 END) AS uv
FROM login LEFT JOIN mac_brand a ON substr(mac, 1, 6) = a.prefix LEFT JOIN mac_brand b ON substr(mac, 1, 8) = b.prefix GROUP BY 1""")
check("entrance_by_two_or_three_keys", """WITH v AS (SELECT userId, contentType, videoSid, CASE WHEN event = 'enter' THEN subjectCode END AS code FROM visit),
b AS (SELECT contentType, code, max(videoSid) AS best FROM v GROUP BY 1, 2)
SELECT best, count(userId) AS pv, count(DISTINCT userId) AS uv FROM v JOIN b ON v.contentType = b.contentType AND v.code IS NOT DISTINCT FROM b.code GROUP BY 1""")
check("duration_totals", "SELECT CAST(day AS VARCHAR) AS day, CAST(sum(duration) AS BIGINT) AS duration FROM home GROUP BY 1")
check("conditional_users", """SELECT contentType, count(DISTINCT userId) AS all_users, count(DISTINCT CASE WHEN apkVersion >= '3.1.4' THEN userId END) AS new_version,
  CAST(count(*) FILTER (event = 'startplay') AS BIGINT) AS starts FROM play GROUP BY 1""")
check("distinct_users", "SELECT DISTINCT CAST(day AS VARCHAR) AS day, productModel FROM login")
check("gaps_between_events", """SELECT userId, k, count(*) AS gaps, min(g) AS shortest, max(g) AS longest, CAST(sum(g) AS BIGINT) AS span FROM (
  SELECT userId, k, s - lag(s) OVER (PARTITION BY userId, k ORDER BY s) AS g FROM (SELECT userId, k, CAST(epoch(date_trunc('second', datetime)) AS BIGINT) AS s FROM login))
WHERE g IS NOT NULL GROUP BY 1, 2""")
check("largest_user_counts", f"SELECT *, row_number() OVER (ORDER BY uv DESC, videoSid) AS rank FROM ({pv_uv('play', ['videoSid'])}) QUALIFY rank <= 20")
check("reconcile_two_results", """SELECT contentType, pv, uv, CAST(sum(a) AS BIGINT) AS in_a, CAST(sum(b) AS BIGINT) AS in_b FROM (
 SELECT contentType, count(userId) AS pv, count(DISTINCT userId) AS uv, 1 AS a, 0 AS b FROM play3 GROUP BY 1
 UNION ALL SELECT contentType, count(userId), count(DISTINCT userId), 0, 1 FROM play3 WHERE duration IS NULL OR contentType <> 'tv' GROUP BY 1)
GROUP BY 1, 2, 3 HAVING sum(a) <> sum(b)""")
check("reconcile_days", """SELECT CAST(day AS VARCHAR) AS day, contentType, coalesce(a, 0) AS in_a, coalesce(b, 0) AS in_b FROM
(SELECT day, contentType, count(*) AS a FROM play3 GROUP BY 1, 2) FULL JOIN (SELECT day, contentType, count(*) AS b FROM play2 GROUP BY 1, 2) USING (day, contentType)
WHERE coalesce(a, 0) <> coalesce(b, 0)""")

# What each 3.x path template means, written down by hand.
# (template, entrance, level1, level2, level3, place, page, music entry/tab/item, home area, home location)
T = "'T' || CAST(l_suppkey % 5 AS VARCHAR)"
U = "'T' || CAST(l_suppkey % 4 AS VARCHAR)"
A = "'A' || CAST(l_suppkey % 3 AS VARCHAR)"


def q(v):
    return "NULL" if v is None else v if v in (T, U, A) else f"'{v}'"


MEANING_3X = [
    (0, "分类入口", "jilu", T, None, "jilu", "jilu", "", "", "", "", ""),
    (1, "历史", "tv", "history", None, "history", None, "", "", "", "", ""),
    (2, "收藏", "accountcenter_home", "X1", None, "collect", "accountcenter_home", "", "", "", "", ""),
    (3, "首页推荐", "hot", U, None, "1", "hot", "", "", "", "", ""),
    (4, "自定义入口", "tv", "搜索", None, "tv", "tv", "", "", "", "", ""),
    (5, "自定义入口", "tv", "tv", None, "tv", None, "", "", "", "", ""),
    (6, "分类入口", "kids", "kids_anim", A, "kids", "kids_home", "", "", "", "", ""),
    (7, "分类入口", "mv", "site_mvstyle", "POP", "mv", "mv", "音乐分类", "风格", "POP", "mvCategoryHomePage", "site_mvstyle"),
    (8, "其它3", "mv", "site_hotsinger", "", "site_hotsinger", "mv_poster", "音乐入口", "热门歌手", "", "function", "site_hotsinger"),
    (9, "分类入口", "sports", "League", "ouguan", "3", "sports", "", "", "", "", ""),
    (10, "分类入口", "movie", "筛选", None, "movie", "movie", "", "", "", "", ""),
    (11, "短视频", None, None, None, "x", None, "", "", "", "", ""),
    (12, "兴趣推荐", None, None, None, "y", None, "", "", "", "", ""),
    (13, "未知3x", None, None, None, None, None, "", "", "", "", ""),
    (14, "其它3", None, None, None, None, None, "", "", "", "", ""),
    (15, "其它3", "mv", "site_concert", "C3", "eagle", "mv", "音乐入口", "演唱会", "C3", "function", "site_concert"),
]


def by_template(i: int, column: str = "template") -> str:
    return f"CASE {column} " + " ".join(f"WHEN {m[0]} THEN {q(m[i])}" for m in MEANING_3X) + " END"


NAMES = ["entrance", "level1", "level2", "level3", "place", "page", "music_entry", "music_tab", "music_item", "home_area", "home_location"]
RAW3 = "(SELECT *, CAST((l_orderkey + l_linenumber) % 16 AS INT) AS template FROM lineitem)"
check("paths_3x", f"SELECT template, {', '.join(f'{by_template(i + 1)} AS {n}' for i, n in enumerate(NAMES))}, count(*) AS n FROM {RAW3} GROUP BY ALL")

# (template, area, location, page, detail)
PAGES = [
    (0, "classification", "jilu", "jilu", T), (1, "my_tv", "history", None, None),
    (2, "my_tv", "collect", "accountcenter_home", "X1"), (3, "recommendation", "1", "hot", U),
    (4, "my_tv", "tv", "tv", "search"), (5, "my_tv", "tv", None, None), (6, "classification", "kids", "kids_home", f"'kids_anim*' || {A}"),
    (7, "classification", "mv", "mv", "mvCategoryHomePage"), (8, None, None, None, None),
    (9, "classification", "3", None, "League"), (10, "classification", "movie", "movie", "retrieval"),
    (11, "hotSubject", None, None, None), (12, "taste", None, None, None), (13, None, None, None, None), (14, None, None, None, None),
    (15, "live", None, "mv", "function"),
]


def p(i):
    def lit(v):
        return "NULL" if v is None else v if "||" in v else f"'{v}'"

    return "CASE template " + " ".join(f"WHEN {m[0]} THEN {lit(m[i])}" for m in PAGES) + " END"


check("page_columns_3x", f"""SELECT template, {p(1)} AS launcherArea, {p(2)} AS launcherAccessLocation, {p(3)} AS pageType, {p(4)} AS pageDetailInfo,
  CASE l_linenumber WHEN 4 THEN 'similar' WHEN 5 THEN 'peoplealsolike' WHEN 6 THEN 'guessyoulike' END AS accessPath,
  CASE l_linenumber WHEN 4 THEN (['movie','tv','zongyi','comic','kids','jilu','hot','xiqu','mv','sports','game'])[1 + l_suppkey % 11] WHEN 5 THEN 'tv' END AS previousContentType,
  CASE l_suppkey % 6 WHEN 0 THEN 'subject' WHEN 1 THEN 'subject' WHEN 2 THEN 'tag' END AS pathProperty, count(*) AS n,
  count(DISTINCT CASE l_linenumber WHEN 4 THEN l_suppkey WHEN 5 THEN 1 END) AS sids,
  count(DISTINCT CASE l_suppkey % 6 WHEN 0 THEN CAST(l_suppkey % 40 AS VARCHAR) || '/' || CAST(l_suppkey % 11 AS VARCHAR) WHEN 1 THEN CAST(l_suppkey % 40 AS VARCHAR) WHEN 2 THEN 'x1' END) AS identifications
FROM {RAW3} GROUP BY ALL""")
CT = "(['movie','tv','zongyi','comic','kids','jilu','hot','xiqu','mv','sports','game'])[1 + l_suppkey % 11]"
check("subjects_3x", f"""SELECT CASE l_suppkey % 6 WHEN 0 THEN {CT} || CAST(l_suppkey % 40 AS VARCHAR) END AS code,
  CASE WHEN l_suppkey % 6 < 2 THEN 'Title' || CAST(l_suppkey % 40 AS VARCHAR) END AS name,
  CASE l_suppkey % 6 WHEN 0 THEN 'subject' WHEN 1 THEN 'subject' WHEN 2 THEN 'tag' END AS kind, count(*) AS n FROM lineitem GROUP BY ALL""")

MEANING_2X = [
    (0, "其它2", "movie", "movie_hot", None, None, "movie"), (1, "搜索", "search", "", "CNWD", "search", "search"),
    (2, "其它2", "kids", None, None, None, "kids_home"), (3, "首页推荐", None, None, None, None, "hotrecommend"),
    (4, "历史", "history", "collect", None, None, "history"), (5, "其它2", "tv", "tv_genbo", None, None, "tv"),
    (6, "未知2x", None, None, None, None, None), (7, "搜索", "movie", "multi_search", None, None, "movie"),
    (8, "其它2", "hot", "hot_zhuanti", None, None, "hot"), (9, "其它2", None, None, None, None, "otherswatch"),
]


def by_template_2x(i):
    return "CASE o_custkey % 10 " + " ".join(f"WHEN {m[0]} THEN {q(m[i])}" for m in MEANING_2X) + " END"


check("paths_2x", f"""SELECT CAST(o_custkey % 10 AS INT) AS template, {', '.join(f'{by_template_2x(i + 1)} AS {n}' for i, n in enumerate(['entrance', 'level1', 'level2', 'keyword', 'origin', 'place']))},
  count(*) AS n FROM orders GROUP BY ALL""")
check("page_columns_2x", """SELECT CAST(o_custkey % 10 AS INT) AS template,
  CASE o_custkey % 10 WHEN 1 THEN 'navi' WHEN 3 THEN 'hotrecommend' WHEN 9 THEN 'otherswatch' WHEN 6 THEN NULL ELSE 'classification' END AS launcherArea,
  CASE o_custkey % 10 WHEN 0 THEN 'movie' WHEN 1 THEN 'search' WHEN 2 THEN 'kids_home' WHEN 3 THEN '1' WHEN 4 THEN 'history' WHEN 5 THEN 'tv' WHEN 7 THEN 'movie' WHEN 8 THEN 'hot' END AS launcherAccessLocation,
  CASE o_custkey % 10 WHEN 0 THEN 'movie' WHEN 1 THEN 'search' WHEN 2 THEN 'kids_home' WHEN 4 THEN 'history' WHEN 5 THEN 'tv' WHEN 7 THEN 'movie' WHEN 8 THEN 'hot' END AS pageType,
  CASE o_custkey % 10 WHEN 0 THEN 'movie_hot' WHEN 2 THEN 'kids_seecartoon' WHEN 3 THEN '1' WHEN 4 THEN 'collect' WHEN 5 THEN 'tv_genbo' WHEN 7 THEN 'multi_search' WHEN 8 THEN 'hot_zhuanti' WHEN 9 THEN '3' END AS pageDetailInfo,
  CASE o_custkey % 10 WHEN 8 THEN 'similar' END AS accessPath, CASE o_custkey % 10 WHEN 8 THEN 'subject' END AS pathProperty,
  count(*) AS n, CAST(count(*) FILTER (o_custkey % 10 IN (3, 5)) AS BIGINT) AS identified FROM orders GROUP BY ALL""")
check("subject_pairs_2x", """SELECT code, source, count(*) AS pv, count(DISTINCT o_custkey) AS uv FROM (
  SELECT o_custkey, 'hot' || CAST(o_custkey % 30 AS VARCHAR) AS code, 'hotrecommend' AS source FROM orders WHERE o_custkey % 10 = 3
  UNION ALL SELECT o_custkey, 'tv' || CAST(o_custkey % 20 AS VARCHAR), 'tv_genbo' FROM orders WHERE o_custkey % 10 = 5
  UNION ALL SELECT o_custkey, 'actor', 'tv_genbo' FROM orders WHERE o_custkey % 10 = 5) GROUP BY 1, 2""")
check("retrieval_filters", """SELECT CASE WHEN hit THEN 'hot' END AS sort, CASE WHEN hit THEN 'xiju' END AS tag,
  CASE WHEN hit THEN CASE flag WHEN '3x' THEN 'gangtai' ELSE 'neidi' END END AS area, CASE WHEN hit THEN CASE flag WHEN '3x' THEN 'all' ELSE '2016' END END AS year,
  count(userId) AS pv, count(DISTINCT userId) AS uv
FROM (SELECT *, (flag = '3x' AND template = 10) OR (flag = '2x' AND template = 7) AS hit FROM play) GROUP BY ALL""")
check("launcher_labels", """WITH l AS (
 SELECT userId, CASE accessArea WHEN 'classification' THEN '分类' WHEN 'my_tv' THEN '我的电视' WHEN 'recommendation' THEN '今日推荐' WHEN 'live' THEN '直播' WHEN 'foundation' THEN '发现' ELSE '搜索与设置' END AS area,
  CASE accessLocation WHEN 'site_movie' THEN '电影' WHEN 'site_tv' THEN '电视' WHEN 'history' THEN '历史' WHEN 'top_hot' THEN '热播榜' WHEN 'search' THEN '搜索' WHEN 'site_kids' THEN '少儿' ELSE '其他' END AS location,
  CASE WHEN locationIndex = '0' THEN '其他位置' ELSE '第' || locationIndex || '个位置' END AS position FROM home
 UNION ALL SELECT userId, CASE locationIndex WHEN '1' THEN '热门推荐' WHEN '2' THEN '卫视直播' WHEN '3' THEN '大家在看' WHEN '4' THEN '观看历史' WHEN '5' THEN '分类区域' ELSE '其他' END,
  CASE WHEN userId LIKE '%1' AND CAST(locationIndex AS INT) < 15 THEN (['搜索','历史收藏','电影','电视','直播','资讯短片','综艺','设置','少儿','动漫','音乐','纪实','戏曲','体育','专题'])[1 + CAST(locationIndex AS INT)]
   ELSE '第' || CAST(CAST(locationIndex AS INT) + 1 AS VARCHAR) || '个位置' END, '-' FROM home)
SELECT area, location, position, count(userId) AS pv, count(DISTINCT userId) AS uv FROM l GROUP BY 1, 2, 3""")
check("version_parts", pv_uv_null("login", [f"{VERSION} AS version",
    "CASE WHEN version IS NULL THEN NULL WHEN version = '' THEN '' ELSE 'Box_TVApp3.0_X' END AS series",
    "CASE WHEN version IS NULL THEN '未知' WHEN version = '' THEN 'k' ELSE '3' END AS major"]))
check("duration_units", """SELECT CASE WHEN duration <= 86400 THEN duration // 900 ELSE duration + 1 END AS quarters,
  CASE WHEN duration * 4 <= 86400 THEN (duration * 4) // 3600 ELSE duration * 4 + 1 END AS hours, count(*) AS n FROM visit WHERE duration IS NOT NULL GROUP BY 1, 2""")
check("scalar_functions", """SELECT productModel AS trimmed, mac || '/' || log_type AS joined, substr(mac, 1, 6) AS prefix, CAST(length(mac) AS INT) AS mac_length,
  round(duration / 7, 2) AS rounded, CAST(k AS VARCHAR) AS k_text, CASE WHEN k BETWEEN 10 AND 20 THEN 'mid' WHEN mac LIKE '001A9A%' THEN 'a' ELSE 'other' END AS kind,
  coalesce(userId, 'null') AS user_or_null, wifiMac IS NULL AS no_wifi, CAST(day - DATE '2023-12-25' AS INT) AS days, CAST(day AS VARCHAR) AS as_date,
  CAST(hour(datetime) AS INT) AS hour, CAST(minute(datetime) AS INT) AS minute, CAST(year(day) AS INT) AS year, CAST(month(day) AS INT) AS month,
  CAST(epoch(date_trunc('second', datetime)) AS BIGINT) AS seconds, CAST(date_trunc('second', datetime) AS VARCHAR) AS back,
  CASE k % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'cancel' ELSE 'error' END AS thumb, CAST(date_trunc('minute', datetime) AS VARCHAR) AS minute_floor,
  CAST(date_trunc('minute', datetime) + INTERVAL 1 MINUTE AS VARCHAR) AS minute_ceil FROM login""")
check("period_labels", """SELECT CAST(day AS VARCHAR) AS day, count(*) AS n,
  CAST(CAST(date_trunc('week', day) AS DATE) AS VARCHAR) || '~' || CAST(CAST(date_trunc('week', day) AS DATE) + 6 AS VARCHAR) AS week, strftime(day, '%Y-%m') AS month,
  CAST(year(day) AS VARCHAR) || 'Q' || CAST(quarter(day) AS VARCHAR) AS quarter, CAST(year(day) AS VARCHAR) AS year, 7 AS in_week,
  dayofweek(day) = 1 AS closes_week, day(day) = 1 AS closes_month FROM play GROUP BY ALL""".replace("day(day)", "extract(day FROM day)"))
check("search_clicks_by_map_key", "SELECT resultSid AS sid, CAST(NULL AS VARCHAR) AS missing, count(userId) AS pv, count(DISTINCT userId) AS uv FROM search GROUP BY 1")
check("access_log_records", """SELECT page_id, CAST(1 + page_id % 200 AS VARCHAR) || '.2.3.4' AS ip, '2024-01-' || lpad(CAST(1 + page_id % 28 AS VARCHAR), 2, '0') || ' 10:11:12' AS datetime,
  '2024-01-' || lpad(CAST(1 + page_id % 28 AS VARCHAR), 2, '0') AS day, CASE page_id % 3 WHEN 0 THEN 'play' WHEN 1 THEN 'detail' ELSE 'home view' END AS logType,
  'u' || CAST(page_id % 50 AS VARCHAR) AS userId, CASE WHEN page_id % 7 = 0 THEN 0 ELSE page_id % 900 END AS duration, CAST(0 AS BIGINT) AS accountId,
  CAST(page_id % 9 AS VARCHAR) AS productModel, CASE WHEN page_id % 5 = 0 THEN '1' END AS corrupt FROM pages WHERE page_id % 11 <> 0""")
check("split_user_ids", """SELECT CASE k % 3 WHEN 1 THEN '7' ELSE '0' END AS accountId, CASE k % 3 WHEN 2 THEN CAST(k AS VARCHAR) ELSE '0' END AS groupId, count(*) AS n, count(DISTINCT mac) AS users
FROM login GROUP BY 1, 2""")
check("surrogate_keys", f"""SELECT flag, entryType, second_category, count(*) AS n, count(program_sk) AS known, CAST(sum(program_sk) AS BIGINT) AS sk_sum, 1 AS keys
FROM play LEFT JOIN {one_per_key('program', 'sid', 'program_sk')} p ON videoSid = sid AND contentType <> 'game' GROUP BY 1, 2, 3""")
check("surrogate_dictionary", r"""SELECT DISTINCT md5(flag || '|' || entryType || '|' || coalesce(main_category, chr(1))) AS path_sk, flag, entryType, main_category FROM play""")
check("presence_by_product", side_by_side({
    "players": "SELECT productModel, count(DISTINCT userId) AS players FROM play GROUP BY 1",
    "logins": "SELECT productModel, count(DISTINCT userId) AS logins FROM login GROUP BY 1"}, ["productModel"]))
check("province_names", """SELECT CASE n_nationkey WHEN 0 THEN '黑龙江' WHEN 1 THEN '内蒙古' WHEN 2 THEN '北京' WHEN 3 THEN '未知' ELSE n_name END AS province,
  CASE n_nationkey WHEN 0 THEN '黑龙江' WHEN 1 THEN '内蒙古' WHEN 2 THEN '北京' ELSE '国外及其他' END AS area, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
