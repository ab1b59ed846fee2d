from viewtally.plans.facts import ENTRANCES, KIDS_PROGRAMS, MERGERS, SITES, TAB_LABELS
from viewtally.plans.standins import STANDINS

from .base import RAW3, T, U, by_template, by_template_2x, q
from .core import EXTRA, check, current, one_per_key, pv_uv

COLUMNS = {
    "home": "userId event apkVersion datetime day productModel duration accessArea accessLocation locationIndex",
    "login": "userId datetime day productModel duration",
    "visit": "userId event apkVersion datetime day videoSid contentType duration productModel",
    "livelog": "userId event datetime day duration",
    "accountlog": "userId event day accountId path",
    "apps": "userId event day appSid",
    "play3": "userId event apkVersion datetime day videoSid contentType episodeSid duration productModel",
    "play2": "userId event apkVersion datetime day videoSid contentType duration productModel",
}
for name, m in MERGERS.items():
    sides = []
    kept = [c for c in m.columns if c not in ("userId", "datetime", "day", *m.keys)]
    for flag, table in (("3x", m.new), ("2x", m.old)):
        have = COLUMNS[table].split()
        cols = []
        for c in m.columns:
            expr = m.extra.get(flag, {}).get(c, c if c in have else "NULL")
            cols.append(f"{expr} AS {c}")
        sides.append(f"SELECT '{flag}' AS flag, {', '.join(cols)} FROM {table}")
    keys = ", ".join("CAST(day AS VARCHAR) AS day" if k == "day" else k for k in m.keys)
    check(f"merge_{name}", f"SELECT {keys}, count(*) AS rows, count(userId) AS users{''.join(f', count({c}) AS n_{c}' for c in kept)} "
          f"FROM ({' UNION ALL '.join(sides)}) GROUP BY {', '.join(str(i + 1) for i in range(len(m.keys)))}")

check("merge_detail", """SELECT '3x' AS flag, CASE template WHEN 0 THEN 'classification' WHEN 1 THEN 'my_tv' WHEN 2 THEN 'my_tv' WHEN 3 THEN 'recommendation' WHEN 4 THEN 'my_tv'
   WHEN 5 THEN 'my_tv' WHEN 6 THEN 'classification' WHEN 7 THEN 'classification' WHEN 9 THEN 'classification' WHEN 10 THEN 'classification' WHEN 11 THEN 'hotSubject' WHEN 12 THEN 'taste' WHEN 15 THEN 'live' END AS launcherArea,
  CASE s WHEN 0 THEN 'subject' WHEN 1 THEN 'subject' WHEN 2 THEN 'tag' END AS pathProperty, count(CASE WHEN l_partkey % 97 <> 0 THEN 1 END) AS pv,
  count(CASE WHEN s = 0 THEN 1 END) AS codes, count(CASE WHEN s < 2 THEN 1 END) AS names, count(CASE WHEN l_linenumber IN (4, 5) THEN 1 END) AS previous
FROM (SELECT *, (l_orderkey + l_linenumber) % 16 AS template, l_suppkey % 6 AS s FROM lineitem) GROUP BY ALL
UNION ALL SELECT '2x', CASE o_custkey % 10 WHEN 1 THEN 'navi' WHEN 3 THEN 'hotrecommend' WHEN 9 THEN 'otherswatch' WHEN 6 THEN NULL ELSE 'classification' END,
  CASE o_custkey % 10 WHEN 8 THEN 'subject' END, count(*), count(CASE WHEN o_custkey % 10 IN (3, 5) THEN 1 END), 0, 0 FROM orders GROUP BY ALL""")
check("merge_interview", pv_uv("(SELECT '3x' AS flag, userId, event, contentType FROM visit UNION ALL SELECT '2x', userId, event, nullif(split_part(path, '-', 2), '') FROM visit)", ["flag", "event", "contentType"]))
check("merge_live", pv_uv("""(SELECT '3x' AS flag, userId, coalesce(menu_name, liveMenuCode) AS channelName, datetime FROM livelog LEFT JOIN livemenu ON liveMenuCode = menu_code
  UNION ALL SELECT '2x', userId, NULL, datetime FROM login)""", ["flag", "channelName", "CAST(hour(datetime) AS INT) AS hour"]))
CODE2 = "CASE template WHEN 3 THEN regexp_extract(path, '(hot[0-9]+)$', 1) WHEN 5 THEN regexp_extract(path, '-(tv[0-9]+)-', 1) END"
# both subject columns of a key come from the same (largest) row
EXTRA["one_subject"] = """SELECT subject_code, subject_name, subject_content_type_name FROM subject WHERE dim_invalid_time IS NULL
  QUALIFY row_number() OVER (PARTITION BY subject_code ORDER BY subject_name DESC, subject_content_type_name DESC) = 1"""
check("merge_subject_visits", pv_uv(f"""(SELECT flag, userId, coalesce(subject_name, subjectCode) AS title, subject_content_type_name AS channel FROM
  (SELECT '3x' AS flag, userId, subjectCode FROM visit UNION ALL SELECT '2x', userId, {CODE2} FROM play2) LEFT JOIN one_subject ON subjectCode = subject_code)""", ["flag", "title", "channel"]))

E2 = by_template_2x(1).replace("o_custkey % 10", "template")
E3 = by_template(1)
CODE3 = "CASE WHEN pathSpecial LIKE 'subject-%-%' THEN split_part(pathSpecial, '-', 3) END"
NAME3 = "CASE WHEN pathSpecial LIKE 'subject-%' THEN split_part(pathSpecial, '-', 2) END"
check("merge_play_with_paths", f"""SELECT '3x' AS flag, {E3} AS entryType, nullif(split_part(pathSpecial, '-', 1), '') AS playKind, count(*) AS n, count({CODE3}) AS codes, count({NAME3}) AS names FROM play3 GROUP BY ALL
UNION ALL SELECT '2x', {E2}, CASE WHEN template = 8 THEN 'subject' END, count(*), count({CODE2}), 0 FROM play2 GROUP BY ALL""")

EXTRA["sites"] = SITES.format(nation="nation")
EXTRA["entrances"] = ENTRANCES.format(nation="nation")
EXTRA["kids_programs"] = KIDS_PROGRAMS.format(region="region")
EXTRA["listed"] = """SELECT site_content_type AS main, second_category_code AS code, max(second_category) AS name FROM sites
  WHERE site_content_type IS NOT NULL AND dim_invalid_time IS NULL
  AND main_category_code IN ('site_tv', 'site_movie', 'site_xiqu', 'site_comic', 'site_zongyi', 'site_hot', 'site_jilu', 'mv_site') GROUP BY 1, 2"""
EXTRA["thirds"] = """SELECT site_content_type AS main, third_category_code AS code, max(third_category) AS name FROM sites
  WHERE site_content_type IS NOT NULL AND dim_invalid_time IS NULL GROUP BY 1, 2"""
EXTRA["sport_areas"] = "SELECT area_code AS code, max(area_name) AS name FROM entrances WHERE page_code = 'sports' GROUP BY 1"
EXTRA["kids_areas"] = """SELECT path_code AS code, CASE WHEN name IN ('', 'null') THEN '' ELSE name END AS name FROM (SELECT DISTINCT path_code, program_code FROM kids_programs)
  JOIN (SELECT area_code, max(area_name) AS name FROM entrances GROUP BY 1) ON program_code = area_code"""
T3 = "'T' || CAST(CAST(substr(videoSid, 2) AS BIGINT) % 5 AS VARCHAR)"


def level3(i):
    text = by_template(i)
    return text.replace("l_suppkey", "CAST(substr(videoSid, 2) AS BIGINT)")


EXTRA["parsed"] = f"""SELECT '3x' AS flag, day, userId, videoSid, duration, {E3} AS entryType, {CODE3} AS code, {NAME3} AS name,
  {level3(2)} AS l1, {level3(3)} AS l2, {level3(4)} AS l3 FROM play3
UNION ALL SELECT '2x', day, userId, videoSid, duration, {E2}, {CODE2}, NULL, {by_template_2x(2).replace('o_custkey % 10', 'template')},
  {by_template_2x(3).replace('o_custkey % 10', 'template')}, NULL FROM play2"""
# channel by channel, as separate queries that are put together again
EXTRA["named"] = """SELECT p.*, CASE WHEN coalesce(l2, '') = '' THEN '' ELSE (SELECT max(name) FROM listed WHERE main = l1 AND CASE WHEN flag = '3x' AND l1 <> 'mv' THEN name = l2 ELSE code = l2 END) END AS second_category,
  l3 AS third_category FROM parsed p WHERE l1 IS NULL OR l1 NOT IN ('sports', 'kids')
UNION ALL SELECT p.*, a.name, t.name FROM parsed p LEFT JOIN sport_areas a ON l2 = a.code LEFT JOIN thirds t ON t.main = l1 AND l2 <> 'horizontal' AND l3 = t.code WHERE l1 = 'sports'
UNION ALL SELECT p.*, k.name, l3 FROM parsed p LEFT JOIN kids_areas k ON l2 = k.code WHERE l1 = 'kids'"""
EXTRA["fact_rows"] = f"""SELECT p.*, coalesce(nullif(p.code, ''), s.subject_code) AS subjectCode, count(*) OVER (PARTITION BY p.day, p.userId, p.videoSid) AS c
FROM named p LEFT JOIN {one_per_key('subject', 'subject_name', 'subject_code')} s ON coalesce(p.code, '') = '' AND trim(p.name) = trim(s.subject_name)"""
check("play_fact", """SELECT flag, entryType, l1 AS main_category, second_category, third_category, count(*) AS n, count(userId) AS users, CAST(sum(duration) AS BIGINT) AS duration
FROM fact_rows WHERE userId IS NULL OR c < 2 GROUP BY ALL""")
check("play_fact_subjects", "SELECT flag, subjectCode, count(*) AS n FROM fact_rows WHERE userId IS NULL OR c < 2 GROUP BY ALL")
EXTRA["tab_labels"] = TAB_LABELS.format(nation="nation")
check("page_labels_2x", """SELECT CASE contentType WHEN 'movie' THEN '电影' WHEN 'tv' THEN '电视' WHEN 'hot' THEN '资讯短片' WHEN 'kids' THEN '少儿' WHEN 'zongyi' THEN '综艺' WHEN 'comic' THEN '动漫'
   WHEN 'jilu' THEN '纪实' WHEN 'sports' THEN '体育' WHEN 'xiqu' THEN '戏曲' WHEN 'mv' THEN '音乐' WHEN 'game' THEN '游戏' ELSE '未知' END AS channel,
  CASE template WHEN 0 THEN 'movie' WHEN 1 THEN 'search' WHEN 2 THEN 'kids_home' WHEN 4 THEN 'history' WHEN 5 THEN 'tv' WHEN 7 THEN 'movie' WHEN 8 THEN 'hot' END AS pageType,
  CASE template WHEN 0 THEN '院线大片' WHEN 2 THEN 'kids_seecartoon' WHEN 3 THEN '1' WHEN 4 THEN '收藏追剧' WHEN 5 THEN '华语热播' WHEN 7 THEN '筛选' WHEN 8 THEN '资讯专题' WHEN 9 THEN '3' END AS pageDetailInfo,
  count(userId) AS pv, count(DISTINCT userId) AS uv FROM play2 GROUP BY ALL""")
# (template, way, area, location, page, tab), written down by hand
WAYS = [
    (0, "home", "classification", "jilu", "jilu", T), (1, "home", "my_tv", "history", None, None), (2, "home", "my_tv", "collect", "accountcenter_home", "X1"),
    (3, "home", "recommendation", "1", "hot", U), (4, "home", "my_tv", "tv", "tv", None), (5, "home", "my_tv", "tv", None, None),
    (6, "home", "classification", "kids", "kids_home", None), (7, "home", "classification", "mv", "mv", "mvCategoryHomePage"),
    (8, "mv", "function", "site_hotsinger", "mv_poster", None), (9, "home", "classification", "3", "sports", "League"),
    (10, "home", "classification", "movie", "movie", None), (11, "home", "hotSubject", "x", None, None), (12, "home", "taste", "y", None, None),
    (13, None, None, None, None, None), (14, "thirdparty", None, None, None, None), (15, "home", "live", "eagle", "mv", "function"),
]
way = ", ".join("CASE template " + " ".join(f"WHEN {m[0]} THEN {q(m[i])}" for m in WAYS) + f" END AS {n}" for i, n in enumerate("way area location page tab".split(), 1))
check("enter_ways", f"SELECT {way}, count(userId) AS pv, count(DISTINCT userId) AS uv FROM (SELECT *, CASE WHEN l_partkey % 97 <> 0 THEN l_partkey END AS userId FROM {RAW3}) GROUP BY 1, 2, 3, 4, 5")
check("plays_per_program", pv_uv("(SELECT userId, coalesce(p.title, videoSid) AS title, coalesce(p.content_type_name, 'none') AS channel FROM play3 LEFT JOIN (SELECT * FROM program WHERE dim_invalid_time IS NULL) p ON videoSid = sid)", ["title", "channel"]))
check("calm_plays", """SELECT flag, CAST(day AS VARCHAR) AS day, count(*) AS pv, count(DISTINCT userId) + max(CASE WHEN userId IS NULL THEN 1 ELSE 0 END) AS uv
FROM (SELECT *, count(*) OVER (PARTITION BY day, userId, videoSid) AS c FROM play) WHERE userId IS NULL OR c < 2 GROUP BY 1, 2""")
check("account_snapshot", "SELECT '2024-01-15' AS day, promotion_channel, count(*) AS accounts, CAST(max(openTime) AS VARCHAR) AS last_open FROM account WHERE openTime < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 2")

# the tries straight from the line items, without the document
EXTRA["tries"] = """SELECT CAST(EXTRACT(DAY FROM l_shipdate) AS INT) AS dom, l_partkey, l_suppkey, l_orderkey, l_linenumber, 'u' || CAST(l_partkey AS VARCHAR) AS userId,
  'v' || CAST(l_suppkey AS VARCHAR) AS videoSid, 'e' || CAST(l_suppkey % 37 AS VARCHAR) AS episodeSid,
  (['movie','tv','zongyi','comic','kids','jilu','hot','xiqu','mv','sports','game'])[1 + l_suppkey % 11] AS contentType,
  i AS try, CASE WHEN l_orderkey % 50 = 0 THEN 'none' WHEN l_orderkey % 50 = 2 THEN 's0' WHEN i < 3 THEN 's' || CAST(l_partkey % 5 AS VARCHAR) ELSE 's' || CAST((l_partkey + 1) % 5 AS VARCHAR) END AS videoSource,
  CASE WHEN l_orderkey % 50 = 0 THEN -1 WHEN l_orderkey % 50 = 2 THEN 0 WHEN i < 3 THEN 0 ELSE 1 END AS sourceIndex,
  CASE WHEN l_orderkey % 50 IN (0, 2) THEN NULL WHEN i = 1 THEN ([200, -1, -2, -3])[1 + l_linenumber % 4] WHEN i = 2 THEN 200 ELSE ([200, -1, -3])[1 + l_orderkey % 3] END AS playCode,
  CASE WHEN i = 1 AND l_orderkey % 50 NOT IN (0, 2) THEN l_orderkey % 100 ELSE -1 END AS playDuration,
  l_orderkey % 50 <> 0 AS playQos, l_orderkey % 50 NOT IN (0, 2) AS sourceCases, '3.1.' || CAST(l_partkey % 12 AS VARCHAR) AS apkVersion, l_shipdate
FROM lineitem, range(1, 4) r(i) WHERE l_orderkey % 50 <> 1 AND (l_orderkey % 50 NOT IN (0, 2) OR i = 1)"""
check("quality_rows", """SELECT playQos, sourceCases, videoSource, sourceIndex, playCode, count(*) AS n, CAST(sum(playDuration) AS BIGINT) AS play_duration, -1 AS init, 'none' AS player,
  count(DISTINCT userId) AS users FROM tries GROUP BY 1, 2, 3, 4, 5""")
check("user_areas", f"""SELECT user_id, coalesce(country, '未知') AS country, coalesce(province, '未知') AS province, coalesce(city, '未知') AS city
FROM account LEFT JOIN {current('location')} ON web_location_key = ((CAST(split_part(ip, '.', 1) AS BIGINT) * 256 + CAST(split_part(ip, '.', 2) AS BIGINT)) * 256 + 7) * 256""")
