"""Logs and dimensions computed from the test tables.

Each stand-in is one SELECT over the base tables (or over other stand-ins) in
SQL that both Spark and the checking engine read, so both start from the same
rows. ``{name}`` refers to another table. No row of a base table is left out.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

CHANNELS = ["movie", "tv", "zongyi", "comic", "kids", "jilu", "hot", "xiqu", "mv", "sports", "game"]


def _choice(expr: str, values: list[str]) -> str:
    """One of some texts by number; '' stands for null."""
    return f"nullif(split_part('{'~'.join(values)}', '~', CAST(1 + ({expr}) % {len(values)} AS INT)), '')"


def channel(expr: str) -> str:
    return _choice(expr, CHANNELS)


def at(day: str, seconds: str) -> str:
    return f"CAST({day} AS TIMESTAMP) + INTERVAL '1' SECOND * CAST({seconds} AS INT)"


def month_day(ts: str) -> str:
    """A day of January 2024 from the day of the month."""
    return f"(DATE '2024-01-01' + CAST(EXTRACT(DAY FROM {ts}) - 1 AS INT))"


def model(expr: str) -> str:
    return f"'model' || CAST(({expr}) % 25 AS STRING)"


def promo(expr: str) -> str:
    return f"CASE ({expr}) % 13 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'a-b' ELSE 'ch' || CAST(({expr}) % 13 AS STRING) END"


def mac(expr: str) -> str:
    return (
        f"CASE ({expr}) % 3 WHEN 0 THEN '001A9A' WHEN 1 THEN '0022D10F' ELSE 'FFEE00' END "
        f"|| lpad(CAST({expr} AS STRING), 6, '0')"
    )


K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
_CT3 = channel("l_suppkey")

# Paths by template number; #n stands for a number below n, '' for null.
PATHS_3X = [
    "home*classification*jilu-jilu*T#5",
    "home*my_tv*history",
    "home*my_tv*collect-accountcenter_home*X1",
    "home*recommendation*1-hot*T#4",
    "home*my_tv*tv-tv-search*DQD",
    "home*my_tv*tv",
    "home*classification*kids-kids_home-kids_anim*A#3",
    "home*classification*mv-mv*mvCategoryHomePage*site_mvstyle-mv_category*POP",
    "mv*function*site_hotsinger-mv_poster",
    "home*classification*3-sports*League*ouguan-league*A2",
    "home*classification*movie-movie-retrieval*hot*xiju*gangtai*all",
    "home*hotSubject*x",
    "home*taste*y",
    "",
    "thirdparty",
    "home*live*eagle-mv*function*site_concert-mv_category*C3",
]
PATHS_2X = [
    "home-movie-movie_hot",
    "home-search-CNWD",
    "home-kids_home-kids_seecartoon",
    "home-hotrecommend-1-2-hot#30",
    "home-history-collect",
    "home-tv-tv_genbo-tv#20-actor",
    "",
    "home-movie-multi_search-hot-xiju-neidi-2016",
    "home-hot-hot_zhuanti-subject-hot7-similar",
    "home-otherswatch-3",
]


def path(expr: str, templates: list[str], number: str) -> str:
    text = _choice(expr, templates)
    for n in sorted({int(m) for m in re.findall(r"#(\d+)", " ".join(templates))}, reverse=True):
        text = f"replace({text}, '#{n}', CAST(({number}) % {n} AS STRING))"
    return text


STANDINS: dict[str, str] = {
    # ---------------------------------------------------------------- play logs
    "play3": f"""
SELECT CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE 'u' || CAST(l_partkey AS STRING) END AS userId,
  CAST(l_partkey % 50 AS BIGINT) AS accountId,
  CASE l_linenumber % 3 WHEN 1 THEN 'startplay' WHEN 2 THEN 'userexit' ELSE 'selfend' END AS event,
  {_CT3} AS contentType,
  'v' || CAST(l_suppkey AS STRING) AS videoSid,
  'name' || CAST(l_suppkey + (CASE WHEN l_orderkey % 211 = 0 THEN 1 ELSE 0 END) AS STRING) AS videoName,
  'e' || CAST(l_suppkey % 37 AS STRING) AS episodeSid,
  CAST((l_orderkey + l_linenumber) % 16 AS INT) AS template,
  {path('l_orderkey + l_linenumber', PATHS_3X, 'l_suppkey')} AS pathMain,
  CASE l_linenumber WHEN 4 THEN 'similar-x-v' || CAST(l_suppkey AS STRING) || '*' || {_CT3}
    WHEN 5 THEN 'peoplealsolike-y-v1*tv' WHEN 6 THEN 'guessyoulike' ELSE NULL END AS pathSub,
  CASE l_suppkey % 6 WHEN 0 THEN 'subject-Title' || CAST(l_suppkey % 40 AS STRING) || '-' || {_CT3} || CAST(l_suppkey % 40 AS STRING)
    WHEN 1 THEN 'subject-Title' || CAST(l_suppkey % 40 AS STRING) WHEN 2 THEN 'tag-x1' ELSE NULL END AS pathSpecial,
  CASE WHEN l_linenumber % 3 = 1 THEN NULL ELSE CAST(floor(l_quantity) AS BIGINT) * 300 END AS duration,
  CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE '3.1.' || CAST(l_partkey % 12 AS STRING) END AS apkVersion,
  {model('l_partkey')} AS productModel,
  {promo('l_partkey')} AS promotionChannel,
  {at(month_day('l_shipdate'), '(l_orderkey * 37 + l_linenumber * 1009) % 86400')} AS datetime,
  {month_day('l_shipdate')} AS day
FROM {{lineitem}}""",
    "play2": f"""
SELECT 'u' || CAST(o_custkey AS STRING) AS userId, 'playview' AS event,
  {channel('o_orderkey')} AS contentType,
  'v' || CAST(o_orderkey % 100 AS STRING) AS videoSid,
  CAST(o_custkey % 10 AS INT) AS template,
  {path('o_custkey', PATHS_2X, 'o_custkey')} AS path,
  CAST(floor(o_totalprice / 40) AS BIGINT) AS duration,
  '2.6.' || CAST(o_custkey % 9 AS STRING) AS apkVersion,
  {model('o_custkey')} AS productModel,
  {promo('o_custkey')} AS promotionChannel,
  {at(month_day('o_orderdate'), '(o_orderkey * 41) % 86400')} AS datetime,
  {month_day('o_orderdate')} AS day
FROM {{orders}}""",
    # the play fact as the reports read it; labels are short codes
    "play": """
SELECT userId, event, contentType, videoSid, videoName, episodeSid, pathMain, CAST(NULL AS STRING) AS path, pathSub, pathSpecial,
  duration, apkVersion, productModel, promotionChannel, datetime, day, '3x' AS flag, template,
  'entry' || CAST(template % 7 AS STRING) AS entryType,
  CASE WHEN pathSpecial LIKE 'subject-%-%' THEN regexp_extract(pathSpecial, 'subject-[^-]*-(.*)', 1) ELSE NULL END AS subjectCode,
  CASE WHEN template IN (1, 5, 11, 12, 13, 14) THEN NULL ELSE contentType END AS main_category,
  CASE WHEN template IN (1, 5, 11, 12, 13, 14) THEN NULL ELSE 'cat' || CAST(template AS STRING) END AS second_category
FROM {play3}
UNION ALL
SELECT userId, event, contentType, videoSid, CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING), path, CAST(NULL AS STRING), CAST(NULL AS STRING),
  duration, apkVersion, productModel, promotionChannel, datetime, day, '2x', template,
  'entry' || CAST(template % 7 AS STRING),
  CASE WHEN path LIKE 'home-hotrecommend-%' THEN regexp_extract(path, '(hot[0-9]+)$', 1) ELSE NULL END,
  CASE WHEN template IN (3, 6, 9) THEN NULL ELSE contentType END,
  CASE WHEN template IN (3, 6, 9) THEN NULL ELSE 'cat' || CAST(template AS STRING) END
FROM {play2}""",
    # ------------------------------------------------------------- other logs
    "login": f"""
SELECT CASE WHEN user_id % 41 = 0 THEN NULL ELSE 'u' || CAST(user_id AS STRING) END AS userId,
  {mac('user_id')} AS mac,
  CASE user_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '02:00:00:00:00:00' ELSE 'W' || CAST(user_id % 70 AS STRING) END AS wifiMac,
  CASE WHEN user_id % 31 = 0 THEN NULL WHEN user_id % 29 = 0 THEN ''
    ELSE 'Box_TVApp3.0_X_3.1.' || CAST((user_id + {K}) % 12 AS STRING) END AS version,
  {model('user_id')} AS productModel, {promo('user_id')} AS promotionChannel,
  CASE WHEN user_id % 37 = 0 THEN 'x.y' ELSE CAST(1 + user_id % 30 AS STRING) || '.' || CAST((user_id % 30) % 4 AS STRING)
    || '.7.' || CAST(event_id % 256 AS STRING) END AS ip,
  event_type AS log_type, {K} AS k, CAST(floor(value) AS BIGINT) * 60 AS duration, ts AS datetime, CAST(ts AS DATE) AS day
FROM {{events}}""",
    "home": f"""
SELECT 'u' || CAST(user_id AS STRING) AS userId, event_type AS event,
  {_choice(K, ['classification', 'my_tv', 'recommendation', 'live', 'foundation', 'navi'])} AS accessArea,
  {_choice('user_id', ['site_movie', 'site_tv', 'history', 'top_hot', 'search', 'site_kids', 'other'])} AS accessLocation,
  CAST({K} % 20 AS STRING) AS locationIndex,
  {model('user_id')} AS productModel, '3.1.' || CAST(user_id % 12 AS STRING) AS apkVersion,
  CAST(floor(value) AS BIGINT) * 60 AS duration, ts AS datetime, CAST(ts AS DATE) AS day
FROM {{events}}""",
    "livelog": f"""
SELECT 'u' || CAST(user_id AS STRING) AS userId,
  CASE event_type WHEN 'view' THEN 'startplay' WHEN 'purchase' THEN 'startplay' WHEN 'click' THEN 'switchchannel' ELSE 'endplay' END AS event,
  CASE WHEN {K} % 4 = 0 THEN 'vod' ELSE 'live' END AS liveType,
  {_choice(K, ['carousel', 'telecast', 'webcast'])} AS sourceType,
  'chan' || CAST({K} % 40 AS STRING) AS channelSid,
  'menu' || CAST({K} % 7 AS STRING) AS liveMenuCode,
  'home*live*eagle-webcast*1-' || CAST({K} % 9 AS STRING) AS pathMain,
  CASE WHEN event_type IN ('view', 'purchase') THEN NULL ELSE CAST(floor(value) AS BIGINT) * 30 END AS duration,
  ts AS datetime, CAST(ts AS DATE) AS day
FROM {{events}}""",
    "visit": f"""
SELECT 'u' || CAST(o_custkey AS STRING) AS userId,
  CASE o_orderstatus WHEN 'O' THEN 'enter' WHEN 'F' THEN 'exit' ELSE 'view' END AS event,
  {channel('o_custkey')} AS contentType, {channel('o_orderkey')} || CAST(o_orderkey % 40 AS STRING) AS subjectCode,
  'v' || CAST(o_orderkey % 100 AS STRING) AS videoSid,
  {path('o_custkey', PATHS_2X, 'o_custkey')} AS path,
  CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice / 10) AS BIGINT) ELSE NULL END AS duration,
  '3.1.' || CAST(o_custkey % 9 AS STRING) AS apkVersion, {model('o_custkey')} AS productModel,
  {at(month_day('o_orderdate'), '(o_orderkey * 41) % 86400')} AS datetime, {month_day('o_orderdate')} AS day
FROM {{orders}}""",
    "search": f"""
SELECT 'u' || CAST(o_custkey AS STRING) AS userId, 'v' || CAST(o_orderkey % 100 AS STRING) AS resultSid,
  'name' || CAST(o_orderkey % 100 AS STRING) AS resultName, {channel('o_orderkey')} AS contentType,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'home' WHEN '2-HIGH' THEN 'movie' ELSE 'list' END AS entrance,
  'tab' || CAST(o_orderkey % 3 AS STRING) AS tabName,
  CASE o_orderstatus WHEN 'O' THEN 'entrance' WHEN 'F' THEN 'tabview' ELSE 'click' END AS step,
  {month_day('o_orderdate')} AS day
FROM {{orders}}""",
    "apps": f"""
SELECT 'u' || CAST(user_id AS STRING) AS userId, 'app' || CAST({K} % 30 AS STRING) AS appSid,
  {_choice('user_id + event_id', ['view', 'open', 'install', 'upgrade'])} AS event, CAST(ts AS DATE) AS day
FROM {{events}}""",
    "accountlog": f"""
SELECT 'u' || CAST(user_id AS STRING) AS userId, CAST({K} % 40 AS INT) AS accountId,
  CASE WHEN event_type = 'signup' THEN 'login' ELSE 'access' END AS event,
  {_choice(K, ['home', 'history', 'collect', 'comment'])} AS path, CAST(ts AS DATE) AS day
FROM {{events}}""",
    "crash": f"""
SELECT {mac('user_id')} AS MAC, CASE WHEN user_id % 23 = 0 THEN '3.1.10' ELSE '3.1.' || CAST(user_id % 7 AS STRING) END AS APP_VERSION_NAME,
  CAST(310 + user_id % 7 AS BIGINT) AS APP_VERSION_CODE,
  {_choice(K, ['java.lang.OutOfMemoryError: x', 'java.lang.NullPointerException', 'java.io.IOException'])} AS CRASH_KEY,
  CASE WHEN {K} % 17 = 0 THEN '' ELSE props END AS STACK_TRACE, CAST(20240101 + user_id % 5 AS BIGINT) AS DATE_CODE,
  'P' || CAST(user_id % 4 AS STRING) AS PRODUCT_CODE, CAST(ts AS DATE) AS day
FROM {{events}}""",
    "member": """
SELECT o_custkey AS account_sk, CAST(o_orderkey % 3 AS INT) AS good_sk, o_orderdate AS vip_start_time,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_first_cont_mon_order,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS day
FROM {orders}""",
    "qos": f"""
SELECT {month_day('l_shipdate')} AS day, '3.1.' || CAST(l_partkey % 12 AS STRING) AS apkVersion,
  {at(month_day('l_shipdate'), '(l_orderkey * 37) % 86400')} AS datetime,
  CASE WHEN l_orderkey % 50 = 1 THEN '{{{{"userId": broken'
    ELSE '{{{{"userId":"u' || CAST(l_partkey AS STRING) || '","videoSid":"v' || CAST(l_suppkey AS STRING)
    || '","episodeSid":"e' || CAST(l_suppkey % 37 AS STRING) || '","contentType":"' || {_CT3} || '"'
    || CASE WHEN l_orderkey % 50 = 0 THEN '}}}}'
       WHEN l_orderkey % 50 = 2 THEN ',"playqos":[{{{{"videoSource":"s0","sourceIndex":0}}}}]}}}}'
       ELSE ',"playqos":[{{{{"videoSource":"s' || CAST(l_partkey % 5 AS STRING) || '","sourceIndex":0,"sourcecases":[{{{{"playCode":'
         || {_choice('l_linenumber', ['200', '-1', '-2', '-3'])} || ',"playDuration":' || CAST(l_orderkey % 100 AS STRING)
         || '}}}},{{{{"playCode":200}}}}]}}}},{{{{"videoSource":"s' || CAST((l_partkey + 1) % 5 AS STRING)
         || '","sourceIndex":1,"sourcecases":[{{{{"playCode":' || {_choice('l_orderkey', ['200', '-1', '-3'])} || '}}}}]}}}}]}}}}' END END AS jsonLog
FROM {{lineitem}}""",
    "access": f"""
SELECT page_id, CAST(1 + page_id % 200 AS STRING) || '.2.3.4 - - [' || lpad(CAST(1 + page_id % 28 AS STRING), 2, '0')
  || '/Jan/2024:10:11:12 +0800] "GET /log?logType=' || CASE page_id % 3 WHEN 0 THEN 'play' WHEN 1 THEN 'detail' ELSE 'home%20view' END
  || '&userId=u' || CAST(page_id % 50 AS STRING) || '&duration=' || CASE WHEN page_id % 7 = 0 THEN 'x' ELSE CAST(page_id % 900 AS STRING) END
  || CASE WHEN page_id % 5 = 0 THEN '&a%b=1' ELSE '' END || '&ProductModel=' || CAST(page_id % 9 AS STRING)
  || CASE WHEN page_id % 11 = 0 THEN '' ELSE ' HTTP/1.1" 200 ' || CAST(length(html) AS STRING) END AS value
FROM {{pages}}""",
    # -------------------------------------------------------------- dimensions
    "account": f"""
SELECT p_partkey AS id, 'u' || CAST(p_partkey AS STRING) AS user_id, {mac('p_partkey')} AS mac,
  CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '02:00:00:00:00:00' WHEN 2 THEN 'aa:' || CAST(p_partkey % 170 AS STRING)
    ELSE 'W' || CAST(p_partkey % 700 AS STRING) END AS wifi_mac,
  {at("(DATE '2024-01-01' + CAST(p_partkey % 30 AS INT))", '(p_partkey * 53) % 86400')} AS openTime,
  (DATE '2024-01-01' + CAST(p_partkey % 30 AS INT)) AS day,
  CAST(1 + p_partkey % 30 AS STRING) || '.' || CAST((p_partkey % 30) % 4 AS STRING) || '.7.' || CAST(p_partkey % 256 AS STRING) AS ip,
  {model('p_partkey')} AS product_model, {promo('p_partkey')} AS promotion_channel,
  'Box_3.1.' || CAST(p_partkey % 12 AS STRING) AS current_version,
  CASE WHEN p_size % 3 = 0 THEN 'yun' ELSE 'own' END AS origin_type, CAST(p_size % 4 AS INT) AS userType
FROM {{part}}""",
    # accounts whose MACs and Wi-Fi MACs repeat in chains, and one MAC of a third of all
    "device": f"""
SELECT p_partkey AS id,
  CASE WHEN p_partkey % 3 = 0 THEN 'M0' WHEN p_partkey % 29 = 0 THEN '' WHEN p_partkey % 31 = 0 THEN NULL
    ELSE 'M' || CAST(CAST(floor(p_partkey / 4) AS BIGINT) AS STRING) END AS mac,
  CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '02:00:00:00:00:00'
    ELSE 'W' || CAST(CAST(floor((p_partkey + 2) / 4) AS BIGINT) AS STRING) END AS wifi_mac,
  CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE {model('CAST(floor(p_partkey / 60) AS BIGINT)')} END AS product_model
FROM {{part}}""",
    "program": f"""
SELECT 'v' || CAST(s_suppkey AS STRING) AS sid, s_suppkey AS program_sk, s_name AS title,
  {channel('s_suppkey')} AS content_type_name,
  CASE WHEN s_suppkey % 9 = 0 THEN DATE '2023-01-01' ELSE NULL END AS dim_invalid_time
FROM {{supplier}}""",
    "subject": f"""
SELECT {channel('s_suppkey')} || CAST(s_suppkey % 40 AS STRING) AS subject_code,
  'Title' || CAST(s_suppkey % 40 AS STRING) AS subject_name, {channel('s_suppkey')} AS subject_content_type_name,
  CASE WHEN s_suppkey % 13 = 0 THEN DATE '2023-01-01' ELSE NULL END AS dim_invalid_time
FROM {{supplier}}""",
    "location": """
SELECT CAST((((1 + n_nationkey) * 256 + n_nationkey % 4) * 256 + 7) AS BIGINT) * 256 AS web_location_key,
  CASE WHEN n_regionkey = 4 THEN NULL WHEN n_regionkey = 3 THEN 'Elsewhere' ELSE '中国' END AS country,
  n_name AS province, 'city' || CAST(n_nationkey AS STRING) AS city,
  CASE WHEN n_nationkey % 8 = 7 THEN DATE '2023-01-01' ELSE NULL END AS dim_invalid_time
FROM {nation}""",
    "ip_range": """
SELECT CAST(1 + n_nationkey AS STRING) || '.0.0.0' AS lo, CAST(1 + n_nationkey AS STRING) || '.1.255.255' AS hi,
  'C' || CAST(n_regionkey AS STRING) AS country, n_name AS province, 'city' || CAST(n_nationkey AS STRING) AS city
FROM {nation}""",
    "ip_prefix": """
SELECT CASE WHEN n_regionkey < 2 THEN CAST(1 + n_nationkey AS STRING) || '.' || CAST(n_nationkey % 4 AS STRING) || '.7'
    ELSE '250.250.' || CAST(n_nationkey AS STRING) END AS prefix,
  'P' || CAST(n_regionkey AS STRING) AS country, n_name AS province, 'pcity' AS city
FROM {nation}""",
    "brand": """
SELECT 'model' || CAST(n_nationkey AS STRING) AS product_model, 'Brand' || CAST(n_regionkey AS STRING) AS brand_name,
  CASE WHEN n_nationkey % 6 = 5 THEN DATE '2023-01-01' ELSE NULL END AS dim_invalid_time
FROM {nation}""",
    "mac_brand": """
SELECT CASE r_regionkey WHEN 0 THEN '001A9A' WHEN 1 THEN '0022D10F' ELSE 'ABCDE' || CAST(r_regionkey AS STRING) END AS prefix,
  'Maker' || CAST(r_regionkey AS STRING) AS brand
FROM {region}""",
    "application": """
SELECT 'app' || CAST(n_nationkey AS STRING) AS application_sid, n_name AS application_name,
  CASE WHEN n_regionkey = 4 THEN DATE '2023-01-01' ELSE NULL END AS dim_invalid_time
FROM {nation}""",
    "livemenu": """
SELECT CASE WHEN n_nationkey < 6 THEN 'menu' ELSE 'nomenu' END || CAST(n_nationkey AS STRING) AS menu_code, n_name AS menu_name
FROM {nation}""",
    "person": """
SELECT c_custkey AS id, CASE WHEN c_custkey % 19 = 0 THEN '' WHEN c_custkey % 17 = 0 THEN '3月1日' WHEN c_custkey % 23 = 0 THEN 'x9'
    ELSE CAST(1940 + c_custkey % 83 AS STRING) END AS birth,
  CASE c_custkey % 6 WHEN 0 THEN 'F' WHEN 1 THEN 'm' WHEN 2 THEN 'o' WHEN 3 THEN '' WHEN 4 THEN '0' ELSE 'zz' END AS gender,
  CASE c_nationkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'prov1,city' || CAST(c_nationkey AS STRING) WHEN 2 THEN 'prov2;市辖区'
    WHEN 3 THEN 'prov3' ELSE 'prov4,a;b;c' END AS area
FROM {customer}""",
}

_REF = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


def needs(sql: str) -> list[str]:
    return list(dict.fromkeys(_REF.findall(sql)))


class Tables:
    """The logs and dimensions of one data directory, made on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        made = self._made
        if name not in made:
            if name in STANDINS:
                sql = STANDINS[name]
                made[name] = self.spark.sql(sql, **{n: getattr(self, n) for n in needs(sql)})
            elif name in BASE:
                made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                raise AttributeError(name)
        return made[name]


def check_sql(name: str) -> str:
    """The stand-in as plain SQL over table names."""
    sql = STANDINS[name]
    return sql.format(**{n: n for n in needs(sql)})
