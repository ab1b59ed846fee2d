from . import retention  # noqa: F401
from .core import EXTRA, START, check, current, duration, one_per_key, pv_uv
from .live import per_period
from .logins import AV, NETA

S314 = "version >= '3.1.4'"
check("upgraded_devices", f"""WITH f AS (SELECT mac, min(day) AS day FROM seen WHERE {S314} GROUP BY 1) SELECT f.mac, CAST(f.day AS VARCHAR) AS day,
 (SELECT userId FROM seen s WHERE s.mac = f.mac AND s.day = f.day AND {S314} ORDER BY userId NULLS FIRST LIMIT 1) AS userId FROM f""")
check("upgraded_users", f"SELECT userId, CAST(min(day) AS VARCHAR) AS day FROM seen WHERE {S314} AND userId IS NOT NULL GROUP BY 1")
check("upgraded_devices_315", "SELECT mac, CAST(min(day) AS VARCHAR) AS day FROM seen WHERE version = '3.1.5' GROUP BY 1")
check("upgraded_devices_316", "SELECT mac, CAST(min(day) AS VARCHAR) AS day FROM seen WHERE version = '3.1.6' GROUP BY 1")
check("upgrades_new_and_total", f"""SELECT CAST(day AS VARCHAR) AS day, new_devices, new_users, CAST(sum(new_devices) OVER (ORDER BY day) AS BIGINT) AS total_devices, CAST(sum(new_users) OVER (ORDER BY day) AS BIGINT) AS total_users FROM
 (SELECT day, coalesce(new_devices, 0) AS new_devices, coalesce(new_users, 0) AS new_users FROM (SELECT day, count(*) AS new_devices FROM (SELECT mac, min(day) AS day FROM seen WHERE {S314} GROUP BY 1) GROUP BY 1)
 FULL JOIN (SELECT day, count(*) AS new_users FROM (SELECT userId, min(day) AS day FROM seen WHERE {S314} AND userId IS NOT NULL GROUP BY 1) GROUP BY 1) USING (day))""")
check("adoption", f"SELECT CAST(day AS VARCHAR) AS day, count(DISTINCT CASE WHEN {S314} THEN mac END) AS adopted, count(DISTINCT mac) AS users, count(DISTINCT CASE WHEN {S314} THEN mac END) / count(DISTINCT mac) AS share FROM seen GROUP BY 1")
K = f"CASE WHEN {S314} THEN 'new' ELSE 'old' END AS kind"
check("login_new_active_by_version_class", f"""SELECT CAST(day AS VARCHAR) AS day, kind, logins, login_users, coalesce(new_users, 0) AS new_users, login_users - coalesce(new_users, 0) AS active_users FROM
 (SELECT day, {K}, count(mac) AS logins, count(DISTINCT mac) AS login_users FROM seen GROUP BY 1, 2) LEFT JOIN (SELECT day, {K}, count(DISTINCT mac) AS new_users FROM opened GROUP BY 1, 2) USING (day, kind)""")
EXTRA["hours_seen"] = "SELECT login.*, CASE WHEN version IS NULL THEN 'null' WHEN version = '' THEN 'kong' ELSE list_last(string_split(version, '_')) END AS v FROM login"
check("hourly_logins_new_version", "SELECT CAST(day AS VARCHAR) AS day, CAST(hour(datetime) AS INT) AS hour, count(DISTINCT mac) AS uv FROM hours_seen WHERE v >= '3.1.4' GROUP BY 1, 2")
check("weekly_logins_new_version", f"SELECT period, start, uv FROM ({per_period('seen', ['week'], cond=S314, user='mac')})")
check("monthly_logins_new_version", f"SELECT period, start, uv FROM ({per_period('seen', ['month'], cond=S314, user='mac')})")
check("province_logins_new_version", f"""SELECT CASE WHEN country = '中国' THEN province ELSE '国外及其他' END AS province, count(DISTINCT mac) AS uv FROM (SELECT h.*, country, province FROM hours_seen h LEFT JOIN {current('location')} l
 ON web_location_key = CASE WHEN ip = 'x.y' THEN 0 ELSE {NETA} END) WHERE v >= '3.1.4' GROUP BY 1""")
EXTRA["licensed"] = "SELECT * FROM play WHERE videoSid IN (SELECT sid FROM program WHERE dim_invalid_time IS NULL)"
M = f"CAST(count(*) AS BIGINT) AS rows, count(DISTINCT userId) AS uv, CAST(count(*) FILTER ({START}) AS BIGINT) AS starts, CAST(sum(duration) FILTER (event <> 'startplay' AND duration BETWEEN 0 AND 10800) AS BIGINT) AS duration"
check("copyright_plays", f"""SELECT 'All' AS contentType, 'All' AS videoSid, {M} FROM licensed UNION ALL SELECT contentType, 'All', {M} FROM licensed GROUP BY 1 UNION ALL SELECT contentType, videoSid, {M} FROM licensed GROUP BY 1, 2""")


def ratio(version, cond="TRUE"):
    return f"""SELECT p.version, p.contentType, play_users, click_users, play_users / NULLIF(click_users, 0) AS ratio FROM
 (SELECT {version} AS version, contentType, count(DISTINCT userId) AS play_users FROM play WHERE {START} AND {cond} GROUP BY 1, 2) p
 JOIN (SELECT {version} AS version, contentType, count(DISTINCT userId) AS click_users FROM visit WHERE {cond} GROUP BY 1, 2) c ON p.version IS NOT DISTINCT FROM c.version AND p.contentType = c.contentType"""


check("play_ratio_by_version_class", ratio("CASE WHEN apkVersion >= '3.1.4' THEN 'new' ELSE 'old' END"))
check("play_ratio_313", ratio("apkVersion", "apkVersion = '3.1.3'"))
check("play_ratio_per_version", ratio("apkVersion"))
EXTRA["loyal"] = f"""SELECT DISTINCT 'outflow' AS userType, mac FROM seen s WHERE day = DATE '2024-01-10' AND {S314} AND mac NOT IN (SELECT mac FROM seen WHERE day BETWEEN DATE '2024-01-11' AND DATE '2024-01-15')
 UNION ALL SELECT DISTINCT 'active', mac FROM seen WHERE day = DATE '2024-01-10' AND mac IN (SELECT mac FROM seen WHERE day BETWEEN DATE '2024-01-11' AND DATE '2024-01-15' GROUP BY 1 HAVING count(DISTINCT day) >= 3)"""
check("outflow_and_active_users", "SELECT userType, mac FROM loyal")
check("plays_of_outflow_and_active", pv_uv("(SELECT p.*, g.userType FROM play p JOIN (SELECT DISTINCT loyal.userType AS userType, user_id FROM loyal JOIN account ON loyal.mac = account.mac) g ON p.userId = g.user_id)", ["userType", "contentType"], START))
ACT = f"""SELECT l.version, login_users, total_users, login_users / NULLIF(total_users, 0) AS ratio FROM (SELECT version, count(DISTINCT mac) AS login_users FROM seen GROUP BY 1) l JOIN (SELECT {AV} AS version, count(DISTINCT mac) AS total_users FROM account GROUP BY 1) a USING (version)"""
check("activity_ratio_313", ACT + " WHERE l.version = '3.1.3'")
check("activity_ratio_per_version", ACT)


def averages(cond=None):
    return f"SELECT *, pv / NULLIF(uv, 0) AS avg_plays, duration / 3600 / NULLIF(uv, 0) AS avg_hours FROM ({duration('play', ['apkVersion', 'contentType'], cond)})"


check("average_plays_313", averages("apkVersion = '3.1.3' AND contentType IN ('movie', 'tv', 'zongyi', 'kids')"))
check("average_plays_per_version", averages())
PLAYERS = f"""SELECT version, play_users, login_users, play_users / NULLIF(login_users, 0) AS ratio FROM (SELECT apkVersion AS version, count(DISTINCT userId) AS play_users FROM play WHERE {START} GROUP BY 1)
 JOIN (SELECT version, count(DISTINCT userId) AS login_users FROM seen GROUP BY 1) USING (version)"""
check("play_user_ratio_313", PLAYERS + " WHERE version = '3.1.3'")
check("play_user_ratio_per_version", PLAYERS)
check("daily_and_total_of_two_versions", f"""SELECT version, CAST(day AS VARCHAR) AS day, daily_users, total_users FROM (SELECT day, version, count(DISTINCT mac) AS daily_users FROM seen WHERE version = '3.1.3' OR (version = '3.1.4' AND day >= DATE '2024-01-15') GROUP BY 1, 2)
 LEFT JOIN (SELECT {AV} AS version, count(DISTINCT mac) AS total_users FROM account GROUP BY 1) USING (version)""")
