from .base import NORMAL, VERSION
from .core import EXTRA, check, current, one_per_key, pv_uv, pv_uv_null, side_by_side
from .live import LABELS, per_period

V = f"{VERSION} AS version"
AV = "list_last(string_split(current_version, '_'))"
check("daily_overview", """SELECT day, logins, login_users, new_users, login_users - new_users AS active_users, CAST(sum(new_users) OVER (ORDER BY day) AS BIGINT) AS total_users FROM (
 SELECT CAST(day AS VARCHAR) AS day, coalesce(logins, 0) AS logins, coalesce(login_users, 0) AS login_users, coalesce(new_users, 0) AS new_users FROM
 (SELECT day, count(mac) AS logins, count(DISTINCT mac) AS login_users FROM login GROUP BY 1) FULL JOIN (SELECT day, count(DISTINCT mac) AS new_users FROM account GROUP BY 1) USING (day))""")
check("weekly_active", f"""SELECT start, active, new_users, CAST(sum(new_users) OVER (ORDER BY start) AS BIGINT) AS total FROM (SELECT start, coalesce(active, 0) AS active, coalesce(new_users, 0) AS new_users FROM
 (SELECT {LABELS['week']} AS start, count(DISTINCT mac) AS active FROM login GROUP BY 1) FULL JOIN (SELECT {LABELS['week']} AS start, count(DISTINCT mac) AS new_users FROM account GROUP BY 1) USING (start))""")
check("monthly_active", per_period("login", ["month"]))
NETA = "((CAST(split_part(ip, '.', 1) AS BIGINT) * 256 + CAST(split_part(ip, '.', 2) AS BIGINT)) * 256 + 7) * 256"
EXTRA["placed_account"] = f"SELECT account.*, country, province FROM account LEFT JOIN {current('location')} ON web_location_key = {NETA}"
AREA = "CASE WHEN country = '中国' THEN province ELSE '国外及其他' END AS area"
check("areas", f"""SELECT area, coalesce(logins, 0) AS logins, coalesce(users, 0) AS users, coalesce(new_users, 0) AS new_users, coalesce(total_users, 0) AS total_users, coalesce(users, 0) - coalesce(new_users, 0) AS active_users FROM
 (SELECT {AREA}, count(mac) AS logins, count(DISTINCT mac) AS users FROM placed_login WHERE day = DATE '2024-01-20' GROUP BY 1)
 FULL JOIN (SELECT {AREA}, count(DISTINCT CASE WHEN day = DATE '2024-01-20' THEN mac END) AS new_users, count(DISTINCT mac) AS total_users FROM placed_account WHERE day <= DATE '2024-01-20' GROUP BY 1) USING (area)""")
check("versions_new_total_active", f"""SELECT v, new_users, total_users, active_users FROM
 (SELECT {AV} AS v, count(DISTINCT user_id) AS new_users FROM account WHERE day = DATE '2024-01-20' GROUP BY 1) JOIN (SELECT {AV} AS v, count(DISTINCT user_id) AS total_users FROM account WHERE day <= DATE '2024-01-20' GROUP BY 1) USING (v)
 JOIN (SELECT {VERSION} AS v, count(DISTINCT userId) AS active_users FROM login WHERE day = DATE '2024-01-20' GROUP BY 1) USING (v)""")
NORMA = "CASE WHEN promotion_channel IS NULL THEN 'null' WHEN promotion_channel = '' THEN 'kong' ELSE promotion_channel END AS channel"
NORML = NORMA.replace("promotion_channel", "promotionChannel")
check("new_users_per_version_and_channel", f"SELECT {AV} AS version, {NORMA}, count(DISTINCT user_id) AS new_users FROM account GROUP BY 1, 2")
check("logins_per_version", pv_uv_null("login", ["day", V]))
check("login_hours_per_version", f"SELECT version, hour, uv FROM ({pv_uv_null('login', [V, 'CAST(hour(datetime) AS INT) AS hour'])})")
check("login_count_buckets", f"""SELECT version, CASE WHEN c <= 3 THEN '登入' || CAST(c AS VARCHAR) || '次' WHEN c <= 5 THEN '登入4-5次' WHEN c <= 8 THEN '登入6-8次' WHEN c <= 15 THEN '登入9-15次' ELSE '登入大于15次' END AS bucket, count(*) AS users
 FROM (SELECT {V}, userId, count(*) AS c FROM login GROUP BY ALL) GROUP BY 1, 2""")
check("logins_per_device_brand", pv_uv_null("(SELECT login.*, coalesce(a.brand, b.brand, 'other') AS brand FROM login LEFT JOIN mac_brand a ON substr(mac, 1, 6) = a.prefix LEFT JOIN mac_brand b ON substr(mac, 1, 8) = b.prefix)", ["day", "brand"]))
BRAND = f"LEFT JOIN {one_per_key('brand', 'product_model', 'brand_name', 'bn')} bb ON productModel = bb.product_model"
check("logins_per_model_and_brand", pv_uv_null(f"(SELECT login.*, coalesce(bn, '其他品牌') AS brand FROM login {BRAND})", ["productModel", "brand"]))
check("new_users_per_model", "SELECT product_model, CAST(day AS VARCHAR) AS day, count(DISTINCT user_id) AS new_users FROM account GROUP BY 1, 2")


def chan(logs):
    return f"""SELECT channel, coalesce(logins, 0) AS logins, coalesce(users, 0) AS users, coalesce(new_users, 0) AS new_users FROM
 (SELECT {NORML}, count(mac) AS logins, count(DISTINCT mac) AS users FROM {logs} WHERE promotionChannel IS DISTINCT FROM 'ch7' GROUP BY 1)
 FULL JOIN (SELECT {NORMA}, count(DISTINCT mac) AS new_users FROM account WHERE promotion_channel IS DISTINCT FROM 'ch7' GROUP BY 1) USING (channel)"""


check("channels_new_and_logins", chan("login"))
check("channels_of_two_products", chan("(SELECT mac, promotionChannel FROM login UNION ALL SELECT userId, promotionChannel FROM play2)"))
check("kids_channels", pv_uv_null("play2", [f"{NORMAL} AS channel"], "contentType = 'kids'"))
check("kids_access", pv_uv_null("play2", ["day"], "contentType = 'kids'"))


def dogs(table, col, cond=None):
    w = f" WHERE {cond}" if cond else ""
    return f"""SELECT CAST(day AS VARCHAR) AS day, count(DISTINCT mac) AS all_users, count(DISTINCT CASE WHEN {col} LIKE '%3.1.1%' THEN mac END) AS ali_users, count(DISTINCT CASE WHEN {col} LIKE '%3.1.2%' THEN mac END) AS tv_users,
 count(DISTINCT CASE WHEN {col} NOT LIKE '%3.1.1%' AND {col} NOT LIKE '%3.1.2%' THEN mac END) AS other_users FROM {table}{w} GROUP BY 1"""


check("yun_active", dogs("login", "version"))
check("yun_new", dogs("account", "current_version", "origin_type = 'yun'"))
check("yun_channels", side_by_side({"new_users": "SELECT promotion_channel AS channel, count(DISTINCT mac) AS new_users FROM account WHERE origin_type = 'yun' GROUP BY 1",
      "active": "SELECT promotionChannel AS channel, count(DISTINCT mac) AS active FROM login WHERE promotionChannel LIKE 'ch1%' GROUP BY 1"}, ["channel"]))
check("yun_logins", pv_uv_null("login", ["day"], "version LIKE '%3.1.1%'", user="mac"))
check("yun_new_total", "SELECT count(DISTINCT mac) AS new_users FROM account WHERE origin_type = 'yun'")
KIND = "CASE WHEN {0} LIKE '%3.1.1%' THEN 'ali' WHEN {0} LIKE '%3.1.2%' THEN 'tv' ELSE 'other' END AS version"
check("dogs_active_and_new", f"SELECT version, coalesce(pv, 0) AS pv, coalesce(uv, 0) AS uv, coalesce(new_users, 0) AS new_users FROM (SELECT {KIND.format('login.version')}, count(mac) AS pv, count(DISTINCT mac) AS uv FROM login GROUP BY 1) FULL JOIN (SELECT {KIND.format('current_version')}, count(DISTINCT mac) AS new_users FROM account GROUP BY 1) USING (version)")
check("open_api_users", "SELECT '2024-01-' || lpad(CAST(1 + page_id % 28 AS VARCHAR), 2, '0') AS day, count(*) AS pv, count(DISTINCT page_id % 50) AS uv FROM pages WHERE page_id % 11 <> 0 AND page_id % 3 = 0 GROUP BY 1")
check("devices_per_province", "SELECT coalesce(province, '未知') AS province, count(*) AS n FROM placed_account GROUP BY 1")
check("total_and_average_time", f"SELECT CAST(day AS VARCHAR) AS day, count(userId) AS pv, count(DISTINCT userId) AS uv, CAST(sum(duration) AS BIGINT) AS duration, {LABELS['week']} AS week, sum(duration) / NULLIF(count(DISTINCT userId), 0) AS average FROM login WHERE duration BETWEEN 0 AND 54000 GROUP BY login.day")
BUCKET = """CASE WHEN duration <= 30 THEN '0-30s' WHEN duration <= 60 THEN '30-60s' WHEN duration <= 180 THEN '60-180s' WHEN duration <= 300 THEN '180-300s' WHEN duration <= 900 THEN '5-15min' WHEN duration <= 1800 THEN '15-30min'
 WHEN duration <= 3600 THEN '30-60min' WHEN duration <= 7200 THEN '1-2h' WHEN duration <= 10800 THEN '2-3h' WHEN duration <= 14400 THEN '3-4h' WHEN duration <= 18000 THEN '4-5h' WHEN duration <= 21600 THEN '5-6h' ELSE '>6h' END AS bucket"""
check("session_length_buckets", pv_uv_null("login", ["day", BUCKET]))
EXTRA["all_logs"] = " UNION ALL ".join(f"SELECT userId, day FROM {t}" for t in ("play", "home", "visit", "livelog", "login"))
check("active_over_all_logs", "SELECT CAST(day AS VARCHAR) AS day, count(DISTINCT userId) AS uv FROM all_logs GROUP BY 1")
check("active_per_period_over_all_logs", f"SELECT period, start, uv FROM ({per_period('all_logs', ['day', 'week', 'month'])})")
check("active_per_major_version", "SELECT CASE WHEN apkVersion IS NULL THEN '未知' ELSE substr(apkVersion, 1, 1) END AS major, count(DISTINCT userId) AS uv FROM (SELECT userId, apkVersion FROM play UNION ALL SELECT userId, apkVersion FROM home UNION ALL SELECT userId, apkVersion FROM visit) GROUP BY 1")
check("active_per_brand_and_channel", pv_uv(f"(SELECT play.*, coalesce(bn, '其他品牌') AS brand FROM play {BRAND})", ["brand", "promotionChannel"]))
check("model_users_per_period", f"SELECT period, start, productModel, uv FROM ({per_period('play', ['week', 'month'], ['productModel'])})")
check("weekly_new_version_logins", per_period("login", ["week"], cond=f"{VERSION} >= '3.1.4'"))
