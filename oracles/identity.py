from .core import EXTRA, START, check, duration, pv_uv
from .retention import WIFI

EXTRA["wired"] = f"SELECT *, {WIFI} AS w, upper(replace(wifi_mac, ':', '')) AS anyw FROM account"
EXTRA["marked"] = """SELECT a.*, least((SELECT min(b.id) FROM wired b WHERE b.mac = a.mac AND b.id < a.id), (SELECT min(b.id) FROM wired b WHERE b.w = a.w AND b.id < a.id)) AS original FROM wired a"""


def acted(cohort, actions, keys=(), horizon=14):
    k = "".join(f"{x}, " for x in keys)
    return f"""SELECT {k}count(DISTINCT user_id) AS new_users, count(DISTINCT CASE WHEN EXISTS (SELECT 1 FROM {actions} p WHERE p.userId = c.user_id AND p.day - c.day BETWEEN 0 AND {horizon - 1}) THEN user_id END) AS acted_users
 FROM (SELECT * FROM {cohort}) c{' GROUP BY ' + ', '.join(keys) if keys else ''}"""


ACTIONS = "(SELECT DISTINCT userId, day FROM (SELECT userId, day FROM play UNION ALL SELECT userId, day FROM home UNION ALL SELECT userId, day FROM visit))"
check("acted_among_rejected", acted("marked WHERE original IS NOT NULL", ACTIONS))
check("played_among_accepted", acted("marked WHERE original IS NULL", "play"))
check("played_per_model", acted("account", "play", ["product_model"], 3))
check("played_per_channel", acted("account", "play", ["promotion_channel"], 3))
EXTRA["alarmed"] = """SELECT wifi_mac, count(*) AS n FROM account WHERE wifi_mac IS NOT NULL AND wifi_mac <> '' GROUP BY 1
 HAVING count(*) >= 3 AND count(*) FILTER (day BETWEEN DATE '2024-01-10' AND DATE '2024-01-16') > 0"""
check("duplicate_wifi_macs", """SELECT '1' AS type, wifi_mac AS key, NULL AS part, n FROM alarmed
UNION ALL SELECT '2', wifi_mac, promotion_channel, count(*) FROM account WHERE wifi_mac IN (SELECT wifi_mac FROM alarmed) GROUP BY 2, 3
UNION ALL SELECT '3', wifi_mac, product_model, count(*) FROM account WHERE wifi_mac IN (SELECT wifi_mac FROM alarmed) GROUP BY 2, 3
UNION ALL SELECT '4', ip, NULL, count(*) FROM account WHERE wifi_mac IS NOT NULL AND wifi_mac <> '' AND day BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' GROUP BY 2 HAVING count(*) >= 2""")
check("account_duplicates", "SELECT id, user_id, original IS NOT NULL AS is_duplicate, original FROM marked")
SHARED = "product_model IN ('model1', 'model4', 'model9')"
EXTRA["by_model"] = f"""SELECT a.*, (SELECT min(b.id) FROM wired b WHERE b.id < a.id AND b.product_model = a.product_model AND CASE WHEN a.w IS NULL THEN b.mac = a.mac WHEN a.{SHARED} THEN b.anyw = a.anyw ELSE b.anyw = a.anyw AND b.mac = a.mac END) AS original FROM wired a"""
check("account_duplicates_by_model", "SELECT id, original IS NOT NULL AS is_duplicate, original FROM by_model")
check("account_duplicates_listed_models", f"SELECT id, {SHARED} AND original IS NOT NULL AS is_duplicate, CASE WHEN {SHARED} THEN original END AS original FROM by_model")
LW = WIFI.replace("wifi_mac", "wifiMac")
check("anonymous_logins_without_account", f"""SELECT DISTINCT CAST(NULL AS VARCHAR) AS userId, mac, wifiMac, productModel FROM (SELECT *, {LW} AS w FROM login) l WHERE (log_type <> 'click' OR userId IS NULL) AND productModel IN ('model1', 'model4', 'model9')
 AND NOT EXISTS (SELECT 1 FROM wired a WHERE a.openTime <= TIMESTAMP '2024-01-15 00:00:00' AND a.mac = l.mac AND a.product_model = l.productModel AND (l.w IS NULL OR a.anyw = l.w))""")
check("accepted_users_per_channel", "SELECT CAST(day AS VARCHAR) AS day, promotion_channel, count(DISTINCT user_id) AS n FROM marked WHERE original IS NULL GROUP BY 1, 2")
check("watch_time_of_rejected", duration("play", [], "userId IN (SELECT user_id FROM marked WHERE original IS NOT NULL)", avg="average"))
