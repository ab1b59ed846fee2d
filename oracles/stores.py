from .base import VERSION
from .core import EXTRA, SQL, check
from .retention import WIFI

# one account after the other, each compared with the kept ones among all before it
EXTRA["numbered"] = f"SELECT *, row_number() OVER (ORDER BY id) AS n, nullif(mac, '') AS m, {WIFI} AS w, upper(replace(wifi_mac, ':', '')) AS anyw FROM device"
SHARED = "coalesce(o.product_model IN ('model1', 'model4', 'model9'), false)"


def scan(match: str) -> str:
    columns = "id, n, m, w, anyw, product_model"
    earlier = f"(SELECT min(r.id) FROM recurring.scan r WHERE r.original IS NULL AND ({match}))"
    return f"""SELECT id, original IS NOT NULL AS is_duplicate, original FROM (
 WITH RECURSIVE scan USING KEY (n) AS (
  SELECT {columns}, CAST(NULL AS BIGINT) AS original FROM numbered WHERE n = 1
  UNION SELECT {', '.join('o.' + c for c in columns.split(', '))}, {earlier} FROM scan s JOIN numbered o ON o.n = s.n + 1)
 SELECT * FROM scan)"""


check("account_migration", scan("r.m = o.m OR r.w = o.w"))
BY_MODEL = f"r.product_model = o.product_model AND CASE WHEN o.w IS NULL THEN r.m = o.m WHEN {SHARED} THEN r.anyw = o.anyw ELSE r.anyw = o.anyw AND r.m = o.m END"
check("account_migration_by_model", scan(BY_MODEL))
check("account_migration_listed_models", scan(f"{SHARED} AND {BY_MODEL}"))

check("area_logins_rewritten", f"""SELECT CAST(day AS VARCHAR) AS day, v AS version, count(userId) AS logins, count(DISTINCT userId) AS users FROM (SELECT day, userId, k, {VERSION} AS v FROM login)
WHERE day NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-11' OR (day = DATE '2024-01-11' AND k < 50) GROUP BY 1, 2""")
SQL["retention_upserted"] = SQL["retention_new_users_wide"]

EXTRA["grown"] = """SELECT day, CASE WHEN k % 4 = 0 THEN '2x' ELSE '3x' END AS product, log_type, userId,
 CASE WHEN day >= DATE '2024-01-11' THEN productModel END AS productModel, CASE WHEN day >= DATE '2024-01-11' THEN k END AS k FROM login"""
SCANS = {
    "one": "product = '3x' AND log_type = 'view' AND day = DATE '2024-01-12'",
    "list": "product = '3x' AND log_type = 'click' AND day IN (DATE '2024-01-09', DATE '2024-01-11', DATE '2024-01-20')",
    "types": "log_type IN ('view', 'signup') AND day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'",
    "but": "log_type NOT IN ('view', 'purchase') AND day = DATE '2024-01-10'",
}
check("scans_of_partitioned_logs", " UNION ALL ".join(
    f"""SELECT '{name}' AS scan, CAST(day AS VARCHAR) AS day, product, log_type, count(userId) AS plays, count(DISTINCT userId) AS users,
 count(productModel) AS models, sum(k) AS k_sum FROM grown WHERE {where} GROUP BY ALL""" for name, where in SCANS.items()))

check("hourly_counts_of_a_file_stream", "SELECT CAST(date_trunc('hour', datetime) AS VARCHAR) AS start, log_type, count(userId) AS pv, count(DISTINCT userId) AS uv FROM login GROUP BY 1, 2")
