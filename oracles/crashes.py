from .core import EXTRA, check

check("crashes_per_device", "SELECT MAC, md5(STACK_TRACE) AS stack_md5, PRODUCT_CODE, DATE_CODE, count(*) AS n FROM crash GROUP BY 1, 2, 3, 4")
LEVELS = [("APP_VERSION_NAME", "DATE_CODE", "PRODUCT_CODE"), ("APP_VERSION_NAME", "DATE_CODE"), ("PRODUCT_CODE",), ()]
COLS = ("APP_VERSION_NAME", "DATE_CODE", "PRODUCT_CODE")


def trend(cap):
    base = f"""(SELECT * FROM (SELECT * REPLACE (replace(MAC, ':', '') AS MAC), count(*) OVER (PARTITION BY replace(MAC, ':', ''), APP_VERSION_NAME, APP_VERSION_CODE, DATE_CODE, PRODUCT_CODE, CRASH_KEY, STACK_TRACE) AS c FROM crash
 WHERE STACK_TRACE <> '' AND length(APP_VERSION_NAME) = 5 AND length(CAST(DATE_CODE AS VARCHAR)) <= 20 AND replace(MAC, ':', '') NOT IN (SELECT replace(mac, ':', '') FROM account WHERE userType = 3)) WHERE {f'c <= {cap}' if cap else 'TRUE'})"""
    parts = []
    for kind, cond in (("All", "TRUE"), ("OOM", "CRASH_KEY LIKE '%OutOfMemoryError%'"), ("NPE", "CRASH_KEY LIKE '%NullPointerException%'")):
        for level in LEVELS:
            keys = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c in level else f"'All' AS {c}" for c in COLS)
            group = " GROUP BY " + ", ".join(level) if level else " HAVING count(*) > 0"
            parts.append(f"SELECT '{kind}' AS crash_type, {keys}, count(*) AS crashes, count(DISTINCT MAC) AS devices FROM {base} WHERE {cond}{group}")
    return " UNION ALL ".join(parts)


check("crash_trend", trend(None))
check("crash_trend_without_noise", trend(2))
HL = [("apkVersion", "locationIndex", "productModel"), ("apkVersion", "locationIndex"), ("productModel",), ()]


def levels(value, cond):
    parts = []
    for level in HL:
        keys = ", ".join(f"{c} AS {c}" if c in level else f"'All' AS {c}" for c in HL[0])
        group = " GROUP BY " + ", ".join(level) if level else ""
        parts.append(f"SELECT {keys}, {value} FROM home WHERE length(apkVersion) = 5 AND {cond}{group}")
    return " UNION ALL ".join(parts)


check("daily_activity_levels", f"SELECT apkVersion, locationIndex, productModel, users, logins FROM ({levels('count(DISTINCT userId) AS users', 'TRUE')}) JOIN ({levels('count(*) AS logins', chr(39).join(['event = ', 'click', '']))}) USING (apkVersion, locationIndex, productModel)")
check("activity_without_version", " UNION ALL ".join(f"SELECT 'All but {v}' AS version, count(*) AS pv, count(DISTINCT userId) AS uv FROM home WHERE length(apkVersion) = 5 AND apkVersion <> '{v}'" for v in ("3.1.4", "3.1.5")))
