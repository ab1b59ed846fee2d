from viewtally.plans.launcher import CLICKS

from .core import check, current, pv_uv, pv_uv_null

for name, c in CLICKS.items():
    parts = []
    for literal in c.literals:
        cond = [f"contains({c.source}, '{literal}')"]
        if c.event:
            cond.append(f"contains(event, '{c.event}')" if c.type_col else f"event = '{c.event}'")
        if c.type_col:
            cond.append(f"contains({c.type_col}, '{c.type_value}')")
        hour = "CAST(hour(datetime) AS INT) AS hour, " if c.hourly else ""
        group = " GROUP BY 1, 2" if c.hourly else " GROUP BY 1"
        parts.append(f"SELECT '{literal}' AS literal, {hour}count(userId) AS pv, count(DISTINCT userId) AS uv FROM {c.log} WHERE {' AND '.join(cond)}{group}")
    check(name, " UNION ALL ".join(parts))

check("enter_application", pv_uv("home", ["day"]))
check("launcher_views", pv_uv("home", ["day"], "event = 'view'"))
check("launcher_view_duration", "SELECT CAST(sum(duration) AS BIGINT) AS duration FROM home WHERE event = 'view'")
check("launcher_clicks", pv_uv("home", ["day"], "event = 'click'"))
check("start_pages", pv_uv_null("home", ["apkVersion", "accessArea"]))
check("launcher_clicks_by_city", pv_uv(f"""(SELECT h.*, coalesce(city, '未知') AS city FROM home h LEFT JOIN account a ON h.userId = a.user_id LEFT JOIN {current('location')} l
  ON web_location_key = ((CAST(split_part(ip, '.', 1) AS BIGINT) * 256 + CAST(split_part(ip, '.', 2) AS BIGINT)) * 256 + 7) * 256)""", ["accessArea", "accessLocation", "city"], "event = 'click'"))
FN = [("home", "event = 'click'", "launcher"), ("search", "step = 'click'", "search"), ("visit", "event = 'enter'", "collect_ok"), ("visit", "event = 'exit'", "collect_cancel"),
      ("apps", "event = 'install'", "install"), ("accountlog", "event = 'login'", "login"), ("livelog", "event = 'startplay'", "live"), ("play2", "TRUE", "play")]
check("function_use", " UNION ALL ".join(f"SELECT '{f}' AS function, count(userId) AS pv, count(DISTINCT userId) AS uv FROM {t} WHERE {c}" for t, c, f in FN))
check("article_entrances", pv_uv_null("search", ["CASE entrance WHEN 'home' THEN 'homepage' WHEN 'movie' THEN 'detail' ELSE 'others' END AS entrance"]))
