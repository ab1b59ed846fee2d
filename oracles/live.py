from .core import EXTRA, check, duration, one_per_key, pv_uv

EXTRA["livetv"] = "SELECT * FROM livelog WHERE liveType = 'live'"
S = "event = 'startplay'"
check("carousel_totals", "SELECT *, pv / NULLIF(uv, 0) AS plays_per_user, duration / 60 / NULLIF(uv, 0) AS minutes_per_user FROM (" + duration("livetv", ["day"], "sourceType = 'carousel'", high=36000) + ")")
for name in ("carousel", "telecast", "webcast"):
    for order, word in (("uv", "users"), ("pv", "plays")):
        check(f"top_{name}_by_{word}", f"SELECT *, row_number() OVER (ORDER BY {order} DESC, channel) AS rank FROM ({pv_uv('livetv', ['channelSid AS channel'], f'{S} AND sourceType = {chr(39)}{name}{chr(39)}')}) QUALIFY rank <= 10")
check("carousel_subscriptions", pv_uv("livelog", ["day"], "sourceType = 'carousel' AND liveType = 'vod'"))
check("carousel_switches", pv_uv("livelog", ["day"], "sourceType = 'carousel' AND event = 'switchchannel'"))
check("webcast_tree", duration("livetv", ["split_part(pathMain, '*', 4) AS tree"], "sourceType = 'webcast'", high=36000, dur_users="dur_users"))
EXTRA["menued"] = "SELECT livetv.*, coalesce(menu_name, 'other') AS category FROM livetv LEFT JOIN livemenu ON liveMenuCode = menu_code"
check("live_categories", f"""SELECT p.*, coalesce(view_num, 0) AS view_num, coalesce(view_user, 0) AS view_user, coalesce(duration, 0) AS duration
FROM ({pv_uv('menued', ['day', 'category'], S, pv='play_num', uv='play_user')}) p
LEFT JOIN ({pv_uv('menued', ['day', 'category'], "event = 'switchchannel'", pv='view_num', uv='view_user')}) v USING (day, category)
LEFT JOIN (SELECT CAST(day AS VARCHAR) AS day, category, CAST(sum(duration) AS BIGINT) AS duration FROM menued WHERE duration BETWEEN 0 AND 36000 GROUP BY 1, 2) d USING (day, category)""")
check("live_channels", duration("menued", ["day", "sourceType", "category", "channelSid"], low=10, high=36000, rows="event = 'switchchannel'"))
check("live_starts_per_minute", pv_uv("livetv", ["channelSid", "CAST(date_trunc('minute', datetime) AS VARCHAR) AS minute"], S, uv="users"))
check("live_occupancy", """SELECT sourceType, channelSid, CAST(make_timestamp(CAST(slot AS BIGINT) * 600000000) AS VARCHAR) AS slot, count(DISTINCT userId) AS uv FROM (
  SELECT *, unnest(range((e - duration) // 600, e // 600 + 1)) AS slot FROM (SELECT *, CAST(floor(epoch(datetime)) AS BIGINT) AS e FROM livetv WHERE event = 'switchchannel' AND duration BETWEEN 10 AND 36000)) GROUP BY 1, 2, 3""")
check("live_source_types", f"""SELECT p.*, coalesce(uv_switch, 0) AS uv_switch FROM ({duration('livetv', ['day', 'sourceType'], high=36000, dur_users='dur_users')}) p
LEFT JOIN ({pv_uv('livetv', ['day', 'sourceType'], "event = 'switchchannel'", uv='uv_switch')}) USING (day, sourceType)""".replace("SELECT p.*, coalesce(uv_switch, 0)", "SELECT p.day, p.sourceType, p.pv, p.uv, p.duration, p.dur_users, coalesce(uv_switch, 0)"))
check("live_source_types_by_hour", "SELECT CAST(hour(datetime) AS INT) AS hour, sourceType, count(DISTINCT userId) AS uv FROM livetv WHERE event = 'startplay' GROUP BY 1, 2")
LABELS = {
    "day": "CAST(day AS VARCHAR)", "week": "CAST(CAST(date_trunc('week', day) AS DATE) AS VARCHAR) || '~' || CAST(CAST(date_trunc('week', day) AS DATE) + 6 AS VARCHAR)",
    "month": "strftime(day, '%Y-%m')", "quarter": "CAST(year(day) AS VARCHAR) || 'Q' || CAST(quarter(day) AS VARCHAR)", "year": "CAST(year(day) AS VARCHAR)",
}


def per_period(table, periods, keys=(), cond=None, sums="", user="userId", pv="pv", uv="uv"):
    cols = "".join(f"{k}, " for k in keys)
    where = f" WHERE {cond}" if cond else ""
    return " UNION ALL ".join(
        f"SELECT '{p}' AS period, {LABELS[p]} AS start, {cols}count({user}) AS {pv}, count(DISTINCT {user}) AS {uv}{sums} FROM {table}{where} GROUP BY {', '.join(str(i + 1) for i in range(2 + len(keys)))}"
        for p in periods)


check("live_per_period", per_period("livetv", LABELS, cond="duration IS NULL OR duration BETWEEN 0 AND 54000", sums=", CAST(sum(duration) AS BIGINT) AS duration"))
check("live_quality_codes", pv_uv("tries", ["videoSource", "contentType", "playCode"], pv="n"))
check("live_quality_counts", "SELECT contentType, playCode, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY contentType) AS BIGINT) AS type_total FROM tries GROUP BY 1, 2")
