from .core import EXTRA, START, check, pv_uv_null

MAJOR = "CASE WHEN apkVersion IS NULL THEN '未知' ELSE substr(apkVersion, 1, 1) END AS version"


def histogram(keys, cond=START):
    k = ", ".join(keys)
    names = ", ".join(x.split(" AS ")[-1] for x in keys)
    return f"""SELECT {names}, n, count(*) AS users, CAST(sum(count(*)) OVER (PARTITION BY {names}) AS BIGINT) AS total FROM (SELECT {k}, userId, videoSid, count(*) AS n FROM play WHERE {cond} GROUP BY ALL) GROUP BY {names}, n"""


check("plays_per_user_and_video", histogram([MAJOR]))
check("plays_per_user_and_video_by_type", histogram(["contentType", MAJOR]))


def curve(keys):
    names = [x.split(" AS ")[-1] for x in keys]
    n = ", ".join(names)
    same = " AND ".join(f"c.{x} = s.{x}" for x in names)
    counts = f"(SELECT {', '.join(keys)}, userId, videoSid, count(*) AS n FROM play WHERE {START} GROUP BY ALL)"
    return f"""WITH c AS {counts}, s AS (SELECT DISTINCT {n}, n FROM c), w AS (SELECT {n}, count(DISTINCT userId) AS uv, CAST(sum(n) AS BIGINT) AS pv FROM c GROUP BY {n})
SELECT {', '.join('s.' + x for x in names)}, s.n, count(DISTINCT c.userId) AS valid_uv, CAST(sum(c.n) AS BIGINT) AS valid_pv, any_value(w.uv) AS uv, any_value(w.pv) AS pv
FROM s JOIN c ON {same} AND c.n <= s.n JOIN w ON {' AND '.join(f'w.{x} = s.{x}' for x in names)} GROUP BY {', '.join('s.' + x for x in names)}, s.n"""


check("play_threshold_curve", curve([MAJOR]))
check("play_threshold_curve_by_type", curve(["contentType", MAJOR]))
check("long_watch_sums", f"""SELECT contentType, version, duration, count(*) AS users, CAST(sum(count(*)) OVER (PARTITION BY contentType, version) AS BIGINT) AS total FROM
 (SELECT contentType, {MAJOR}, userId, videoSid, CAST(sum(duration) AS BIGINT) AS duration FROM play WHERE duration IS NOT NULL AND event <> 'startplay' GROUP BY ALL) WHERE duration > 10800 GROUP BY 1, 2, 3""")


def spread(table, unit, cond="TRUE"):
    return f"SELECT CASE WHEN duration <= 86400 THEN duration // {unit} ELSE duration + 1 END AS duration, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM {table} WHERE duration >= 0 AND {cond} GROUP BY 1"


check("vod_duration_spread", spread("play", 60, "event <> 'startplay'"))
check("live_duration_spread", spread("livelog", 900))
check("use_duration_spread", spread("home", 3600))
check("on_duration_by_version", "SELECT substr(apkVersion, 1, 1) AS version, CASE WHEN duration <= 86400 THEN duration // 60 ELSE duration + 1 END AS duration, count(userId) AS pv, count(DISTINCT userId) AS uv FROM home GROUP BY 1, 2")
check("enter_times_by_version", "SELECT CAST(day AS VARCHAR) AS day, version, times, count(*) AS users FROM (SELECT day, substr(apkVersion, 1, 1) AS version, userId, count(*) AS times FROM home GROUP BY 1, 2, 3) GROUP BY 1, 2, 3")
EXTRA["combos"] = "SELECT DISTINCT userId, apkVersion, productModel, promotionChannel, concat_ws('/', apkVersion, productModel, promotionChannel) AS combination FROM play WHERE userId IS NOT NULL"
EXTRA["several"] = "SELECT userId FROM combos GROUP BY 1 HAVING count(DISTINCT combination) > 1"
check("pseudo_users", "SELECT combination, count(DISTINCT userId) AS n, (SELECT count(*) FROM several) AS total FROM combos WHERE userId IN (SELECT userId FROM several) GROUP BY 1")
check("combinations_per_user", "SELECT userId, count(*) AS n FROM combos GROUP BY 1")
check("names_per_video", "SELECT videoSid, count(DISTINCT videoName) AS n FROM play WHERE videoName IS NOT NULL GROUP BY 1")
check("plays_of_ambiguous_videos", "SELECT count(*) AS n FROM play WHERE videoSid IN (SELECT videoSid FROM play GROUP BY 1 HAVING count(DISTINCT videoName) > 1)")
check("gaps_of_same_video", """SELECT gap_seconds, count(*) AS n FROM (SELECT s - lag(s) OVER (PARTITION BY userId, videoSid ORDER BY s) AS gap_seconds FROM (SELECT userId, videoSid, CAST(epoch(datetime) AS BIGINT) AS s FROM play WHERE userId IS NOT NULL)) WHERE gap_seconds IS NOT NULL GROUP BY 1""")
check("counts_of_any_key", pv_uv_null("play", ["episodeSid", "flag"]))
