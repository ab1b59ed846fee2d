from . import facts  # noqa: F401  the tries table
from .core import check, one_per_key, pv_uv

DAY = "CAST(DATE '2024-01-01' + (dom - 1) AS VARCHAR) AS day"
check("codes_per_day", f"""SELECT {DAY}, playCode, count(*) AS n FROM (SELECT dom, playCode FROM tries
  UNION ALL SELECT CAST(EXTRACT(DAY FROM l_shipdate) AS INT), 0 FROM lineitem WHERE l_orderkey % 50 = 1) GROUP BY 1, 2""")


def codes(keys, totals):
    t = "".join(f", CAST(sum(count(*)) OVER ({'PARTITION BY ' + ', '.join(k) if k else ''}) AS BIGINT) AS {n}" for n, k in totals.items())
    return f"SELECT {', '.join(keys)}, count(*) AS n{t} FROM tries GROUP BY {', '.join(str(i + 1) for i in range(len(keys)))}"


check("codes_per_video_and_source", codes(["videoSid", "videoSource", "playCode"], {"source_total": ["videoSid", "videoSource"], "total": []}))
check("codes_per_source", codes(["videoSource", "playCode"], {"source_total": ["videoSource"], "total": []}))
check("codes_per_source_and_type", codes(["videoSource", "playCode", "contentType"], {"source_total": ["videoSource", "contentType"]}))
check("codes_per_video_with_title", f"SELECT c.*, coalesce(title, videoSid) AS title FROM ({codes(['videoSid', 'videoSource', 'playCode', 'contentType'], {'source_total': ['videoSid', 'videoSource', 'contentType']})}) c LEFT JOIN {one_per_key('program', 'sid', 'title')} ON videoSid = sid")
check("codes_of_top_videos", f"""SELECT c.* FROM ({codes(['contentType', 'videoSid', 'videoSource', 'playCode'], {'source_total': ['videoSid', 'videoSource']})}) c
SEMI JOIN (SELECT * FROM ({pv_uv('play3', ['contentType', 'videoSid'], "event = 'startplay'")}) QUALIFY row_number() OVER (PARTITION BY contentType ORDER BY pv DESC, videoSid) <= 5) t USING (contentType, videoSid)""")
check("codes_of_top_episodes", f"""SELECT c.* FROM ({codes(['contentType', 'episodeSid', 'playCode'], {})}) c
SEMI JOIN (SELECT * FROM ({pv_uv('play3', ['contentType', 'episodeSid'], "event = 'startplay'")}) QUALIFY rank() OVER (PARTITION BY contentType ORDER BY pv DESC) <= 3) t USING (contentType, episodeSid)""")
check("failures_of_top_episodes", """SELECT videoSource, episodeSid, playCode, count(*) AS n FROM tries SEMI JOIN
 (SELECT videoSource, episodeSid FROM (SELECT videoSource, episodeSid, count(*) AS c FROM tries GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY videoSource ORDER BY c DESC, episodeSid) <= 5) t USING (videoSource, episodeSid)
WHERE playCode <> 200 GROUP BY 1, 2, 3""")
check("codes_of_listed_videos", "SELECT videoSid, playCode, count(*) AS n FROM tries WHERE videoSid IN ('v1', 'v5', 'v8') GROUP BY 1, 2")
check("users_of_listed_videos", "SELECT count(DISTINCT userId) AS users FROM tries WHERE videoSid IN ('v1', 'v5', 'v8')")
check("quality_users_per_version", "SELECT playCode, apkVersion, count(DISTINCT userId) AS uv FROM tries GROUP BY 1, 2")
check("play_users_per_version", "SELECT apkVersion, count(DISTINCT userId) + max(CASE WHEN userId IS NULL THEN 1 ELSE 0 END) AS uv FROM play3 GROUP BY 1")
check("sources_per_content_class", "SELECT CASE WHEN contentType IN ('movie', 'tv', 'zongyi', 'comic', 'jilu', 'kids') THEN 'long' WHEN contentType IN ('hot', 'xiqu', 'mv') THEN 'short' ELSE 'others' END AS content_class, videoSource, count(*) AS pv, count(DISTINCT userId) AS uv FROM tries GROUP BY 1, 2")
check("outcomes_by_hour", """SELECT CAST((l_orderkey * 37 % 86400) // 3600 AS INT) AS hour, count(*) AS total, count(*) FILTER (playCode = 200) AS success, count(*) FILTER (playCode = -1) AS parse_failed,
  count(*) FILTER (playCode = -2) AS auto_failed, count(*) FILTER (playCode = -3) AS play_failed FROM tries WHERE videoSource = 's1' GROUP BY 1""")
check("codes_of_two_days", f"SELECT videoSid, videoSource, {DAY}, playCode, count(*) AS n FROM tries WHERE dom IN (5, 6) GROUP BY 1, 2, 3, 4")
