from .core import EXTRA, START, check, duration, one_per_key, pv_uv, pv_uv_null

VIDEOS = pv_uv("play", ["contentType", "videoSid"], START)
check("video_plays_of_channel", VIDEOS)
check("top_videos_of_channel", f"SELECT *, row_number() OVER (PARTITION BY contentType ORDER BY pv DESC, videoSid) AS rank FROM ({VIDEOS}) QUALIFY rank <= 5")
check("top_videos_with_ties", f"SELECT *, rank() OVER (PARTITION BY contentType ORDER BY uv DESC) AS rank FROM ({VIDEOS}) QUALIFY rank <= 3")
check("video_plays", pv_uv("play", ["day", "contentType", "videoSid"], START))
check("episode_plays", pv_uv("play", ["contentType", "episodeSid"], START + " AND episodeSid IS NOT NULL"))
check("cartoons_and_songs", pv_uv("play", ["CASE WHEN pathMain LIKE '%kids_anim%' THEN 'donghua' ELSE 'song' END AS kind", "videoSid"], START + " AND (pathMain LIKE '%kids_anim%' OR pathMain LIKE '%mv_category%')"))
CHANNEL = "regexp_extract(subjectCode, '^[a-z]+') AS channel"
SUBJECTS = pv_uv("play", [CHANNEL, "subjectCode"], START + " AND subjectCode IS NOT NULL")
check("subject_plays", SUBJECTS)
check("top_subjects_of_channel", f"SELECT *, row_number() OVER (PARTITION BY channel ORDER BY pv DESC, subjectCode) AS rank FROM ({SUBJECTS}) QUALIFY rank <= 3")
check("channel_subject_plays", pv_uv("play", [CHANNEL], START + " AND subjectCode IS NOT NULL"))
ONE = one_per_key("subject", "subject_code", "subject_content_type_name", "channel")
ANY = one_per_key("subject", "subject_code", "subject_content_type_name", "channel", valid=False)
check("channel_subject_plays_by_dim", pv_uv(f"(SELECT * FROM play LEFT JOIN {ONE} s ON subjectCode = subject_code)", ["channel", "day"], START + " AND subjectCode IS NOT NULL"))
check("channel_subject_plays_all_versions", pv_uv(f"(SELECT * FROM play JOIN {ANY} s ON subjectCode = subject_code)", ["channel"], START))
check("channel_subject_views", pv_uv(f"(SELECT * FROM visit JOIN {ONE} s ON subjectCode = subject_code)", ["channel", "day"], "event IN ('enter', 'view')"))
check("subject_plays_by_source", pv_uv("play", ["subjectCode", """CASE WHEN pathMain LIKE 'home*classification%' THEN 'classification' WHEN pathMain LIKE 'home*my_tv%' THEN 'my_tv'
 WHEN pathMain LIKE 'home*recommendation%' THEN 'recommendation' WHEN pathMain LIKE '%search%' THEN 'search' ELSE 'other' END AS source"""], START + " AND subjectCode IS NOT NULL"))
check("subject_views_by_source", pv_uv_null("visit", ["subjectCode", "CASE WHEN path LIKE 'home-hotrecommend%' THEN 'hotrecommend' WHEN path LIKE 'home-tv%' THEN 'tv' WHEN path LIKE 'home-movie%' THEN 'movie' ELSE 'other' END AS source"]))
EXTRA["liked"] = """SELECT *, 'guess' AS kind FROM play WHERE pathSub LIKE 'guessyoulike%' UNION ALL SELECT *, 'recommendation' FROM play WHERE pathMain LIKE '%recommendation%'
UNION ALL SELECT *, 'taste' FROM play WHERE pathMain LIKE '%taste%'"""
check("guess_you_like_plays", duration("liked", ["kind"]))
check("similar_plays", duration("play", ["contentType"], "pathSub LIKE '%similar%'", avg="avg_duration"))
check("home_recommendation_videos", pv_uv_null("play", ["videoSid"], START + " AND ((pathMain LIKE '%recommendation%' AND len(string_split(pathMain, '-')) = 2) OR (path LIKE '%hotrecommend%' AND len(string_split(path, '-')) BETWEEN 4 AND 5))"))
check("content_type_plays", pv_uv("play", ["flag", "contentType"], START))
check("content_type_details", pv_uv("visit", ["contentType"], "event = 'view'"))
check("videos_found_by_search", pv_uv("(SELECT userId, videoSid FROM play WHERE pathMain LIKE '%search%' OR path LIKE '%search%' UNION ALL SELECT userId, videoSid FROM visit WHERE path LIKE '%search%')", ["videoSid"]))
check("search_click_counts", "SELECT contentType, count(*) AS n FROM search WHERE step = 'click' GROUP BY 1")
check("search_clicks_by_result", pv_uv_null("search", ["resultSid AS sid", "resultName AS name", "contentType"]))
check("search_clicks_by_type", pv_uv_null("search", ["day", "contentType"], "step = 'click'"))
check("search_clicks_by_video", pv_uv_null("search", ["resultSid", "resultName", "contentType"], "step = 'click'"))
check("search_funnel", """WITH e AS (SELECT day, entrance, tabName, contentType, count(userId) AS n FROM search WHERE step = 'entrance' GROUP BY ALL),
v AS (SELECT day, entrance, tabName, contentType, count(userId) AS n FROM search WHERE step = 'tabview' GROUP BY ALL),
c AS (SELECT day, entrance, tabName, contentType, count(userId) AS n FROM search WHERE step = 'click' GROUP BY ALL)
SELECT CAST(day AS VARCHAR) AS day, entrance, tabName, contentType, e.n AS enter, coalesce(v.n, 0) AS views, coalesce(c.n, 0) AS clicks
FROM e LEFT JOIN v USING (day, entrance, tabName, contentType) LEFT JOIN c USING (day, entrance, tabName, contentType)""")
for event in ("view", "open", "install", "upgrade"):
    check(f"apps_{event}", pv_uv(f"(SELECT a.*, n.name FROM apps a LEFT JOIN {one_per_key('application', 'application_sid', 'application_name', 'name')} n ON appSid = application_sid)", ["appSid", "name"], f"event = '{event}'"))
