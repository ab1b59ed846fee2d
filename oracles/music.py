from .core import EXTRA, START, check, duration, one_per_key, pv_uv, pv_uv_null

M = "pathMain LIKE '%mv*%'"
check("music_plays_by_chart", duration("play", ["videoSid", "split_part(pathMain, 'mv_category*', 2) AS source"], "pathMain LIKE '%mv_category*%'", low=1, dur_users="dur_users"))
check("music_video_plays", pv_uv("play", ["videoSid"], f"{M} AND {START}"))
check("music_area_plays", duration("play", ["CASE template WHEN 7 THEN 'classification' ELSE 'entrance' END AS area", "CASE template WHEN 7 THEN 'style' WHEN 8 THEN 'singer' ELSE 'concert' END AS location"],
      "flag = '3x' AND template IN (7, 8, 15)", null_dur=True, dur_users="dur_users"))
EXTRA["music_rec"] = f"""SELECT *, CASE WHEN pathSpecial LIKE 'subject%' THEN 'topic' ELSE 'program' END AS kind, CASE WHEN pathSpecial LIKE 'subject%' THEN subjectCode ELSE videoSid END AS code FROM play WHERE {M}"""
check("music_recommended", f"""SELECT c.*, coalesce(p.title, s.subject_name, c.code) AS title FROM ({duration('music_rec', ['kind', 'code'], dur_users='dur_users')}) c
LEFT JOIN {one_per_key('program', 'sid', 'title')} p ON kind = 'program' AND code = sid LEFT JOIN {one_per_key('subject', 'subject_code', 'subject_name')} s ON kind = 'topic' AND code = subject_code""")
OMNI = "flag = '3x' AND pathSpecial LIKE 'subject-%-%'"
check("omnibus_plays", f"SELECT c.*, subject_name AS name FROM ({duration('play', ['split_part(pathSpecial, chr(45), 3) AS omnibus'], OMNI)}) c LEFT JOIN {one_per_key('subject', 'subject_code', 'subject_name')} ON omnibus = subject_code")
check("omnibus_plays_by_entrance", duration("play", ["CASE template WHEN 15 THEN 'NATION_1' WHEN 8 THEN 'NATION_2' END AS entrance", "split_part(pathSpecial, chr(45), 3) AS omnibus"], OMNI))
EXTRA["sung"] = f"""SELECT play.*, coalesce(title, subject_name, videoSid) AS singer FROM play LEFT JOIN {one_per_key('program', 'sid', 'title')} ON videoSid = sid
LEFT JOIN {one_per_key('subject', 'subject_code', 'subject_name')} ON subjectCode = subject_code WHERE {M}"""
check("singer_plays", f"SELECT * FROM ({duration('sung', ['singer', 'entryType'], avg='avg_duration')}) UNION ALL SELECT singer, 'All', pv, uv, duration, avg_duration FROM ({duration('sung', ['singer'], avg='avg_duration')})")
check("music_position_clicks", pv_uv_null("home", ["'mv' AS channel", "accessArea", "locationIndex"], "event = 'click'"))
TABS = ["CASE template WHEN 7 THEN '音乐分类' ELSE '音乐入口' END AS entry", "CASE template WHEN 7 THEN '风格' WHEN 8 THEN '热门歌手' ELSE '演唱会' END AS tab", "CASE template WHEN 7 THEN 'POP' WHEN 8 THEN '' ELSE 'C3' END AS item"]
IN_TABS = "flag = '3x' AND template IN (7, 8, 15)"
check("music_tab_plays", duration("play", TABS, IN_TABS, avg="avg_duration"))
check("music_tab_views", pv_uv_null("play", TABS, IN_TABS + " AND event = 'selfend'"))
check("music_videos_by_source", duration("play", ["videoSid", TABS[1]], IN_TABS))
check("music_videos", duration("play", ["videoSid"], M, low=1))
