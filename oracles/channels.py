from .core import EXTRA, START, check, duration, one_per_key, pv_uv, pv_uv_null
from .facts import E2, E3

check("classification_plays", pv_uv("play", ["main_category", "second_category"], START))
check("classification_plays_by_day", pv_uv("play", ["day", "main_category", "second_category"], START + " AND main_category IS NOT NULL"))
check("classification_of_channel", pv_uv("play", ["second_category"], START + " AND main_category = 'movie'"))
EXTRA["channel_play"] = f"""SELECT play.*, coalesce(s.t, p.t, contentType) AS channel FROM play
LEFT JOIN {one_per_key('subject', 'subject_code', 'subject_content_type_name', 't')} s ON subjectCode = subject_code
LEFT JOIN {one_per_key('program', 'sid', 'content_type_name', 't')} p ON videoSid = sid"""
check("entrance_plays", duration("channel_play", ["channel", "entryType"], avg="avg_duration", digits=0))
check("entrance_plays_short", duration("play", ["contentType", "entryType"], avg="avg_duration", digits=0))
EXTRA["labelled_play"] = f"SELECT *, CASE WHEN flag = '3x' THEN {E3} ELSE {E2} END AS source FROM play"
check("history_plays_by_video", pv_uv_null("labelled_play", ["videoSid", "contentType", "source"], START + " AND source = '历史'"))
check("source_plays_and_time", duration("labelled_play", ["contentType", "source"]))
check("source_plays_one_version", duration("labelled_play", ["contentType", "source"], "apkVersion = '3.1.4'", avg="avg_duration"))
check("channel_plays", pv_uv("play", ["CASE WHEN subjectCode IS NOT NULL THEN regexp_extract(subjectCode, '^[a-z]+') ELSE contentType END AS channel"], START))
check("channel_plays_by_day", pv_uv("play", ["day", "contentType"], START))
check("channel_durations", duration("play", ["day", "contentType"], avg="avg_duration", dur_users="dur_users"))
check("channel_visits", pv_uv("visit", ["day", "contentType"], "event = 'enter'"))
check("channel_visit_durations", duration("visit", ["contentType"], start="event = 'enter'", rows="event = 'exit' AND duration <= CASE WHEN contentType IN ('mv', 'kids') THEN 10800 ELSE 36000 END",
      high=None, avg="avg_duration", dur_users="dur_users"))
check("collect_tab_plays", duration("play", ["'其它' AS tab", "day"], "pathMain LIKE '%collect%'", rows=f"NOT ({START})", avg="avg_duration"))
check("collected_videos", pv_uv("visit", ["videoSid"], "event = 'view'"))
check("history_plays", duration("play", ["day"], "pathMain LIKE '%history%'", avg="avg_duration"))
KIDS = "(SELECT *, 'kids_anim' AS \"group\", split_part(pathMain, 'kids_anim*', 2) AS tab FROM play WHERE pathMain LIKE '%kids%')"
check("kids_tab_plays", pv_uv_null(KIDS, ['"group" AS group', "tab"], START).replace("AS group,", 'AS "group",'))
check("kids_tab_plays_calm", pv_uv(f"(SELECT *, count(*) OVER (PARTITION BY userId, \"group\", tab) AS c FROM {KIDS})", ['"group" AS group', "tab"], START + " AND (userId IS NULL OR c < 3)").replace("AS group,", 'AS "group",'))
check("kids_tab_views", pv_uv_null(KIDS, ['"group" AS group', "tab"], "event = 'selfend'").replace("AS group,", 'AS "group",'))
check("kids_tab_views_named", pv_uv(f"(SELECT k.*, coalesce(menu_name, tab) AS name FROM {KIDS} k LEFT JOIN livemenu ON 'A' || substr(menu_code, 5, 1) = tab)", ['"group" AS group', "name"], "event = 'selfend'").replace("AS group,", 'AS "group",'))
check("match_plays", duration("play", ["videoSid", "'联赛' AS place"], "pathMain LIKE '%sports*League%'", avg="avg_duration"))
check("sports_users", "SELECT count(DISTINCT userId) AS users FROM (SELECT userId FROM play WHERE contentType = 'sports' UNION ALL SELECT userId FROM livelog WHERE liveMenuCode = 'menu1')")
