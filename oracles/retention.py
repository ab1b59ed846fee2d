from .base import VERSION
from .core import EXTRA, check, current, one_per_key
from .logins import AV, NETA

OFFSETS = (1, 2, 3, 4, 5, 6, 7, 14, 30)
EXTRA["opened"] = f"SELECT id, user_id AS userId, mac, day, product_model, promotion_channel, {AV} AS version, ip FROM account"
EXTRA["seen"] = f"SELECT userId, mac, day, {VERSION} AS version FROM login"


def retention(cohort, dims=(), offsets=OFFSETS, user="userId", activity="seen", unit="day", digits=None, drop_zero=False, last=None):
    """One aggregate per offset, joined to nothing else."""
    cols = "".join(f"{d}, " for d in dims)
    last = last or f"(SELECT max(day) FROM {activity})"
    parts = []
    for k in offsets:
        target = {"day": f"day + {k}", "week": f"day + {7 * k}", "month": f"CAST(day + INTERVAL {k} MONTH AS DATE)"}[unit]
        hit = f"EXISTS (SELECT 1 FROM {activity} a WHERE a.{user} = c.{user} AND a.day = c.target)"
        parts.append(
            f"SELECT CAST(day AS VARCHAR) AS day, {cols}CAST({k} AS INT) AS \"offset\", count(*) AS users, count(*) FILTER ({hit}) AS kept FROM "
            f"(SELECT DISTINCT {user}, day, {cols}{target} AS target FROM {cohort} WHERE {user} IS NOT NULL) c WHERE target <= {last} GROUP BY ALL"
        )
    rate = "kept / users" if digits is None else f"round(kept / users, {digits})"
    return f"SELECT *, {rate} AS rate FROM ({' UNION ALL '.join(parts)}){' WHERE kept > 0' if drop_zero else ''}"


R1 = retention("opened")
check("retention_new_users", R1)
WORDS = dict(zip(OFFSETS, "one two three four five six seven fourteen thirty".split()))
check("retention_new_users_wide", f"SELECT day{''.join(f', max(CASE WHEN {chr(34)}offset{chr(34)} = {k} THEN rate END) AS {w}' for k, w in WORDS.items())} FROM ({R1}) GROUP BY 1")
WIFI = "CASE WHEN wifi_mac IS NULL OR replace(wifi_mac, ':', '') IN ('', '020000000000') THEN NULL ELSE upper(replace(wifi_mac, ':', '')) END"
EXTRA["cleaned"] = f"""SELECT a.user_id AS userId, a.day, a.promotion_channel FROM (SELECT *, {WIFI} AS w FROM account) a WHERE NOT EXISTS (SELECT 1 FROM account b WHERE b.id < a.id AND b.mac = a.mac)
 AND NOT EXISTS (SELECT 1 FROM (SELECT id, {WIFI} AS w FROM account) b WHERE b.id < a.id AND b.w = a.w)"""
check("retention_cleaned_users", retention("cleaned"))
LISTED = "product_model IN ('model1', 'model2', 'model3')"
check("retention_by_model", retention(f"(SELECT * FROM opened WHERE {LISTED})", ["product_model"], drop_zero=True))
check("retention_by_channel", retention("opened", ["promotion_channel"]))
check("retention_by_channel_cleaned", retention("cleaned", ["promotion_channel"]))
check("retention_any_day_since", "SELECT *, kept / users AS rate FROM (" + " UNION ALL ".join(
    f"SELECT CAST(day AS VARCHAR) AS day, CAST({k} AS INT) AS \"offset\", count(*) AS users, count(*) FILTER (EXISTS (SELECT 1 FROM seen a WHERE a.mac = c.mac AND a.day BETWEEN c.day AND c.day + {k})) AS kept "
    f"FROM (SELECT DISTINCT mac, day FROM opened) c WHERE day + {k} <= (SELECT max(day) FROM seen) GROUP BY 1" for k in OFFSETS) + ")")
check("retention_template", retention("opened", ["product_model"], (1,)))
check("retention_every_day", retention("opened", offsets=range(1, 21)))
check("dau_retention_white_and_black", retention("(SELECT *, CASE WHEN version >= '3.1.4' THEN 'white' ELSE 'black' END AS kind FROM seen)", ["kind"]))
check("dau_retention", retention("seen"))
for name, cond, user in (("dau_retention_since_314", "version >= '3.1.4'", "userId"), ("dau_retention_313", "version = '3.1.3'", "userId"), ("dau_retention_315", "version = '3.1.5'", "mac")):
    check(name, retention(f"(SELECT * FROM seen WHERE {cond})", user=user, activity=f"(SELECT * FROM seen WHERE {cond})"))
check("dau_retention_by_band", retention("(SELECT *, CASE WHEN version IN ('3.1.5', '3.1.6') THEN version WHEN version < '3.1.4' THEN 'old' ELSE 'other' END AS band FROM seen)", ["band"]))
check("retention_all_and_since_314", retention("(SELECT *, 'all' AS kind FROM opened UNION ALL SELECT *, 'new' FROM opened WHERE version >= '3.1.4')", ["kind"]))
check("retention_all_and_315", retention("(SELECT *, 'all' AS kind FROM opened UNION ALL SELECT *, '3.1.5' FROM opened WHERE version = '3.1.5')", ["kind"]))
check("retention_since_314_by_version", retention("(SELECT * FROM opened WHERE version >= '3.1.4')", ["version"]))
check("retention_old_users_of_314", retention("(SELECT s.userId, s.day FROM seen s JOIN opened o ON s.userId = o.userId WHERE s.version = '3.1.4' AND o.day < s.day)"))
check("retention_by_version_band", retention("(SELECT *, CASE WHEN version IN ('3.1.4', '3.1.5', '3.1.6') THEN version WHEN version < '3.1.4' THEN 'old' ELSE 'other' END AS band FROM opened)", ["band"], (1,), digits=4))
EXTRA["week_seen"] = "SELECT mac, CAST(date_trunc('week', day) AS DATE) AS day FROM seen"
check("retention_weekly", retention("(SELECT mac, CAST(date_trunc('week', min(day)) AS DATE) AS day FROM seen WHERE version >= '3.1.4' GROUP BY 1)", offsets=(1, 2, 3), user="mac", activity="week_seen", unit="week"))
check("retention_upgraded_users", retention("(SELECT userId, min(day) AS day FROM seen WHERE version >= '3.1.4' GROUP BY 1)"))
check("retention_by_city_level", retention(f"""(SELECT o.*, CASE n_regionkey WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS level FROM opened o LEFT JOIN {current('location')} l ON web_location_key = {NETA}
  LEFT JOIN nation ON city = 'city' || CAST(n_nationkey AS VARCHAR))""", ["level"], (1,), digits=4))
check("retention_listed_models", retention(f"(SELECT *, CASE WHEN {LISTED} THEN 'listed' ELSE 'other' END AS kind FROM opened)", ["kind"]))
check("retention_listed_models_each", retention(f"(SELECT * FROM opened WHERE {LISTED})", ["product_model"]))
check("retention_one_vendor_by_channel", retention("(SELECT * FROM opened WHERE product_model = 'model3')", ["promotion_channel"]))
check("version_fall_back", f"""SELECT CAST(l.day AS VARCHAR) AS day, o.n AS "offset", count(*) AS users,
 count(*) FILTER (EXISTS (SELECT 1 FROM account a WHERE a.mac = l.mac AND {AV} < '3.1.4' AND CAST(a.openTime AS DATE) <= l.day + o.n)) AS fallen_back,
 count(*) FILTER (EXISTS (SELECT 1 FROM account a WHERE a.mac = l.mac AND {AV} < '3.1.4' AND CAST(a.openTime AS DATE) <= l.day + o.n)) / count(*) AS rate
 FROM (SELECT DISTINCT mac, day FROM seen WHERE version >= '3.1.4') l CROSS JOIN (SELECT unnest([0, 1, 3, 7, 14]) AS n) o GROUP BY 1, 2""")
check("version_fall_back_fourteen_days", f"""SELECT CAST(l.day AS VARCHAR) AS day, o.n AS "offset", count(*) AS users,
 count(*) FILTER (EXISTS (SELECT 1 FROM account a WHERE a.mac = l.mac AND {AV} < '3.1.4' AND CAST(a.openTime AS DATE) <= l.day + o.n)) AS fallen_back,
 count(*) FILTER (EXISTS (SELECT 1 FROM account a WHERE a.mac = l.mac AND {AV} < '3.1.4' AND CAST(a.openTime AS DATE) <= l.day + o.n)) / count(*) AS rate
 FROM (SELECT DISTINCT mac, day FROM seen WHERE version >= '3.1.4') l CROSS JOIN (SELECT CAST(unnest(range(1, 15)) AS INT) AS n) o GROUP BY 1, 2""")
check("member_month_retention", retention("(SELECT * FROM member WHERE good_sk = 0 AND is_first_cont_mon_order = 1)", offsets=(1, 2, 3), user="account_sk", activity="(SELECT * FROM member WHERE good_sk = 0)", unit="month"))
