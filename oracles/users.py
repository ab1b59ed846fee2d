from .core import EXTRA, check, one_per_key, pv_uv, pv_uv_null, side_by_side
from .live import LABELS, per_period
from .logins import AV, BRAND, NORMA

D = "DATE '2024-01-20'"
check("cumulative_users_per_model", f"SELECT product_model, count(DISTINCT user_id) AS users FROM account WHERE day <= {D} GROUP BY 1")
check("new_users_per_channel", "SELECT CAST(day AS VARCHAR) AS day, promotion_channel, count(DISTINCT user_id) AS new_users FROM account GROUP BY 1, 2")
ABRAND = BRAND.replace("ON productModel", "ON account.product_model")
EXTRA["branded_account"] = f"SELECT account.*, coalesce(bn, '其他品牌') AS brand FROM account {ABRAND}"
EXTRA["branded_login"] = f"SELECT login.*, coalesce(bn, '其他品牌') AS brand FROM login {BRAND}"
NT = f"count(DISTINCT CASE WHEN day = {D} THEN user_id END) AS new_users, count(DISTINCT user_id) AS total_users"
check("new_and_total_per_brand", f"SELECT brand, {NT} FROM branded_account WHERE day <= {D} GROUP BY 1")
check("new_and_total_per_model", f"SELECT product_model, {NT} FROM account WHERE day <= {D} GROUP BY 1")
check("new_total_active_per_channel_and_model", f"""SELECT coalesce(a.channel, b.channel) AS channel, coalesce(a.model, b.model) AS model, coalesce(new_users, 0) AS new_users, coalesce(total_users, 0) AS total_users, coalesce(active_users, 0) AS active_users
 FROM (SELECT promotion_channel AS channel, product_model AS model, {NT} FROM account WHERE day <= {D} GROUP BY 1, 2) a
 FULL JOIN (SELECT promotionChannel AS channel, productModel AS model, count(DISTINCT userId) AS active_users FROM login WHERE day = {D} GROUP BY 1, 2) b ON a.channel IS NOT DISTINCT FROM b.channel AND a.model = b.model""")
ALL = ["day", "week", "month", "quarter", "year"]
check("new_users_and_logins_per_period", f"""SELECT period, start, coalesce(new_users, 0) AS new_users, coalesce(pv, 0) AS pv, coalesce(uv, 0) AS uv FROM
 (SELECT period, start, uv AS new_users FROM ({per_period('account', ALL, user='user_id')})) FULL JOIN ({per_period('login', ALL)}) USING (period, start)""")
P3 = ["day", "week", "month"]
check("details_and_plays_per_period", f"""SELECT period, start, coalesce(detail_users, 0) AS detail_users, coalesce(plays, 0) AS plays, coalesce(play_users, 0) AS play_users, coalesce(duration, 0) AS duration, coalesce(watch_users, 0) AS watch_users FROM
 (SELECT period, start, uv AS detail_users FROM ({per_period('visit', P3, cond="event = 'view'")}))
 FULL JOIN ({per_period('play', P3, cond="event IN ('startplay', 'playview')", pv='plays', uv='play_users')}) USING (period, start)
 FULL JOIN (SELECT period, start, uv AS watch_users, duration FROM ({per_period('play', P3, cond="event <> 'startplay' AND duration BETWEEN 0 AND 10800", sums=', CAST(sum(duration) AS BIGINT) AS duration')})) USING (period, start)""")
check("users_per_version", f"SELECT {AV} AS version, count(DISTINCT user_id) AS users FROM account GROUP BY 1")
check("active_and_new_per_brand", side_by_side({"active_users": "SELECT brand, count(DISTINCT mac) AS active_users FROM branded_login GROUP BY 1", "new_users": "SELECT brand, count(DISTINCT mac) AS new_users FROM branded_account GROUP BY 1"}, ["brand"]))
check("channel_share_of_brand", f"SELECT *, n / sum(n) OVER (PARTITION BY brand) AS share FROM (SELECT brand, {NORMA}, count(DISTINCT user_id) AS n FROM branded_account GROUP BY 1, 2)")
check("new_users_on_other_devices", "SELECT promotion_channel, count(DISTINCT mac) AS n FROM account WHERE product_model IN ('model1', 'model2', 'model3') GROUP BY 1")
check("total_users_per_channel", f"SELECT promotion_channel, count(DISTINCT user_id) AS n FROM account WHERE day <= {D} GROUP BY 1")
check("ages", """SELECT CASE WHEN age = '其他' THEN '其他' ELSE birth END AS year, age, count(*) AS n FROM (SELECT birth, CASE WHEN birth = '' OR birth LIKE '%月%' THEN '其他' WHEN a <= 0 THEN NULL WHEN a <= 19 THEN '19以下' WHEN a <= 29 THEN '20~29'
 WHEN a <= 39 THEN '30~39' WHEN a <= 49 THEN '40~49' WHEN a > 49 THEN '50以上' END AS age FROM (SELECT birth, 2024 - TRY_CAST(birth AS INT) AS a FROM person)) WHERE age IS NOT NULL GROUP BY 1, 2""")
check("genders", "SELECT count(*) FILTER (lower(gender) = 'f') AS f, count(*) FILTER (lower(gender) = 'm') AS m, count(*) FILTER (lower(gender) = 'o') AS o, count(*) FILTER (lower(gender) NOT IN ('f', 'm', 'o')) AS empty FROM person")
check("regions", """SELECT province, city, count(*) AS n FROM (SELECT CASE c_nationkey % 5 WHEN 0 THEN '其他' WHEN 1 THEN 'prov1' WHEN 2 THEN 'prov2' WHEN 3 THEN 'prov3' ELSE 'prov4,a' END AS province,
 CASE c_nationkey % 5 WHEN 0 THEN '其他' WHEN 1 THEN 'city' || CAST(c_nationkey AS VARCHAR) WHEN 2 THEN 'prov2' WHEN 3 THEN 'prov3' ELSE 'b' END AS city FROM customer) GROUP BY 1, 2""")
check("account_events", pv_uv("accountlog", ["event", "CAST(month(day) AS INT) AS month"]))
check("account_logins_by_path", pv_uv_null("accountlog", ["path"], "event = 'login'"))
check("account_logins", pv_uv("accountlog", [], "event = 'login'"))
check("accounts_ever_used", "SELECT CAST(day AS VARCHAR) AS day, n AS new_users, CAST(sum(n) OVER (ORDER BY day) AS BIGINT) AS total_users FROM (SELECT day, count(*) AS n FROM (SELECT userId, min(day) AS day FROM accountlog GROUP BY 1) GROUP BY 1)")
check("new_account_ids_of_last_days", "SELECT accountId, count(*) AS new_pairs FROM (SELECT userId, accountId FROM accountlog WHERE day >= DATE '2024-01-03' EXCEPT SELECT userId, accountId FROM accountlog WHERE day < DATE '2024-01-03') GROUP BY 1")
check("accounts_per_user", "SELECT accounts, count(*) AS users FROM (SELECT userId, count(DISTINCT accountId) AS accounts FROM accountlog GROUP BY 1) GROUP BY 1")
