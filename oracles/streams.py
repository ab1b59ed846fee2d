from .core import check

check("online_five_minutes", """SELECT CAST(make_timestamp(b * 300000000) AS VARCHAR) AS start, CAST(make_timestamp((b + 1) * 300000000) AS VARCHAR) AS "end", avg(k) AS average, count(*) AS samples
FROM (SELECT k, CAST(floor(epoch(datetime) / 300) AS BIGINT) AS b FROM login) GROUP BY b""")
check("hourly_counts_as_stream", "SELECT CAST(date_trunc('hour', datetime) AS VARCHAR) AS start, log_type, count(userId) AS pv, count(DISTINCT userId) AS uv FROM login GROUP BY 1, 2")
