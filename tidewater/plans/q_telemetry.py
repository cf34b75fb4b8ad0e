"""Queries of the telemetry batch layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import views
from ..functions.scalar import partition_fields
from ..operators import frames, telemetry as tm
from .registry import register

# The hour argument of the per-hour batch job (a parameter of the operator).
AT = "2024-01-05T13:00:00+00:00"
AT_SQL = "TIMESTAMP '2024-01-05 13:00:00'"


@register("J1_hourly_quota_breaches", sql="""
    WITH usage AS (
      SELECT date_trunc('hour', "timestamp") AS "timestamp", id, CAST(sum(bytes) AS BIGINT) AS value
      FROM telemetry GROUP BY 1, 2)
    SELECT m.email AS email, u.value AS usage, m.quota AS quota, u."timestamp" AS "timestamp"
    FROM usage u JOIN users m ON u.id = m.id AND u.value > m.quota
""")
def q_hourly_quota(spark, d):
    return tm.hourly_quota_breaches(views.telemetry(spark, d), views.users(spark, d))


@register("A1_total_bytes_by_user_hourly", sql="""
    SELECT date_trunc('hour', "timestamp") AS "timestamp", id, CAST(sum(bytes) AS BIGINT) AS value,
           'id_total_bytes' AS type
    FROM telemetry GROUP BY 1, 2
""")
def q_a1_user(spark, d):
    return tm.total_bytes(views.telemetry(spark, d), "id")


@register("A1_total_bytes_by_antenna_at_hour", sql=f"""
    SELECT {AT_SQL} AS "timestamp", antenna_id AS id, CAST(sum(bytes) AS BIGINT) AS value,
           'antenna_id_total_bytes' AS type
    FROM telemetry WHERE "timestamp" >= {AT_SQL} AND "timestamp" < {AT_SQL} + INTERVAL 1 HOUR
    GROUP BY antenna_id
""")
def q_a1_antenna(spark, d):
    return tm.total_bytes(views.telemetry(spark, d), "antenna_id", at=AT)


@register("A1_total_bytes_by_app_hourly", sql="""
    SELECT date_trunc('hour', "timestamp") AS "timestamp", app AS id, CAST(sum(bytes) AS BIGINT) AS value,
           'app_total_bytes' AS type
    FROM telemetry GROUP BY 1, 2
""")
def q_a1_app(spark, d):
    return tm.total_bytes(views.telemetry(spark, d), "app")


@register("A2_total_bytes_by_email_hourly", sql="""
    WITH byid AS (SELECT date_trunc('hour', "timestamp") AS ts, id, sum(bytes) AS v
                  FROM telemetry GROUP BY 1, 2)
    SELECT b.ts AS "timestamp", u.email AS id, CAST(sum(b.v) AS BIGINT) AS value,
           'email_total_bytes' AS type
    FROM byid b JOIN users u ON b.id = u.id GROUP BY 1, 2
""")
def q_a2(spark, d):
    return tm.total_bytes_by_email(views.telemetry(spark, d), views.users(spark, d))


@register("U1_metrics_in_one_table", sql="""
    SELECT date_trunc('hour', "timestamp") AS "timestamp", id, CAST(sum(bytes) AS BIGINT) AS value,
           'id_total_bytes' AS type FROM telemetry GROUP BY 1, 2
    UNION ALL
    SELECT date_trunc('hour', "timestamp"), antenna_id, CAST(sum(bytes) AS BIGINT),
           'antenna_id_total_bytes' FROM telemetry GROUP BY 1, 2
    UNION ALL
    SELECT date_trunc('hour', "timestamp"), app, CAST(sum(bytes) AS BIGINT),
           'app_total_bytes' FROM telemetry GROUP BY 1, 2
""")
def q_u1(spark, d):
    t = views.telemetry(spark, d)
    return frames.append_all([tm.total_bytes(t, k) for k in ("id", "antenna_id", "app")])


@register("S1_parse_telemetry", sql="""
    SELECT CAST(floor(epoch("timestamp")) AS BIGINT) AS "timestamp", id, antenna_id, bytes, app
    FROM telemetry
""")
def q_s1(spark, d):
    return tm.parse_telemetry(views.telemetry_raw(spark, d))


@register("S2_S3_event_time_partition_fields", sql="""
    SELECT id, CAST(date_trunc('second', "timestamp") AS TIMESTAMP) AS "timestamp",
           CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
           CAST(day("timestamp") AS INTEGER) AS day, CAST(hour("timestamp") AS INTEGER) AS hour
    FROM telemetry
""")
def q_s2s3(spark, d):
    parsed = tm.with_event_time(tm.parse_telemetry(views.telemetry_raw(spark, d)))
    return parsed.select("id", "timestamp", *partition_fields("timestamp"))


@register("P4_tag_metric", sql=f"""
    SELECT id, bytes, 'raw_bytes' AS type, {AT_SQL} AS "timestamp" FROM telemetry
""")
def q_p4(spark, d):
    t = views.telemetry(spark, d).select("id", "bytes")
    return tm.tag(t, "raw_bytes", at=AT)


@register("A1_total_bytes_one_pass_all_keys", sql="""
    SELECT date_trunc('hour', "timestamp") AS "timestamp", id, CAST(sum(bytes) AS BIGINT) AS value,
           'id_total_bytes' AS type FROM telemetry GROUP BY 1, 2
    UNION ALL
    SELECT date_trunc('hour', "timestamp"), antenna_id, CAST(sum(bytes) AS BIGINT),
           'antenna_id_total_bytes' FROM telemetry GROUP BY 1, 2
    UNION ALL
    SELECT date_trunc('hour', "timestamp"), app, CAST(sum(bytes) AS BIGINT),
           'app_total_bytes' FROM telemetry GROUP BY 1, 2
""")
def q_a1_onepass(spark, d):
    return tm.total_bytes_all(views.telemetry(spark, d), ("id", "antenna_id", "app"))
