"""Queries of sources and sinks: each writes data Spark derives from the
driver tables to a fresh folder under the shared checkpoint folder and
reads it back through the source under test."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import views
from ..operators import profile as pf
from ..operators import telemetry as tm
from ..session import shared_dir
from ..sources import readers as rd
from ..sources import sinks as sk
from .q_frames import LISTING_TYPES
from .q_telemetry import AT, AT_SQL
from .registry import register


def _scratch(spark, name):
    return shared_dir(spark, "tidewater-io", f"{name}-{uuid.uuid4().hex[:12]}")


@register("SRC2_SNK3_lake_hour", sql=f"""
    SELECT "timestamp", id, antenna_id, bytes, app, CAST(year("timestamp") AS INTEGER) AS year,
           CAST(month("timestamp") AS INTEGER) AS month, CAST(day("timestamp") AS INTEGER) AS day,
           CAST(hour("timestamp") AS INTEGER) AS hour
    FROM telemetry WHERE "timestamp" >= {AT_SQL} AND "timestamp" < {AT_SQL} + INTERVAL 1 HOUR""")
def q_src2(spark, d):
    root = _scratch(spark, "lake")
    sk.write_lake(views.telemetry(spark, d), root)
    return rd.read_lake_hour(spark, root, AT)


@register("A1_total_bytes_from_lake_hour", sql=f"""
    SELECT {AT_SQL} AS "timestamp", app AS id, CAST(sum(bytes) AS BIGINT) AS value,
           'app_total_bytes' AS type
    FROM telemetry WHERE "timestamp" >= {AT_SQL} AND "timestamp" < {AT_SQL} + INTERVAL 1 HOUR
    GROUP BY app""")
def q_a1_lake(spark, d):
    root = _scratch(spark, "lake")
    sk.write_lake(views.telemetry(spark, d), root)
    return tm.total_bytes_lake(rd.read_lake_hour(spark, root, AT), "app", AT)


def _listing_schema():
    spark_types = {"bigint": "long", "double": "double", "string": "string"}
    return ", ".join(f"{c} {spark_types[t]}" for c, t in LISTING_TYPES.items())


@register("SRC4_SNK4_csv_roundtrip", sql="SELECT * FROM listings")
def q_src4(spark, d):
    path = _scratch(spark, "csv")
    sk.write_csv(views.listings(spark, d), path, sep=";", null_value="\\N")
    return rd.read_csv(spark, path, sep=";", schema=_listing_schema(), null_value="\\N",
                       multi_line=True)  # quoted fields hold newlines


@register("SRC5_read_keyed_values", sql="""
    SELECT doc_id AS row_id, CAST(quality AS DOUBLE) AS y FROM labels""")
def q_src5(spark, d):
    path = _scratch(spark, "keyed")
    lab = views.table(spark, d, "labels")
    sk.write_keyed_values(lab.select("doc_id", F.col("quality").cast("double")), path)
    return rd.read_keyed_values(spark, path)


@register("SRC6_read_json_lines", sql="SELECT review_text AS reviewText, overall FROM reviews")
def q_src6(spark, d):
    path = _scratch(spark, "jsonl")
    r = views.reviews(spark, d).select(F.col("review_text").alias("reviewText"), "overall",
                                       "doc_id", "source")
    r.write.mode("overwrite").json(path)
    return rd.read_json_lines(spark, path)


@register("SRC7_SNK6_profile_roundtrip", sql="""
    WITH m AS (SELECT neighbourhood, avg(price) AS avgprice FROM listings
               WHERE neighbourhood IS NOT NULL GROUP BY 1),
    top AS (SELECT CAST(max(bedrooms) AS INTEGER) AS t FROM listings WHERE neighbourhood IS NOT NULL),
    c AS (SELECT neighbourhood, CAST(bedrooms AS INTEGER) AS b, count(*) AS total FROM listings
          WHERE bedrooms IS NOT NULL AND neighbourhood IS NOT NULL GROUP BY 1, 2)
    SELECT m.neighbourhood AS name, round(m.avgprice, 6) AS avgprice, CAST(g.b AS BIGINT) AS bedrooms,
           coalesce(c.total, 0) AS total
    FROM m CROSS JOIN top CROSS JOIN LATERAL (SELECT unnest(range(0, top.t + 1)) AS b) g
    LEFT JOIN c ON c.neighbourhood = m.neighbourhood AND c.b = g.b""")
def q_src7(spark, d):
    path = _scratch(spark, "features")
    prof = pf.neighbourhood_profile(views.listings(spark, d), nested=True)
    sk.write_profile_json(prof, path)
    feats = rd.read_features(spark, path)
    return (feats.select("name", F.round("avgprice", 6).alias("avgprice"),
                         F.explode("avgbedrooms").alias("b"))
                 .select("name", "avgprice", F.col("b.bedrooms").alias("bedrooms"),
                         F.col("b.total").alias("total")))


@register("SRC8_read_metric_file", sql="""
    SELECT antenna_id AS id, 'devices_count' AS metric, count(DISTINCT id) AS value
    FROM telemetry GROUP BY antenna_id, date_trunc('hour', "timestamp")
    UNION ALL
    SELECT antenna_id, 'bytes', CAST(sum(bytes) AS BIGINT) FROM telemetry
    GROUP BY antenna_id, date_trunc('hour', "timestamp")""")
def q_src8(spark, d):
    t = views.telemetry(spark, d).withColumn("h", F.date_trunc("hour", "timestamp"))
    m = t.groupBy("antenna_id", "h").agg(F.count_distinct("id").alias("devices_count"),
                                         F.sum("bytes").alias("bytes"))
    lines = m.select("h", F.inline(F.array(
        F.struct(F.to_json(F.struct(F.col("antenna_id").alias("id"),
                                    F.lit("devices_count").alias("metric"),
                                    F.col("devices_count").alias("value"))).alias("value")),
        F.struct(F.to_json(F.struct(F.col("antenna_id").alias("id"), F.lit("bytes").alias("metric"),
                                    F.col("bytes").alias("value"))).alias("value")))))
    seps = m.select("h").distinct().select("h", F.lit("---").alias("value"))
    path = _scratch(spark, "metrics")
    lines.unionByName(seps).sortWithinPartitions("h").select("value").write.mode("overwrite").text(path)
    return rd.read_metric_file(spark, path)


@register("SRC10_insert_new_keys", sql="""
    SELECT u.* FROM users u JOIN customer c ON u.id = CAST(c.c_custkey AS VARCHAR)
    WHERE c.c_mktsegment <> 'BUILDING'""")
def q_src10(spark, d):
    u = views.users(spark, d)
    seg = views.table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), "c_mktsegment")
    existing = u.join(seg, "id").filter(F.col("c_mktsegment") == "BUILDING").drop("c_mktsegment")
    return rd.insert_new_keys(existing, u, "id")
