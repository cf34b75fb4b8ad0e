"""Queries of the speed layer (ST1, ST3, ST4, SNK2)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from .. import views
from ..operators import telemetry as tm
from ..session import shared_dir
from ..streaming import telemetry as st
from .registry import register

CUTOFF = "2024-01-15 00:00:00"


def closed_windows(key: str) -> str:
    """SQL of the windows that a watermark of 30 seconds behind the last event has passed."""
    return f"""
    SELECT to_timestamp(floor(epoch("timestamp") / 300) * 300)::TIMESTAMP AS "timestamp",
           {key} AS id, CAST(sum(bytes) AS BIGINT) AS value, '{key}_total_bytes' AS type
    FROM telemetry
    WHERE to_timestamp(floor(epoch("timestamp") / 300) * 300 + 300)::TIMESTAMP
          <= (SELECT max("timestamp") FROM telemetry) - INTERVAL 30 SECOND
    GROUP BY 1, 2"""


@register("ST1_windowed_total_batch_form", sql="""
    SELECT to_timestamp(floor(epoch("timestamp") / 300) * 300)::TIMESTAMP AS "timestamp", app AS id,
           CAST(sum(bytes) AS BIGINT) AS value, 'app_total_bytes' AS type
    FROM telemetry GROUP BY 1, 2""")
def q_st1(spark, d):
    return st.windowed_total(views.telemetry(spark, d), "app", "5 minutes", "30 seconds")


@register("ST1_windowed_total_by_antenna_batch_form", sql="""
    SELECT to_timestamp(floor(epoch("timestamp") / 300) * 300)::TIMESTAMP AS "timestamp", antenna_id AS id,
           CAST(sum(bytes) AS BIGINT) AS value, 'antenna_id_total_bytes' AS type
    FROM telemetry GROUP BY 1, 2""")
def q_st1b(spark, d):
    return st.windowed_total(views.telemetry(spark, d), "antenna_id", "5 minutes", "30 seconds")


def stage_raw_files(spark, d, root: str, files_by: str = "day"):
    """The Kafka payload of every event written as JSON-lines files, one
    folder per day, so a file stream sees the days arrive in order."""
    raw = views.telemetry(spark, d).select(
        F.date_format("timestamp", "yyyyMMdd").alias("day"),
        F.to_json(F.struct(F.unix_timestamp("timestamp").alias("timestamp"), "id", "antenna_id",
                           "bytes", "app")).alias("value"))
    raw.write.mode("overwrite").partitionBy(files_by).text(root)
    st.order_files_by_name(spark, root)
    return root


@register("ST1_windowed_total_streamed", sql=closed_windows("app"))
def q_st1_stream(spark, d):
    """File stream of the payloads (availableNow) -> windows by app ->
    idempotent batch folders; the committed output is read back. Only
    windows closed by the final watermark are emitted (append mode)."""
    base = shared_dir(spark, "tidewater-stream", uuid.uuid4().hex[:12])
    src = stage_raw_files(spark, d, os.path.join(base, "in"))
    raw = spark.readStream.schema("value string").option("maxFilesPerTrigger", 4).text(src)
    metric = st.windowed_total(st.parsed_stream(raw), "app", "5 minutes", "30 seconds")
    out = os.path.join(base, "out")
    q = st.stream_to_sink(metric, st.idempotent_parquet_batch_writer(out),
                          os.path.join(base, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(out).select(*tm.METRIC_COLS)


@register("ST3_lambda_stream", sql=" UNION ALL ".join(
    f"SELECT '{k}_total_bytes' AS type, count(*) AS rows FROM ({closed_windows(k)})"
    for k in ("antenna_id", "id", "app"))
    + " UNION ALL SELECT 'lake', count(*) FROM telemetry WHERE \"timestamp\" IS NOT NULL")
def q_st3(spark, d):
    """Four queries from one parsed source; returns the row counts each
    sink committed (the lake is read back as a table)."""
    base = shared_dir(spark, "tidewater-lambda", uuid.uuid4().hex[:12])
    src = stage_raw_files(spark, d, os.path.join(base, "in"))
    raw = spark.readStream.schema("value string").option("maxFilesPerTrigger", 8).text(src)
    qs = st.lambda_stream(raw, os.path.join(base, "out"), os.path.join(base, "ckpt"),
                          trigger={"availableNow": True})
    for q in qs:
        q.awaitTermination()
    outs = [spark.read.parquet(os.path.join(base, "out", f"{k}_total_bytes"))
            .select(*tm.METRIC_COLS) for k in ("antenna_id", "id", "app")]
    lake = spark.read.parquet(os.path.join(base, "out", "lake"))
    metrics = outs[0].unionByName(outs[1]).unionByName(outs[2])
    return metrics.groupBy("type").agg(F.count(F.lit(1)).alias("rows")).unionByName(
        lake.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("lake").alias("type"), "rows"))


@register("ST4_speed_plus_batch", sql=f"""
    WITH hourly AS (
      SELECT date_trunc('hour', "timestamp") AS "timestamp", app AS id, CAST(sum(bytes) AS BIGINT) AS value,
             'app_total_bytes' AS type
      FROM telemetry WHERE "timestamp" < TIMESTAMP '{CUTOFF}' GROUP BY 1, 2),
    recent AS (
      SELECT to_timestamp(floor(epoch("timestamp") / 300) * 300)::TIMESTAMP AS "timestamp", app AS id,
             CAST(sum(bytes) AS BIGINT) AS value, 'app_total_bytes' AS type
      FROM telemetry GROUP BY 1, 2)
    SELECT * FROM hourly
    UNION ALL
    SELECT * FROM recent r WHERE NOT EXISTS (
      SELECT 1 FROM hourly h WHERE h."timestamp" = date_trunc('hour', r."timestamp") AND h.type = r.type)""")
def q_st4(spark, d):
    t = views.telemetry(spark, d)
    hourly = tm.total_bytes(t.filter(F.col("timestamp") < F.lit(CUTOFF).cast("timestamp")), "app")
    recent = st.windowed_total(t, "app", "5 minutes", "30 seconds")
    return st.speed_plus_batch(hourly, recent)


@register("ST2_late_rows_dropped", sql=closed_windows("app"))
def q_st2(spark, d):
    """The first day's payloads are delivered a second time after every
    other day: by then the watermark is far past them, so the replayed
    rows are dropped and the committed windows equal the on-time run
    (compare with ``ST1_windowed_total_streamed``)."""
    base = shared_dir(spark, "tidewater-late", uuid.uuid4().hex[:12])
    src = stage_raw_files(spark, d, os.path.join(base, "in"))
    staged = spark.read.text(src)  # value + the day partition column
    first = staged.agg(F.min("day")).scalar()
    (staged.filter(F.col("day") == first).select("value")
           .write.mode("overwrite").text(os.path.join(src, "day=99999999")))
    st.order_files_by_name(spark, src)
    raw = spark.readStream.schema("value string").option("maxFilesPerTrigger", 4).text(src)
    metric = st.windowed_total(st.parsed_stream(raw), "app", "5 minutes", "30 seconds")
    out = os.path.join(base, "out")
    q = st.stream_to_sink(metric, st.idempotent_parquet_batch_writer(out),
                          os.path.join(base, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(out).select(*tm.METRIC_COLS)
