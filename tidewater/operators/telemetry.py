"""Telemetry metrics of the lambda architecture (batch side): A1, A2, J1, P4.

Metric rows share one long schema ``(timestamp, id, value, type)`` so that
several metrics live in one table (``append_all``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import epoch_to_timestamp, parse_json_value

METRIC_COLS = ["timestamp", "id", "value", "type"]


def _hour_start(at) -> dt.datetime:
    """An hour argument (datetime, aware or naive UTC, or ISO text) -> the
    start of that hour in UTC, as a naive datetime (session zone is UTC)."""
    if isinstance(at, str):
        at = dt.datetime.fromisoformat(at.replace("Z", "+00:00"))
    if at.tzinfo is not None:
        at = at.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return at.replace(minute=0, second=0, microsecond=0)


# S1 -------------------------------------------------------------------------
def parse_telemetry(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Kafka record -> telemetry columns; junk rows become all-null rows."""
    return df.select(parse_json_value(value_col).alias("json")).select("json.*")


def with_event_time(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """epoch seconds -> timestamp (S2), in place."""
    return df.withColumn(col, epoch_to_timestamp(col))


# P4 -------------------------------------------------------------------------
def tag(df: DataFrame, metric_type: str, at=None) -> DataFrame:
    """Constant metric name and (optionally) constant timestamp."""
    out = df.withColumn("type", F.lit(metric_type))
    if at is not None:
        out = out.withColumn("timestamp", F.lit(_hour_start(at)).cast("timestamp"))
    return out


# A1 -------------------------------------------------------------------------
def total_bytes(df: DataFrame, key: str, at=None) -> DataFrame:
    """``sum(bytes)`` by ``key`` -> metric rows ``<key>_total_bytes``.

    With ``at`` the rows of that UTC hour are kept and stamped with the hour
    start (D4, D5); without it every hour gets its own rows (batch layer
    over the whole lake). Partial aggregation runs before the shuffle, so a
    hot key costs one row per map task.
    """
    if at is not None:
        start = _hour_start(at)
        end = start + dt.timedelta(hours=1)
        src = df.filter((F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)))
        hour = F.lit(start).cast("timestamp")
    else:
        src = df
        hour = F.date_trunc("hour", F.col("timestamp"))
    return (src.groupBy(hour.alias("timestamp"), F.col(key).alias("id"))
               .agg(F.sum("bytes").alias("value"))
               .withColumn("type", F.lit(f"{key}_total_bytes"))
               .select(*METRIC_COLS))


def total_bytes_all(df: DataFrame, keys=("id", "antenna_id", "app")) -> DataFrame:
    """A1 for several keys in one scan and one shuffle: each event is
    expanded to one ``(type, id)`` pair per key, then a single aggregate
    (partial before the exchange) yields the union of the per-key tables."""
    pairs = F.array(*[F.struct(F.lit(f"{k}_total_bytes").alias("type"),
                               F.col(k).cast("string").alias("id")) for k in keys])
    return (df.select(F.date_trunc("hour", "timestamp").alias("timestamp"), "bytes",
                      F.inline(pairs))
              .groupBy("timestamp", "id", "type")
              .agg(F.sum("bytes").alias("value"))
              .select(*METRIC_COLS))


def total_bytes_lake(lake: DataFrame, key: str, at) -> DataFrame:
    """A1 over a lake already restricted to one hour (``read_lake_hour``)."""
    start = _hour_start(at)
    return (lake.groupBy(F.col(key).alias("id"))
                .agg(F.sum("bytes").alias("value"))
                .withColumn("type", F.lit(f"{key}_total_bytes"))
                .withColumn("timestamp", F.lit(start).cast("timestamp"))
                .select(*METRIC_COLS))


# A2 -------------------------------------------------------------------------
def total_bytes_by_email(df: DataFrame, users: DataFrame, at=None) -> DataFrame:
    """Bytes by user e-mail: aggregate by id first (small), then join the
    dimension, then re-aggregate (two ids may share an e-mail)."""
    by_id = total_bytes(df, "id", at)
    return (by_id.join(users.select("id", "email"), "id")
                 .groupBy("timestamp", F.col("email").alias("id"))
                 .agg(F.sum("value").alias("value"))
                 .withColumn("type", F.lit("email_total_bytes"))
                 .select(*METRIC_COLS))


# J1 -------------------------------------------------------------------------
def quota_exceeded(usage: DataFrame, users: DataFrame) -> DataFrame:
    """Usage rows above their user's quota, with the e-mail.

    No broadcast hint: the user dimension grows with the customer base, so
    AQE picks broadcast from the measured size and sort-merge beyond it.
    """
    with_quota = usage.join(users.select("id", "quota", "email"), on="id")
    return with_quota.where("value > quota").withColumnRenamed("value", "usage").select(
        "email", "usage", "quota", "timestamp")


def hourly_quota_breaches(telemetry: DataFrame, users: DataFrame) -> DataFrame:
    """The flagship: per hour and user, usage above quota."""
    return quota_exceeded(total_bytes(telemetry, "id"), users)
