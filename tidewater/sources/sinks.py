"""Sinks (SNK1, SNK3 batch form, SNK4-SNK6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import partition_fields

LAKE_PARTITIONS = ["year", "month", "day", "hour"]


# SNK1
def write_jdbc(df: DataFrame, url: str, table: str, props: dict | None = None,
               mode: str = "append", batch_size: int = 10_000) -> None:
    """Append to a serving table; credentials come from ``props`` (the
    caller's configuration), never from code."""
    w = df.write.mode(mode).format("jdbc").option("url", url).option("dbtable", table) \
        .option("batchsize", batch_size)
    for k, v in (props or {}).items():
        w = w.option(k, v)
    w.save()


# SNK3 (batch form; the streaming form is streaming.telemetry.stream_to_lake)
def lake_rows(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Telemetry -> lake rows: event time kept (D3) plus UTC partition
    fields; rows without an event time are left out (they would land in
    the default partition)."""
    return df.filter(F.col(ts).isNotNull()).select("*", *partition_fields(ts))


def write_lake(df: DataFrame, root: str, mode: str = "append") -> None:
    """Partitioned Parquet after a rebalance on the partition columns: an hour's rows meet
    in one task and one file, and AQE splits an hour beyond the advisory partition size
    over several. The number of files follows the hours and bytes, not the input's tasks."""
    rows = lake_rows(df).hint("rebalance", *LAKE_PARTITIONS)
    (rows.sortWithinPartitions(*LAKE_PARTITIONS)
         .write.mode(mode).partitionBy(*LAKE_PARTITIONS).parquet(root))


# SNK4
def write_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True,
              mode: str = "overwrite", null_value: str | None = None) -> None:
    """Headed CSV. By default a null is an empty field, as pandas writes
    NaN; ``null_value`` (e.g. ``\\N``) keeps null and '' apart."""
    w = df.write.mode(mode).option("sep", sep).option("header", header).option("escape", '"')
    if null_value is not None:
        w = w.option("nullValue", null_value)
    w.csv(path)


def write_keyed_values(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite") -> None:
    df.write.mode(mode).option("sep", sep).option("header", False).csv(path)


# SNK5
def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


# SNK6
def write_profile_json(profile: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Nested neighbourhood profile (``neighbourhood_profile(nested=True)``)
    as one GeoJSON-style feature per line."""
    feats = profile.select(F.lit("Feature").alias("type"),
                           F.struct("name", "avgprice", "avgbedrooms").alias("properties"))
    feats.write.mode(mode).json(path)
