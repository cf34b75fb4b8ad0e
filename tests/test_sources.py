"""Sources and sinks: reader options, partition pruning, round trips."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from core_helpers import SF_SMALL
from tidewater import views
from tidewater.sources import readers as rd
from tidewater.sources import sinks as sk


def test_kafka_reader_needs_connector(spark):
    import pytest
    from pyspark.sql.streaming import DataStreamReader
    r = rd.kafka_reader(spark, "broker:9092", "telemetry", maxOffsetsPerTrigger="1000")
    assert isinstance(r, DataStreamReader)  # built without touching a broker
    with pytest.raises(Exception, match="(?i)kafka"):
        rd.read_kafka(spark, "broker:9092", "telemetry")


def test_lake_hour_prunes_partitions(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="tw-lake-"), "lake")
    sk.write_lake(views.telemetry(spark, SF_SMALL), root)
    at = dt.datetime(2024, 1, 1, 5, tzinfo=dt.timezone.utc)
    df = rd.read_lake_hour(spark, root, at, persist=False)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "hour" in plan
    want = views.telemetry(spark, SF_SMALL).filter(
        (F.col("timestamp") >= F.lit(dt.datetime(2024, 1, 1, 5))) &
        (F.col("timestamp") < F.lit(dt.datetime(2024, 1, 1, 6)))).count()
    assert df.count() == want


def test_insert_new_keys_is_idempotent(spark):
    dim = spark.createDataFrame([("1", "a")], "id string, email string")
    inc = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, email string")
    new = rd.insert_new_keys(dim, inc, "id")
    assert [r.id for r in new.collect()] == ["2"]
    assert rd.insert_new_keys(dim.unionByName(new), inc, "id").count() == 0


def test_metric_file_skips_separators(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="tw-metric-"), "m.json")
    with open(p, "w") as f:
        f.write('{"id": "a", "metric": "battery", "value": 9}\n---\n{"id": "b", "metric": "status", "value": 1}\n---\n')
    assert sorted(tuple(r) for r in rd.read_metric_file(spark, p).collect()) == [
        ("a", "battery", 9), ("b", "status", 1)]


def test_feature_collection_document(spark):
    p = os.path.join(tempfile.mkdtemp(prefix="tw-geo-"), "f.json")
    with open(p, "w") as f:
        f.write('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": '
                '{"name": "Sol", "avgprice": 80.5, "avgbedrooms": [{"bedrooms": 0, "total": 3}]}}]}')
    r = rd.read_features(spark, p, collection=True).first()
    assert r.name == "Sol" and r.avgprice == 80.5 and r.avgbedrooms[0].total == 3


def test_lake_files_follow_hours_and_bytes(spark):
    rows = spark.range(60_000).selectExpr(
        "timestamp_seconds(1600000000 + 3600 * (id % 4)) AS timestamp", "uuid() AS id",
        "id AS bytes").repartition(16)

    def files(root):
        found = spark.read.parquet(root).selectExpr("hour", "input_file_name() AS f").distinct()
        return {r["hour"]: r["count"] for r in found.groupBy("hour").count().collect()}

    one = os.path.join(tempfile.mkdtemp(prefix="tw-lake-"), "lake")
    sk.write_lake(rows, one)
    assert sorted(files(one).values()) == [1, 1, 1, 1]
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    hot = rows.where("id IS NOT NULL").withColumn(
        "timestamp", F.expr("CASE WHEN bytes % 10 > 0 THEN timestamp_seconds(1600000000) "
                            "ELSE timestamp END"))
    two = os.path.join(tempfile.mkdtemp(prefix="tw-lake-"), "lake")
    try:
        for k in keys:
            spark.conf.set(k, "128k")
        sk.write_lake(hot, two)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 3 < max(files(two).values()) < 40
    assert spark.read.parquet(two).count() == 60_000
