"""Sources (SRC1-SRC8, SRC10)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.telemetry import _hour_start


# SRC1
def kafka_reader(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                 **options):
    """Streaming reader of one Kafka topic (``load()`` needs the Kafka
    connector on the classpath). Extra options pass through, e.g.
    ``maxOffsetsPerTrigger`` to bound a micro-batch."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting))
    for k, v in options.items():
        r = r.option(k, v)
    return r


def read_kafka(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:
    return kafka_reader(spark, servers, topic, **kw).load()


# SRC2
def read_lake_hour(spark: SparkSession, root: str, at, persist: bool = True) -> DataFrame:
    """One hour of the partitioned lake: equality filters on the partition
    columns (plain literals, so the scan prunes to one folder). Persisted
    (memory and disk) because 3-4 aggregates read it; a lost block is
    recomputed from the lake."""
    h = _hour_start(at)
    df = (spark.read.parquet(root)
          .filter((F.col("year") == h.year) & (F.col("month") == h.month)
                  & (F.col("day") == h.day) & (F.col("hour") == h.hour)))
    return df.persist(StorageLevel.MEMORY_AND_DISK) if persist else df


# SRC3
def read_jdbc(spark: SparkSession, url: str, table: str, props: dict | None = None,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Full-table JDBC read; with ``partition_column`` the table is read by
    ``num_partitions`` parallel range queries instead of one."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (props or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


# SRC4
def read_csv(spark: SparkSession, path: str, sep: str = ";", schema: T.StructType | str | None = None,
             header: bool = True, null_value: str | None = None, multi_line: bool = False,
             infer_schema: bool = False) -> DataFrame:
    """Headed CSV. An empty field is null (pandas' NaN) unless
    ``null_value`` names the null marker. ``multi_line``, for quoted fields
    that hold newlines, gives every file to one task; ``infer_schema``
    reads the files twice. Without schema and inference columns are text."""
    r = spark.read.option("header", header).option("sep", sep).option("escape", '"') \
        .option("multiLine", multi_line).option("inferSchema", infer_schema and schema is None)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    return (r.schema(schema) if schema is not None else r).csv(path)


# SRC5
KEYED_SCHEMA = "row_id long, y double"


def read_keyed_values(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    return spark.read.schema(KEYED_SCHEMA).option("sep", sep).option("header", False).csv(path)


# SRC6
REVIEW_SCHEMA = "reviewText string, overall double"


def read_json_lines(spark: SparkSession, path: str, cols=("reviewText", "overall"),
                    schema: str | T.StructType = REVIEW_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path).select(*cols)


# SRC7
FEATURE_PROPS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("avgprice", T.DoubleType()),
    T.StructField("avgbedrooms", T.ArrayType(T.StructType([
        T.StructField("bedrooms", T.LongType()), T.StructField("total", T.LongType())]))),
])
FEATURE = T.StructType([T.StructField("type", T.StringType()),
                        T.StructField("properties", FEATURE_PROPS)])


def read_features(spark: SparkSession, path: str, collection: bool = False) -> DataFrame:
    """One row per feature: a FeatureCollection document (``collection``)
    or feature-per-line JSON, as written by ``write_profile_json``."""
    if collection:
        doc = spark.read.option("multiLine", True).schema(
            T.StructType([T.StructField("features", T.ArrayType(FEATURE))])).json(path)
        feats = doc.select(F.explode("features").alias("f")).select("f.*")
    else:
        feats = spark.read.schema(FEATURE).json(path)
    return feats.select("properties.*")


# SRC8
METRIC_SCHEMA = "id string, metric string, value long"


def read_metric_file(spark: SparkSession, path: str) -> DataFrame:
    """``{id, metric, value}`` lines with ``---`` batch separators."""
    lines = spark.read.text(path)
    body = lines.filter((F.trim("value") != "---") & (F.trim("value") != ""))
    return body.select(F.from_json("value", METRIC_SCHEMA).alias("m")).select("m.*")


# SRC10
def insert_new_keys(existing: DataFrame, incoming: DataFrame, key: str | list[str]
                    ) -> DataFrame:
    """Rows of ``incoming`` whose key is not yet in ``existing`` (so a
    re-run inserts nothing twice, D19); append them to the dimension."""
    keys = [key] if isinstance(key, str) else list(key)
    return incoming.join(existing.select(*keys), keys, "left_anti")
