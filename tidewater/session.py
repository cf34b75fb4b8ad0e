"""SparkSession defaults shared by jobs, tests and the bench.

Every job runs with the session time zone pinned to UTC (lake partitions,
hour arguments and window starts must agree), AQE on (runtime join choice,
partition coalescing, skew-join splitting) and the Spark UI off.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a partition counts as skewed above 5x the median and 64 MB
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming state (one row per open window and key) off the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "tidewater", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is only set when given, so a cluster launcher keeps control
    of it. ``shuffle_partitions`` sizes the initial shuffle; AQE coalesces
    small partitions at run time, so on a cluster it is set to cover the
    largest shuffle (about input bytes / 128 MB).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; without it a cluster session raises. Only a ``local`` master,
    where driver and executors are one process, gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share")
        conf_dir = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


#: Rows and bytes of one Arrow batch at most: whole texts are up to megabytes long,
#: so a batch of the default 10,000 rows could outgrow a Python worker. A single text
#: beyond the bytes is a batch of its own.
ARROW_ROWS = 512
ARROW_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches small (see ARROW_ROWS); smaller limits stay.

    The limits hold for the session: frames are evaluated after the call returns.
    """
    for name, limit in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= limit:
            spark.conf.set(key, str(limit))


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table under the shared folder: computed once for
    several readers, and kept when executors are lost."""
    path = shared_dir(df.sparkSession, f"{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Group tables up to so many rows are broadcast.
SMALL_ROWS = 100_000


def measured(groups: DataFrame) -> DataFrame:
    """A table of groups that is joined back to its facts, written once and counted.

    Spark takes an aggregate to be as large as its input and would shuffle
    all facts by the group key before it knows better. Up to SMALL_ROWS rows
    the written table is broadcast; beyond, its size is known to the planner,
    which then chooses (and splits hot keys of) the join itself.
    """
    table = written(groups, "groups")
    return F.broadcast(table) if table.count() <= SMALL_ROWS else table


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written tables and
    streaming checkpoints that must survive executor loss)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, *parts) if not base.startswith("file:") else \
        "file:" + os.path.join(base[len("file:"):], *parts)
