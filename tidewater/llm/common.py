"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ARROW_BYTES, ARROW_ROWS, bounded_batches, ensure_checkpoint_dir  # noqa: F401

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder of ``spark.checkpoint.dir``.

    Cuts the lineage: later readers scan files that survive lost executors
    instead of recomputing the plan.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Collect the driver's garbage, and with it what finished steps left.

    Spark drops the broadcasts and shuffles of a plan once the driver's JVM has
    collected the plan. Between the many small plans of an iteration that may
    be much later, with the heap grown to its limit in the meantime.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front where ``df`` has such a column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


#: Tables of up to so many bytes are broadcast.
BROADCAST_BYTES = 64 << 20


def small(table: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """``table`` with a broadcast hint if its rows, counted, are small enough together.

    Beyond that the planner joins it by shuffles, with the same result.
    """
    rows = table.count() if rows is None else rows
    return F.broadcast(table) if rows * row_bytes <= BROADCAST_BYTES else table


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once.

    A column expression named inside a lambda is computed for every element;
    a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def hash_share(key: Column, share: Column) -> Column:
    """True for the rows whose key hash falls in the first ``share`` of its range.

    The choice depends on the key alone, so a re-run task repeats it.
    """
    return (F.pmod(F.xxhash64(key), F.lit(1 << 30)) / F.lit(float(1 << 30))) < share


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, eligible: Column,
                    max_rows: int, tag: str) -> DataFrame:
    """About ``max_rows`` labelled documents (``doc_id``, ``text``, ``label``), as a table.

    ``eligible`` is a condition on ``doc_id``. Rows with a null id or label
    are left out; labels that repeat an id count once (the largest label),
    texts that repeat an id stay. The ids are chosen by hash, and only those
    ids and labels are broadcast: their number is bounded by ``max_rows``
    (in expectation), whatever the size of the corpus.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & eligible)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    n = known.count()
    chosen = known.where(hash_share(F.col("doc_id"), F.lit(min(1.0, max_rows / max(1, n)))))
    return written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), tag)
