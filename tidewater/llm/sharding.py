"""Shards of equal row counts in which every source keeps its share.

The method is proportional stratified interleaving. The rows of each source are
shuffled by a seeded digest and ranked; rank r of n rows stands at the fraction
(r - 1 + phase) / n, with one seeded phase per source, so that sources of a few
rows spread over all shards as well. All rows sorted by their fraction are cut into
runs whose lengths differ by one at most: any run holds every source in its share of
the whole, to within a row at each end.

Ranks and positions are found on narrow rows (digest, source), in buckets of the
digest and then of the fraction, whose counts give each bucket its first rank; no
task sees a whole source. A row's fraction is close to its place in the digest
order, so the texts are shuffled once, by ranges of that order: their narrow rows
meet them there, and a task writes to the one or two shards that its range falls in.

Defined results:

- a null source is a source of its own; null ids and null texts are values like others;
- rows of equal id, source and text count one by one and stand next to each other;
- an empty table gives no shards;
- columns of the input named ``shard`` or ``slot`` are replaced by the operator's.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import written
from .filters import masked

#: Rows of a bucket of the digest or of the fraction, on average.
BUCKET_ROWS = 2_000
#: Buckets at most; beyond BUCKET_ROWS * MAX_BUCKETS rows the buckets grow instead.
MAX_BUCKETS = 65_536
_HEX = 16 ** 8


def _plain(c: Column, kind: str) -> Column:
    """The value as text that tells null from every value."""
    return F.coalesce(F.concat(F.lit("="), F.md5(c.cast("binary")) if kind == "text"
                               else c.cast("string")), F.lit(""))


def _fraction_of(digest: Column) -> Column:
    """The first eight hexadecimal digits as a number from 0 to 2^32 - 1."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _keyed(docs: DataFrame, seed: int, key: str, by: str, text: str, buckets: int) -> DataFrame:
    stratum = _plain(F.col(by), "value")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), _plain(F.col(key), "value"), stratum,
                               _plain(F.col(text), "text")).cast("binary"))
    return docs.withColumn("_stratum", stratum).withColumn("_digest", digest).withColumn(
        "_bucket", F.floor(_fraction_of(F.col("_digest")) * buckets / _HEX).cast("int"))


def _before(counts: DataFrame, bucket: str, *group: str) -> DataFrame:
    """With ``before``: the sum of ``n`` over the lower buckets (of the group).

    A group has MAX_BUCKETS rows at most.
    """
    w = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))


def positions(keyed: DataFrame, seed: int, buckets: int) -> DataFrame:
    """Units of equal rows (``_bucket``, ``_digest``) with ``start``, their first position."""
    units = written(keyed.groupBy("_bucket", "_stratum", "_digest").agg(F.count("*").alias("n")),
                    "shard-units")
    counts = units.groupBy("_stratum", "_bucket").agg(F.sum("n").alias("n"))
    offsets = _before(counts, "_bucket", "_stratum").withColumn(
        "total", F.sum("n").over(Window.partitionBy("_stratum"))).drop("n")
    inside = Window.partitionBy("_bucket", "_stratum").orderBy("_digest").rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = units.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(
        offsets, ["_bucket", "_stratum"])
    phase = (_fraction_of(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_stratum"))
                                .cast("binary"))) + 0.5) / float(_HEX)
    fraction = (F.col("before") + F.col("inside") + phase) / F.col("total")
    placed = written(ranked.select(
        "_bucket", "_stratum", "_digest", "n", fraction.alias("fraction"),
        F.least(F.floor(fraction * buckets), F.lit(buckets - 1)).cast("int").alias("slice")),
        "shard-fractions")
    starts = _before(placed.groupBy("slice").agg(F.sum("n").alias("n")), "slice").drop("n")
    order = Window.partitionBy("slice").orderBy("fraction", "_stratum", "_digest").rowsBetween(
        Window.unboundedPreceding, -1)
    # one row per slice, MAX_BUCKETS at most
    return placed.withColumn("inside", F.coalesce(F.sum("n").over(order), F.lit(0))).join(
        F.broadcast(starts), "slice").select(
        "_bucket", "_digest", (F.col("before") + F.col("inside")).alias("start"))


def shard_of(position: Column, rows: int, shards: int) -> tuple[Column, Column]:
    """Shard and slot of a position: runs whose lengths differ by one at most."""
    def div(x: Column, y: int) -> Column:
        return F.call_function("div", x, F.lit(y).cast("long"))

    shard = div(position * shards, rows)
    return shard, position - div(shard * rows + (shards - 1), shards)


def write_shards(docs: DataFrame, path: str, shards: int = 40, seed: int = 13,
                 key: str = "doc_id", by: str = "source", text: str = "text") -> None:
    """Write ``docs`` to ``path``: a folder per shard, its files sorted by ``slot``.

    ``slot`` counts a shard's rows from 0 in the order of their fractions. ``by`` is
    the column whose mixture every shard keeps. The result depends on the rows and
    the seed alone, not on the input's partitions.
    """
    docs = docs.drop("shard", "slot")
    rows = docs.count()
    buckets = max(1, min(MAX_BUCKETS, rows // BUCKET_ROWS))
    hidden, names = masked(docs)
    keyed = _keyed(hidden, seed, names[key], names[by], names[text], buckets)
    starts = written(positions(keyed.select("_bucket", "_stratum", "_digest"), seed, buckets),
                     "shard-starts")
    both = keyed.drop("_stratum").withColumn("start", F.lit(None).cast("long")).unionByName(
        starts, allowMissingColumns=True)
    # a unit's narrow row comes first, then its copies
    same = Window.partitionBy("_bucket", "_digest").orderBy(F.col("start").asc_nulls_last())
    met = both.repartitionByRange("_bucket", "_digest").withColumn(
        "copy", F.row_number().over(same)).withColumn("first", F.first("start").over(same))
    position = F.col("first") + F.col("copy") - 2
    placed = met.where(F.col("start").isNull()).withColumn("position", position.cast("long"))
    shard, slot = shard_of(F.col("position"), max(1, rows), shards)
    placed.select(*[F.col(names[c]).alias(c) for c in docs.columns],
                  shard.cast("int").alias("shard"), slot.cast("long").alias("slot")) \
        .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows of all shards with ``shard`` and ``slot``; ``like`` gives the columns."""
    schema = like.drop("shard", "slot").limit(0).withColumns(
        {"slot": F.lit(None).cast("long"), "shard": F.lit(None).cast("int")}).schema
    return spark.read.schema(schema).parquet(path)


def interleaved(docs: DataFrame, **how) -> DataFrame:
    """``docs`` in shards (see ``write_shards``), under the shared checkpoint folder."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    write_shards(docs, path, **how)
    return read_shards(spark, path, docs)


#: The query op13_interleaved in DuckDB. The CRC runs over the bytes with the 256 remainders.
ORACLE_SQL = r"""
WITH RECURSIVE crc_step AS (
  SELECT i, 0 AS k, i::BIGINT AS c FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_step WHERE k = 8),
base AS (
  SELECT doc_id, text, coalesce('=' || CAST(source AS VARCHAR), '') AS stratum
  FROM documents),
keyed AS (
  SELECT doc_id, text, stratum, md5('13:' || coalesce('=' || CAST(doc_id AS VARCHAR), '') || ':'
    || stratum || ':' || coalesce('=' || md5(text), '')) AS digest
  FROM base),
ranked AS (
  SELECT *, count(*) OVER (PARTITION BY stratum) AS total,
    rank() OVER (PARTITION BY stratum ORDER BY digest) - 1 AS r,
    (CAST('0x' || substr(md5('13:' || stratum), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296.0::DOUBLE AS phase
  FROM keyed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY (r + phase) / total, stratum, digest) - 1 AS position,
    count(*) OVER () AS rows
  FROM ranked),
bytes AS (
  SELECT digest, any_value(text) AS text FROM placed GROUP BY digest),
sums AS (
  SELECT digest, coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(0, strlen(text) * 2, 2),
        lambda i: CAST('0x' || substr(h, i + 1, 2) AS BIGINT))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295), 0) AS crc
  FROM (SELECT digest, text, hex(encode(text)) AS h FROM bytes), crc_table)
SELECT doc_id, coalesce(strlen(text), 0) + 16 AS size, s.crc AS text_crc32, 'rows' AS law,
  CAST((position * 40) // rows AS INTEGER) AS shard,
  CAST(position - (((position * 40) // rows) * rows + 39) // 40 AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM placed JOIN sums s USING (digest)
"""
