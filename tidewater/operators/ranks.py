"""Global order statistics without bringing the values into one partition.

Two ways, both of plain aggregates, joins and windows over bounded groups:

* ``quantiles`` narrows value ranges. One aggregate gives every group's extremes; then
  the values of a range are counted in CELLS equal cells, the cell that holds a wanted
  rank becomes the next range (its least and largest value, so that outliers drop
  out), and only rows in such cells are counted in the next pass. Two or three passes
  end at single values, for all groups, columns and ranks together; no value is sorted.
* ``value_ranks`` gives every distinct value its rank. Distinct values with their
  counts are written in ranges; running sums inside a range and the ranges' totals
  give the ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import measured, written

#: Cells that a value range is cut into by one pass.
CELLS = 4096
#: Distinct values of a range in ``value_ranks``, about.
RANGE_ROWS = 100_000


def value_ranks(df: DataFrame, col: str, by: Sequence[str] = (),
                partitions: int | None = None) -> DataFrame:
    """-> ``by..., value, cnt, below`` (rows of the group smaller than value)
    plus ``n`` (group size). Null values are left out."""
    by = list(by)
    counts = written(df.filter(F.col(col).isNotNull())
                       .groupBy(*by, F.col(col).alias("value"))
                       .agg(F.count(F.lit(1)).alias("cnt")), "rank-values")
    n_parts = partitions or max(1, -(-counts.count() // RANGE_ROWS))
    # written with the range's number: both uses below see the same ranges
    ranged = written(counts.repartitionByRange(n_parts, *[F.col(b) for b in by], F.col("value"))
                           .withColumn("__range", F.spark_partition_id()), "rank-ranges")
    totals = ranged.groupBy(*by, "__range").agg(F.sum("cnt").alias("__tot"))
    group = Window.partitionBy(*(by or [F.lit(0)]))
    # one row per range and group
    offsets = totals.withColumn("__off", F.coalesce(F.sum("__tot").over(
        group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) \
        .withColumn("n", F.sum("__tot").over(group)).drop("__tot")
    inside = Window.partitionBy(*by, "__range").orderBy("value").rowsBetween(
        Window.unboundedPreceding, -1)
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*by, "__range")]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    ranked = ranged.withColumn("__run", F.coalesce(F.sum("cnt").over(inside), F.lit(0)))
    return ranked.alias("r").join(measured(offsets).alias("o"), condition).select(
        *[F.col(f"r.{c}") for c in by], "value", "cnt",
        (F.col("__run") + F.col("__off")).alias("below"), "n")


def average_ranks(ranks: DataFrame) -> DataFrame:
    """Mid-rank of tied values: below + (cnt + 1) / 2."""
    return ranks.withColumn("avg_rank", F.col("below") + (F.col("cnt") + 1) / 2.0)


def _cell(cells: int):
    """Number of the value's cell in its range; halves keep the width finite."""
    share = (F.col("__x") / 2 - F.col("__lo") / 2) / (F.col("__hi") / 2 - F.col("__lo") / 2)
    return F.when(F.col("__hi") > F.col("__lo"), F.least(
        F.floor(share * cells), F.lit(cells - 1)).cast("int")).otherwise(F.lit(0))


def quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
              cells: int = CELLS) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / R type 7): ``by..., p, q``.

    For p, h = (n - 1) p; the answer is x[floor h] + (h - floor h) *
    (x[ceil h] - x[floor h]) with 0-based order statistics. Nulls and NaN are left
    out, a group without a value gives no row; infinite values count as the largest
    doubles. A null in ``by`` is a group like others.
    """
    by, big = list(by), 1.7976931348623157e308
    keys = [f"__k{i}" for i in range(len(by))]
    x = F.col(col).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(
        *[F.col(b).alias(k) for b, k in zip(by, keys)],
        F.greatest(F.least(x, F.lit(big)), F.lit(-big)).alias("__x"))

    def on(left: str, right: str, *more: str):
        # constant keys keep an equi-join where there is no group
        condition = F.lit(True)
        for c in (*keys, *more):
            condition = condition & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
        return condition

    facts = rows.groupBy(*keys).agg(F.count("__x").alias("n"), F.min("__x").alias("__lo"),
                                    F.max("__x").alias("__hi")).where("n > 0")
    facts = written(facts, "quantile-groups")
    h = (F.col("n") - 1) * F.col("p")
    wanted = facts.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p")) \
        .select("*", F.explode(F.array(F.struct(F.lit("lo").alias("side"), F.floor(h).alias("k")),
                                       F.struct(F.lit("hi").alias("side"), F.ceil(h).alias("k"))
                                       )).alias("s")) \
        .select(*keys, "p", "n", "__lo", "__hi", "s.side", "s.k")
    if keys:
        rows = rows.alias("r").join(measured(facts.drop("n")).alias("f"), on("r", "f")).select(
            *[F.col(f"r.{k}") for k in keys], "__x", "__lo", "__hi")
    else:
        one = facts.agg(F.struct(F.first("__lo").alias("lo"), F.first("__hi").alias("hi"))).scalar()
        rows = rows.withColumns({"__lo": one["lo"], "__hi": one["hi"]})
    wanted = written(wanted, "quantile-ranks")
    while not wanted.where("__hi > __lo").isEmpty():
        rows = rows.withColumn("__cell", _cell(cells))
        counts = written(rows.groupBy(*keys, "__lo", "__cell").agg(
            F.count("__x").alias("c"), F.min("__x").alias("mn"), F.max("__x").alias("mx")),
            "quantile-cells")
        # CELLS rows per range at most
        w = Window.partitionBy(*keys, "__lo").orderBy("__cell").rowsBetween(
            Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.coalesce(F.sum("c").over(w), F.lit(0)))
        hit = wanted.where("__hi > __lo").alias("w").join(counts.alias("c"), on("w", "c", "__lo") & (
            F.col("k") >= F.col("before")) & (F.col("k") < F.col("before") + F.col("c")))
        hit = written(hit.select(*[F.col(f"w.{k}") for k in keys], "p", "n", "side",
                                 (F.col("k") - F.col("before")).alias("k"),
                                 F.col("w.__lo").alias("__from"), "__cell",
                                 F.col("mn").alias("__lo"), F.col("mx").alias("__hi")),
                      "quantile-hits")
        open_ranges = measured(hit.where("__hi > __lo").select(
            *keys, "__from", "__cell", F.col("__lo").alias("lo"), F.col("__hi").alias("hi"))
            .distinct().withColumnRenamed("__from", "__lo"))
        rows = rows.alias("r").join(open_ranges.alias("o"), on("r", "o", "__lo", "__cell")).select(
            *[F.col(f"r.{k}") for k in keys], "__x", F.col("lo").alias("__lo"),
            F.col("hi").alias("__hi"))
        wanted = written(wanted.where("__hi <= __lo").unionByName(
            hit.drop("__from", "__cell")), "quantile-ranks")
    ends = wanted.groupBy(*keys, "p").agg(
        F.first("n").alias("n"),
        *[F.max(F.when(F.col("side") == s, F.col("__lo"))).alias(s) for s in ("lo", "hi")])
    part = h - F.floor(h)
    return ends.select(*[F.col(k).alias(b) for b, k in zip(by, keys)], "p",
                       (F.col("lo") + part * (F.col("hi") - F.col("lo"))).alias("q"))
