"""Profiling aggregates (A3-A26): frequency tables, group means, null
reports, distributions, correlations, metrics.

Global scalars (totals, extremes) enter row expressions as scalar
subqueries (``DataFrame.scalar()``): one small aggregate job, no join and
nothing collected. Wide reports compute every column in one aggregate and
unpivot the single row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import measured
from .frames import pearson
from .ranks import quantiles


def _total(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


# A3 / A25
def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """count, ratio and percent (2 decimals) per value; the total is the
    number of rows considered (non-null ones unless ``dropna=False``)."""
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    total = _total(src)
    return (src.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
               .withColumn("ratio", F.col("count") / total)
               .withColumn("percent", F.round(F.col("count") * 100.0 / total, 2)))


# A4
def value_counts_by(df: DataFrame, group: str, col: str) -> DataFrame:
    """Frequency of ``col`` inside each ``group`` with the share per group."""
    src = df.filter(F.col(col).isNotNull() & F.col(group).isNotNull())
    counts = src.groupBy(group, col).agg(F.count(F.lit(1)).alias("count"))
    totals = src.groupBy(group).agg(F.count(F.lit(1)).alias("__gt"))
    return (counts.join(totals, group)
                  .withColumn("ratio", F.col("count") / F.col("__gt")).drop("__gt"))


# A5
def mean_by(df: DataFrame, key: str, col: str, out: str | None = None) -> DataFrame:
    """Mean per group, nulls skipped (``na.rm``), null keys dropped (pandas)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
              .agg(F.avg(col).alias(out or f"mean_{col}")))


# A6
def group_profile(df: DataFrame, key: str, price: str, size: str) -> DataFrame:
    """Mean price, rows and mean size per group in one aggregate."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(price).alias("mean_price"),
                               F.avg(size).alias("mean_size"))


# A7
def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None,
                    approx: bool = False, rsd: float = 0.02) -> DataFrame:
    """Distinct values per column, null counted as one more value
    (``unique()``). Exact: one unpivot + two aggregates whatever the width
    (no per-column distinct expansion); approximate: HyperLogLog++ per
    column in one pass."""
    cols = list(cols or df.columns)
    if approx:
        row = df.agg(*[(F.approx_count_distinct(c, rsd) +
                        F.max(F.col(c).isNull().cast("int"))).alias(f"d{i}")
                       for i, c in enumerate(cols)])
        return row.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("n_distinct"))
            for i, c in enumerate(cols)])))
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in cols])))
    return (long.groupBy("column", "value").agg(F.lit(1).alias("__one"))
                .groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct")))


# A8
def distinct_values(df: DataFrame, col: str, where: Column | None = None) -> DataFrame:
    src = df.filter(where) if where is not None else df
    return src.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


# A9
def null_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    from .frames import null_fractions
    return null_fractions(df, cols).withColumn("percent", F.round(F.col("fraction") * 100, 2))


# A10
def null_share_by(df: DataFrame, key: str, col: str, min_share: float | None = None
                  ) -> DataFrame:
    out = df.groupBy(key).agg(F.avg(F.col(col).isNull().cast("double")).alias("null_share"),
                              F.count(F.lit(1)).alias("n"))
    return out.filter(F.col("null_share") >= min_share) if min_share is not None else out


# A11
def share_where(df: DataFrame, pred: Column, name: str = "percent") -> DataFrame:
    """Percent of rows meeting ``pred`` (a null test counts as not met)."""
    return df.agg(F.round(F.avg(F.coalesce(pred, F.lit(False)).cast("double")) * 100, 2)
                  .alias(name))


# A12
def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, nulls, mean, sd (n-1), min, quartiles (exact, linear), max
    per column; one row per column."""
    cols = list(cols)
    moments = df.agg(*[e for i, c in enumerate(cols) for e in (
        F.count(c).alias(f"n{i}"), F.count_if(F.col(c).isNull()).alias(f"z{i}"),
        F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
        F.min(c).cast("double").alias(f"lo{i}"), F.max(c).cast("double").alias(f"hi{i}"))])
    long = moments.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"z{i}").alias("nulls"),
        F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
        F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max")) for i, c in enumerate(cols)])))
    vals = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])))
    q = quantiles(vals, "x", [0.25, 0.5, 0.75], by=["column"])
    qw = q.groupBy("column").pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q"))
    qw = qw.toDF("column", "q25", "q50", "q75")
    return long.join(qw, "column", "left")


def describe_levels(df: DataFrame, cols: Sequence[str], top: int = 6) -> DataFrame:
    """The text columns' part of a summary: the ``top`` levels of each column with their
    counts (``column``, ``rank`` from 1, ``level``, ``count``); ties by level, nulls left out.

    All columns are counted in one aggregate; each column's ranking keeps ``top`` rows
    per task before its shuffle.
    """
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols])))
    counts = long.where(F.col("level").isNotNull()).groupBy("column", "level").agg(
        F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("column").orderBy(F.desc("count"), "level")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


# A13
def column_mode(df: DataFrame, col: str) -> DataFrame:
    """Most frequent value, the smallest among ties (pandas ``mode()[0]``).
    Counting is distributed; only the top row is taken (TakeOrdered)."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), F.col(col).asc()).limit(1)


def column_stat(df: DataFrame, col: str, fn: str) -> Column | DataFrame:
    """mean / max / min / mode of one column (one-row frame)."""
    if fn == "mode":
        return column_mode(df, col).select(F.col(col).alias("mode"))
    f = {"mean": F.avg, "max": F.max, "min": F.min}[fn]
    return df.agg(f(col).alias(fn))


# A14
def corr_with(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    row = df.agg(*[pearson(c, target).alias(f"c{i}") for i, c in enumerate(cols)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("corr"))
        for i, c in enumerate(cols)])))


# A15
def corr_matrix(df: DataFrame, cols: Sequence[str], absolute: bool = True) -> DataFrame:
    """Pearson over pairwise-complete rows, long form for i < j."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[pearson(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs)])
    val = (lambda c: F.abs(c)) if absolute else (lambda c: c)
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), val(F.col(f"c{k}")).alias("corr"))
        for k, (a, b) in enumerate(pairs)])))


# A16
def histogram(df: DataFrame, col: str, bins: int, lo: float | None = None,
              hi: float | None = None, density: bool = False) -> DataFrame:
    """Equal-width bins over [lo, hi] (default: the column's range), last
    bin closed; empty bins count 0. -> bin, left, right, count[, density].

    A range of one value is widened by a half on both sides, as numpy does; a
    column without values has bins that count 0, with null ends.
    """
    src = df.filter(F.col(col).isNotNull())
    lo_c = F.lit(float(lo)) if lo is not None else src.agg(F.min(col).cast("double")).scalar()
    hi_c = F.lit(float(hi)) if hi is not None else src.agg(F.max(col).cast("double")).scalar()
    src = src.filter((F.col(col) >= lo_c) & (F.col(col) <= hi_c))
    flat = F.when(lo_c == hi_c, 0.5).otherwise(0.0)
    lo_c, hi_c = lo_c - flat, hi_c + flat
    width = (hi_c - lo_c) / bins
    b = F.least(F.floor((F.col(col) - lo_c) / width), F.lit(bins - 1)).cast("int")
    # one empty row per bin, so that bins without values are there too
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"),
                                               F.lit(0).alias("one"))
    out = (src.select(b.alias("bin"), F.lit(1).alias("one")).unionByName(every)
              .groupBy("bin").agg(F.sum("one").alias("count"))
              .withColumn("left", lo_c + F.col("bin") * width)
              .withColumn("right", lo_c + (F.col("bin") + 1) * width))
    if density:
        out = out.withColumn("density", F.try_divide(F.col("count"), _total(src) * width))
    return out


# A17
def box_stats(df: DataFrame, col: str, by: str) -> DataFrame:
    """Quartiles, median, 1.5 IQR whiskers (most extreme values inside the
    fences) and outlier count per group."""
    src = df.filter(F.col(col).isNotNull() & F.col(by).isNotNull())
    q = quantiles(src, col, [0.25, 0.5, 0.75], by=[by])
    qw = q.groupBy(by).pivot("p", [0.25, 0.5, 0.75]).agg(F.first("q")).toDF(by, "q1", "median", "q3")
    qw = (qw.withColumn("iqr", F.col("q3") - F.col("q1"))
            .withColumn("fence_lo", F.col("q1") - 1.5 * F.col("iqr"))
            .withColumn("fence_hi", F.col("q3") + 1.5 * F.col("iqr")))
    x = F.col(col)
    inside = (x >= F.col("fence_lo")) & (x <= F.col("fence_hi"))
    qw = measured(qw)
    agg = src.join(qw.select(by, "fence_lo", "fence_hi"), by).groupBy(by).agg(
        F.min(F.when(inside, x)).alias("whisker_lo"), F.max(F.when(inside, x)).alias("whisker_hi"),
        F.count_if(~inside).alias("outliers"), F.count(F.lit(1)).alias("n"))
    return qw.join(agg, by).drop("fence_lo", "fence_hi")


# A18
def density_by(df: DataFrame, key: str, col: str, bw: float, grid: int = 64,
               lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Gaussian kernel density per group on a shared grid of ``grid``
    points (default min - 3 bw .. max + 3 bw).

    Rows are first collapsed to ``(key, value, count)``; each distinct
    value then spreads over the grid by an ``explode`` of the grid indices
    (bounded by ``grid`` per distinct value, no join of two tables).
    """
    src = df.filter(F.col(col).isNotNull() & F.col(key).isNotNull())
    lo_c = F.lit(float(lo)) if lo is not None else src.agg(F.min(col).cast("double") - 3 * bw).scalar()
    hi_c = F.lit(float(hi)) if hi is not None else src.agg(F.max(col).cast("double") + 3 * bw).scalar()
    step = (hi_c - lo_c) / (grid - 1)
    vals = src.groupBy(key, F.col(col).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    sizes = src.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    spread = (vals.select(key, "v", "c", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("g"))
                  .withColumn("x", lo_c + F.col("g") * step)
                  .withColumn("w", F.col("c") * F.exp(-F.pow((F.col("x") - F.col("v")) / bw, 2) / 2)))
    dens = spread.groupBy(key, "g", "x").agg(F.sum("w").alias("__s"))
    return (dens.join(sizes, key)
                .withColumn("density", F.col("__s") / (F.col("__n") * bw * math.sqrt(2 * math.pi)))
                .drop("__s", "__n"))


# A19
def neighbourhood_profile(df: DataFrame, key: str = "neighbourhood", price: str = "price",
                          bedrooms: str = "bedrooms", max_bedrooms: int | None = None,
                          nested: bool = False) -> DataFrame:
    """Per group: mean price and counts per bedroom number 0..max (zeros
    filled). Long form ``(key, avgprice, bedrooms, total)`` or nested
    ``(name, avgprice, avgbedrooms: array<struct<bedrooms, total>>)``."""
    src = df.filter(F.col(key).isNotNull())
    top = F.lit(max_bedrooms) if max_bedrooms is not None else \
        src.agg(F.max(bedrooms).cast("int")).scalar()
    means = src.groupBy(key).agg(F.avg(price).alias("avgprice"))
    grid = means.select(key, "avgprice", F.explode(F.sequence(F.lit(0), top)).alias("b"))
    counts = (src.filter(F.col(bedrooms).isNotNull())
                 .groupBy(key, F.col(bedrooms).cast("int").alias("b"))
                 .agg(F.count(F.lit(1)).alias("total")))
    long = (grid.join(counts, [key, "b"], "left")
                .select(key, "avgprice", F.col("b").alias("bedrooms"),
                        F.coalesce("total", F.lit(0)).alias("total")))
    if not nested:
        return long
    return (long.groupBy(key, "avgprice")
                .agg(F.array_sort(F.collect_list(F.struct("bedrooms", "total"))).alias("avgbedrooms"))
                .withColumnRenamed(key, "name"))


# A20
def extent_scale(df: DataFrame, col: str, out: str = "position") -> DataFrame:
    """Linear position in [0, 1] between the column's min and max; null
    stays null, and one value alone stands in the middle."""
    lo = df.agg(F.min(col).cast("double")).scalar()
    hi = df.agg(F.max(col).cast("double")).scalar()
    return df.withColumn(out, F.when(F.col(col).isNotNull(), F.coalesce(
        F.try_divide(F.col(col) - lo, hi - lo), F.lit(0.5))))


# A22
def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """n, RMSE, MAE, R squared (1 - SSres/SStot) in one aggregate.

    Where y has no spread, R squared is 1 for a perfect prediction and 0 else.
    """
    r = F.col(y) - F.col(yhat)
    miss = F.sum(r * r)
    flat = F.when(F.count(F.lit(1)) > 0, F.when(miss == 0, 1.0).otherwise(0.0))
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.sqrt(F.avg(r * r)).alias("rmse"), F.avg(F.abs(r)).alias("mae"),
                  F.coalesce(1 - F.try_divide(miss, F.count(F.lit(1)) * F.var_pop(y)),
                             flat).alias("r2"))


# A23
def sse(a: DataFrame, b: DataFrame, keys: Sequence[str], val_a: str, val_b: str) -> DataFrame:
    """Sum of squared element differences of two matrices in long form
    ``(keys..., value)``, joined on their coordinates."""
    j = a.select(*keys, F.col(val_a).alias("__a")).join(
        b.select(*keys, F.col(val_b).alias("__b")), list(keys))
    return j.agg(F.sum(F.pow(F.col("__a") - F.col("__b"), 2)).alias("sse"))


def sse_arrays(df: DataFrame, a: str, b: str) -> DataFrame:
    """Same for row-wise array matrices."""
    from ..functions.scalar import sq_distance
    return df.agg(F.sum(sq_distance(a, b)).alias("sse"))


# A24
def confusion(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("count"))


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "prediction"
                           ) -> DataFrame:
    """Per class: support, tp, precision, recall, F1; plus overall accuracy."""
    cm = confusion(df, label, pred)
    tp = cm.filter(F.col("label") == F.col("prediction")).select(
        F.col("label").alias("cls"), F.col("count").alias("tp"))
    support = cm.groupBy(F.col("label").alias("cls")).agg(F.sum("count").alias("support"))
    predicted = cm.groupBy(F.col("prediction").alias("cls")).agg(F.sum("count").alias("predicted"))
    acc = df.agg(F.avg((F.col(label) == F.col(pred)).cast("double"))).scalar()
    out = (support.join(predicted, "cls", "full").join(tp, "cls", "left")
                  .fillna(0, ["tp", "support", "predicted"])
                  .withColumn("precision", F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0))
                  .withColumn("recall", F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0))
                  .withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                           2 * F.col("precision") * F.col("recall") /
                                           (F.col("precision") + F.col("recall"))).otherwise(0.0))
                  .withColumn("accuracy", acc))
    return out


# A26
def regression_line(df: DataFrame, x: str, weights: Sequence[float], n: int = 100,
                    pad: float = 500.0) -> DataFrame:
    """``n`` evenly spaced x from min - pad to max + pad and y = w0 + w1 x."""
    ext = df.agg(F.min(x).cast("double").alias("lo"), F.max(x).cast("double").alias("hi"))
    pts = ext.select(F.posexplode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i", "__g"), "lo", "hi")
    xx = (F.col("lo") - pad) + F.col("i") * ((F.col("hi") + pad) - (F.col("lo") - pad)) / (n - 1)
    return pts.select("i", xx.alias("x")).withColumn(
        "y", F.lit(float(weights[0])) + F.lit(float(weights[1])) * F.col("x"))
