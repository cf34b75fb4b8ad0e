"""Relational core: projections (P), filters (F), joins (J), ranking and
sampling (K), set operations (U).

Null semantics follow the pandas rules of the reference where they decide
row counts (see the docstrings): comparisons drop nulls like SQL ``WHERE``,
"delete rows equal to v" keeps nulls.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import measured, written

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


# --------------------------------------------------------------------- P1-P10
def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def drop_columns(df: DataFrame, groups: Mapping[str, Sequence[str]] | Sequence[str]) -> DataFrame:
    """Drop named groups of columns (e.g. urls, free text, leakage)."""
    cols = ([c for g in groups.values() for c in g] if isinstance(groups, Mapping)
            else list(groups))
    return df.drop(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str] | None = None,
           names: Sequence[str] | None = None) -> DataFrame:
    """Rename some columns by mapping, or all positionally by ``names``."""
    if names is not None:
        return df.toDF(*names)
    return df.withColumnsRenamed(dict(mapping or {}))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


SQFT_TO_M2 = 0.092903  # fixed value: square metres per square foot


def derive(df: DataFrame, sqft: str = "square_feet", bedrooms: str = "bedrooms",
           bathrooms: str = "bathrooms") -> DataFrame:
    """Area in m2 and the bedrooms x bathrooms product."""
    return (df.withColumn("square_meters", F.col(sqft) * F.lit(SQFT_TO_M2))
              .withColumn("bed_bath", F.col(bedrooms) * F.col(bathrooms)))


def scale_by_max(df: DataFrame, col: str, fitted_on: DataFrame | None = None,
                 constant: float | None = None, out: str | None = None) -> DataFrame:
    """Divide by the maximum of the *training* frame, or by a constant.

    The maximum is a scalar subquery (one aggregate job, one value), so no
    row reaches the driver and no join is needed. A maximum of 0 gives nulls.
    """
    out = out or col
    if constant is not None:
        return df.withColumn(out, F.col(col) / F.lit(float(constant)))
    src = df if fitted_on is None else fitted_on
    mx = src.agg(F.max(col)).scalar()
    return df.withColumn(out, F.try_divide(F.col(col).cast("double"), mx))


def align_columns(test: DataFrame, train_cols: Sequence[str]) -> DataFrame:
    """Missing columns as 0, train order, extras dropped."""
    have = set(test.columns)
    return test.select(*[F.col(c) if c in have else F.lit(0).alias(c) for c in train_cols])


def split_xy(df: DataFrame, label: str, features: Sequence[str] | None = None,
             out: str = "features") -> DataFrame:
    """Label column + assembled feature vector."""
    from pyspark.ml.feature import VectorAssembler
    feats = list(features) if features else [c for c in numeric_columns(df) if c != label]
    va = VectorAssembler(inputCols=feats, outputCol=out, handleInvalid="keep")
    return va.transform(df).select(F.col(label).alias("label"), out)


def schema_report(df: DataFrame) -> DataFrame:
    """P10: one row per column: position, name, type, rows, non-null count.

    One aggregate computes every count; the unpivot turns the single wide
    row into one row per column.
    """
    fields = df.schema.fields
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    stacked = F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("type"),
                 F.col(f"c{i}").alias("non_null")) for i, f in enumerate(fields)]))
    return counts.select(F.col("__rows").alias("rows"), stacked)


# ---------------------------------------------------------------------- F1-F12
def keep_equal(df: DataFrame, conds: Mapping[str, object]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in conds.items()]))


def keep_below(df: DataFrame, col: str, limit, inclusive: bool = False) -> DataFrame:
    """pandas ``df[df[c] < v]``: nulls drop (comparison with NaN is false)."""
    return df.filter(F.col(col) <= limit if inclusive else F.col(col) < limit)


def keep_above(df: DataFrame, col: str, limit, inclusive: bool = False) -> DataFrame:
    return df.filter(F.col(col) >= limit if inclusive else F.col(col) > limit)


def column_cutoff(df: DataFrame, limits: Iterable[tuple[str, float, float]]) -> DataFrame:
    """all two-sided limits must hold, limits included."""
    return df.filter(reduce(lambda a, b: a & b,
                            [F.col(c).between(lo, hi) for c, lo, hi in limits]))


def drop_value_keep_null(df: DataFrame, col: str, value) -> DataFrame:
    """delete rows equal to ``value``; nulls stay (``x IS NULL OR x <> v``)."""
    return df.filter(F.col(col).isNull() | (F.col(col) != F.lit(value)))


def drop_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def complete_cases(df: DataFrame) -> DataFrame:
    return df.dropna(how="any")


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """remove rows whose value is ''. Null rows go too, as with R's
    ``filter(x != '')``; ``drop_value_keep_null(df, col, '')`` keeps them
    (pandas' ``df[df.x != '']``)."""
    return df.filter(F.col(col) != F.lit(""))


def null_if(df: DataFrame, col: str, pred: Column) -> DataFrame:
    """set ``col`` to null where ``pred`` holds."""
    return df.withColumn(col, F.when(~pred | pred.isNull(), F.col(col)))


def drop_rare(df: DataFrame, col: str, min_count: int) -> DataFrame:
    """F8: delete rows whose category has fewer than ``min_count`` rows.

    Counts come from a partial+final aggregate (a hot category costs one
    row per map task), then a left-semi join with the counted table of
    frequent categories keeps their rows.
    Null categories are kept out, as pandas ``value_counts`` does.
    """
    keep = (df.groupBy(col).count().filter(F.col("count") >= min_count)
              .select(col).filter(F.col(col).isNotNull()))
    return df.join(measured(keep), col, "left_semi")


def null_fractions(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per column: null count and fraction (one aggregate pass)."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"),
                 F.try_divide(f"n{i}", "__n").alias("fraction"))
        for i, c in enumerate(cols)])))


def null_report_drop(df: DataFrame, pct: float = 25.0) -> DataFrame:
    """drop columns whose null percent, rounded to 2 decimals first,
    is at least ``pct``. Only one scalar per column reaches the driver. An
    empty table has no null percent and keeps its columns."""
    rep = null_fractions(df).select("column", F.round(F.col("fraction") * 100, 2).alias("p"))
    drop = [r["column"] for r in rep.filter(F.col("p") >= pct).collect()]
    return df.drop(*drop)


def top_value_ratios(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: share of rows taken by its most frequent value (null
    counts as a value) and number of distinct values.

    All columns are unpivoted to ``(column, value)`` as text, counted in one
    aggregate, then reduced per column: two shuffles whatever the width.
    """
    cols = list(cols or df.columns)
    n = df.agg(F.count(F.lit(1))).scalar()
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in cols])))
    per_value = long.groupBy("column", "value").count()
    return (per_value.groupBy("column")
                     .agg(F.max("count").alias("top_count"), F.count(F.lit(1)).alias("n_distinct"))
                     .withColumn("top_ratio", F.col("top_count") / n))


def drop_constant(df: DataFrame, min_ratio: float = 0.995) -> DataFrame:
    """drop columns with one distinct value or whose top value covers
    at least ``min_ratio`` of the rows."""
    r = top_value_ratios(df)
    drop = [x["column"] for x in r.filter((F.col("n_distinct") <= 1) |
                                          (F.col("top_ratio") >= min_ratio)).collect()]
    return df.drop(*drop)


def pearson(a: str, b: str) -> Column:
    """Pearson correlation over the rows with both values; null where a column has no
    spread in them."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def drop_correlated(df: DataFrame, groups: Sequence[Sequence[str]], target: str) -> DataFrame:
    """in each group of correlated columns keep the one with the highest
    absolute Pearson correlation with ``target``. One aggregate computes all
    the correlations; only those scalars reach the driver. A column without
    spread has no correlation and loses to any other."""
    cols = sorted({c for g in groups for c in g})
    row = df.agg(*[pearson(c, target).alias(c) for c in cols]).first().asDict()
    drop = []
    for g in groups:
        best = max(g, key=lambda c: abs(row[c]) if row[c] is not None else -1.0)
        drop += [c for c in g if c != best]
    return df.drop(*drop)


def keep_available(df: DataFrame, mask: DataFrame, key: str) -> DataFrame:
    """rows whose companion record exists (left-semi join)."""
    return df.join(mask.select(key), key, "left_semi")


# ------------------------------------------------------------------------ J2-J8
def merge_on(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner join; ``right`` is the side of groups, which is written and counted."""
    return left.join(measured(right), on=key, how="inner")


def drop_all_null_groups(df: DataFrame, key: str, col: str) -> DataFrame:
    """Remove groups whose ``col`` is null in every row."""
    empty = df.groupBy(key).agg(F.count(col).alias("__nn")).filter("__nn = 0").select(key)
    return df.join(measured(empty), key, "left_anti")


def lookup(df: DataFrame, map_df: DataFrame, key: str, value: str,
           default: Column | object | None = None, out: str | None = None) -> DataFrame:
    """Dictionary map via left join; unseen keys get ``default``."""
    out = out or value
    known = measured(map_df.select(key, F.col(value).alias("__v")))
    joined = df.join(known, key, "left")
    fill = default if isinstance(default, Column) else F.lit(default)
    return joined.withColumn(out, F.coalesce(F.col("__v"), fill)).drop("__v")


def weighted_total(keys: DataFrame, cost: DataFrame, qty: DataFrame, key: str = "item",
                   cost_col: str = "cost", qty_col: str = "qty") -> tuple[DataFrame, DataFrame]:
    """Total of cost x quantity over keys present in both tables, and
    the keys missing from either (returned as a second frame)."""
    both = keys.select(key).join(cost, key).join(qty, key)
    total = both.agg(F.sum(F.col(cost_col) * F.col(qty_col)).alias("total"))
    found = cost.select(key).join(qty.select(key), key)
    missing = keys.select(key).join(found, key, "left_anti")
    return total, missing


def take_by_row_id(df: DataFrame, ids: DataFrame, key: str = "row_id") -> DataFrame:
    """Companion rows by explicit row id (equi-join)."""
    return df.join(ids.select(key), key)


def query_against_all(df: DataFrame, vec_col: str, query: Sequence[float],
                      out: str = "sq_dist") -> DataFrame:
    """One literal query vector against every row (no join)."""
    from ..functions.scalar import sq_distance
    q = F.array(*[F.lit(float(x)) for x in query])
    return df.withColumn(out, sq_distance(vec_col, q))


# ------------------------------------------------------------------------ K1-K9
def _order(cols: Sequence[str | Column], asc: bool | Sequence[bool]) -> list[Column]:
    ascs = [asc] * len(cols) if isinstance(asc, bool) else list(asc)
    out = []
    for c, a in zip(cols, ascs):
        cc = F.col(c) if isinstance(c, str) else c
        out.append(cc.asc_nulls_last() if a else cc.desc_nulls_last())
    return out


def top_k(df: DataFrame, cols: Sequence[str | Column], k: int,
          asc: bool | Sequence[bool] = False) -> DataFrame:
    """K1: order and head (TakeOrderedAndProject: each task keeps k rows).
    Pass a unique tie-breaker as the last column for a stable answer."""
    return df.orderBy(*_order(cols, asc)).limit(k)


def top_k_groups(df: DataFrame, key: str, k: int, largest: bool = True) -> DataFrame:
    """K2: groups with most (or fewest) rows; ties broken by key."""
    counts = df.groupBy(key).count()
    return top_k(counts, ["count", key], k, asc=[not largest, True])


def top_k_where(profile: DataFrame, count_col: str, min_count: int, order_col: str,
                k: int, asc: bool = False, tie: str | None = None) -> DataFrame:
    """K3: filter on a count, then K1."""
    cols = [order_col] + ([tie] if tie else [])
    return top_k(profile.filter(F.col(count_col) > min_count), cols, k, asc=[asc, True][:len(cols)])


def cap_per_group(df: DataFrame, key: str, n: int, order: Sequence[str]) -> DataFrame:
    """K4: first ``n`` rows of each group by ``order``.

    ``row_number() <= n`` lets Spark insert a partial group limit before the
    shuffle (WindowGroupLimit), so a hot group ships at most n rows per map
    task instead of all of its rows.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def k_nearest(df: DataFrame, vec_col: str, query: Sequence[float], k: int,
              id_col: str) -> DataFrame:
    """K5: the k rows closest to a query vector (squared distance, ties by id)."""
    return top_k(query_against_all(df, vec_col, query), ["sq_dist", id_col], k, asc=True)


def sort_values(df: DataFrame, cols: Sequence[str], asc: bool = True) -> DataFrame:
    return df.orderBy(*_order(cols, asc))


def _bucket(key_cols: Sequence[str], seed: int, buckets: int = 1_000_000) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols]), F.lit(buckets))


def train_test_split(df: DataFrame, test_frac: float, seed: int, key: str | Sequence[str]
                     ) -> tuple[DataFrame, DataFrame]:
    """K7: repeatable hash split on a row key: disjoint and complete, stable
    under re-execution and executor loss (no random state)."""
    keys = [key] if isinstance(key, str) else list(key)
    b = _bucket(keys, seed)
    cut = int(round(test_frac * 1_000_000))
    return df.filter(b >= cut), df.filter(b < cut)


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """K8: exactly n rows without replacement (top-n by a keyed hash; the
    row key breaks hash ties)."""
    return (df.withColumn("__h", F.xxhash64(F.lit(seed), F.col(key)))
              .orderBy("__h", key).limit(n).drop("__h"))


def balance_classes(df: DataFrame, label: str, n: int, seed: int, key: str,
                    replace: bool = False) -> DataFrame:
    """K9: n rows per class; rows without a class are left out, ``key`` names a row.

    Without replacement: the n smallest keyed hashes per class (a partial
    group limit before the shuffle keeps hot classes cheap). With
    replacement: ``draw_keys`` gives the keys, and only these are joined back.
    """
    if not replace:
        w = Window.partitionBy(label).orderBy("__h", key)
        return (df.filter(F.col(label).isNotNull())
                  .withColumn("__h", F.xxhash64(F.lit(seed), F.col(key)))
                  .withColumn("__rn", F.row_number().over(w))
                  .filter(F.col("__rn") <= n).drop("__h", "__rn"))
    drawn = draw_keys(df.select(label, key), label, n, seed, key)
    return df.join(measured(drawn), [label, key])


#: Keys in a hash bucket of ``draw_keys``, about.
DRAW_BUCKET = 10_000


def draw_keys(keys: DataFrame, label: str, n: int, seed: int, key: str) -> DataFrame:
    """Exactly n uniform draws with replacement per class: ``label``, ``key``, ``draw``.

    Keys lie in hash buckets. A draw is a whole number below the class size: the
    buckets' running counts turn it into a bucket (which splits the n draws over the
    buckets as a multinomial does) and a rank in it, by hash. Only keys move, a class
    is never in one task, and the result does not depend on the partitions.
    """
    keys = keys.where(F.col(label).isNotNull())
    buckets = max(1, keys.count() // DRAW_BUCKET)
    h = F.xxhash64(F.lit(seed), F.col(key))
    dealt = keys.select(label, key, h.alias("__h"), F.pmod(h, F.lit(buckets)).alias("__b"))
    counts = written(dealt.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__c")), "draw-buckets")
    # as many rows as buckets, in a class
    before = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(label, "__b", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias(
        "__at"))
    sizes = counts.groupBy(label).agg(F.sum("__c").alias("__size"))
    draws = sizes.select(label, "__size", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(
        "draw")).select(label, "draw", F.pmod(F.xxhash64(
            F.lit(seed), F.col(label), F.col("draw")), F.col("__size")).alias("__at"))
    # the last bucket that starts at or before a draw's number holds it
    mixed = starts.withColumn("draw", F.lit(None).cast("int")).unionByName(
        draws, allowMissingColumns=True)
    upto = Window.partitionBy(label).orderBy("__at", F.col("draw").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, 0)
    placed = mixed.withColumns({
        "__bucket": F.last("__b", ignorenulls=True).over(upto),
        "__from": F.last(F.when(F.col("draw").isNull(), F.col("__at")), ignorenulls=True).over(
            upto)}).where(F.col("draw").isNotNull()).select(
        label, "draw", F.col("__bucket").alias("__b"), (F.col("__at") - F.col("__from") + 1).alias(
            "__rank"))
    ranked = dealt.withColumn("__rank", F.row_number().over(
        Window.partitionBy(label, "__b").orderBy("__h", key)))
    return ranked.join(placed, [label, "__b", "__rank"]).select(label, key, "draw")


# ------------------------------------------------------------------------ U1-U3
def append_all(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def complement(df: DataFrame, part: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``part``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(part.select(*keys), keys, "left_anti")


def token_union(a: str | Column, b: str | Column) -> Column:
    return F.array_union(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


def token_intersection(a: str | Column, b: str | Column) -> Column:
    return F.array_intersect(F.col(a) if isinstance(a, str) else a,
                             F.col(b) if isinstance(b, str) else b)
