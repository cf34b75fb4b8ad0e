"""Statistics from sufficient statistics.

Spark computes grouped counts, sums and products about the means in
one aggregate each; only d x d matrices or per-group scalars reach the
driver, where the small linear algebra and the distribution tails
(``functions.dist``) finish the job. Results come back as DataFrames.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dist
from ..session import measured, written
from .ranks import average_ranks, quantiles, value_ranks


# --------------------------------------------------------------------- T1
def normality_by_group(df: DataFrame, key: str, col: str) -> DataFrame:
    """Jarque-Bera per group over all rows (re-aimed Shapiro-Wilk):
    JB = n/6 (S^2 + K^2/4) with population skewness S and excess kurtosis
    K; p = exp(-JB/2) (chi-square, 2 df)."""
    g = (df.filter(F.col(col).isNotNull()).groupBy(key)
           .agg(F.count(F.lit(1)).alias("n"), F.skewness(col).alias("skewness"),
                F.kurtosis(col).alias("kurtosis")))
    jb = F.col("n") / 6.0 * (F.pow("skewness", 2) + F.pow("kurtosis", 2) / 4.0)
    return g.withColumn("jb", jb).withColumn("p_value", F.exp(-F.col("jb") / 2.0))


# --------------------------------------------------------------------- T2
def kruskal_statistic(df: DataFrame, key: str, col: str) -> DataFrame:
    """H with tie correction, computed in Spark: average ranks over the
    whole column (distributed ranks), rank sums per group through a join
    on the value, one final aggregate. -> one row (h, k, n); h is null where
    all values are tied or there is none (R gives NaN)."""
    src = df.filter(F.col(col).isNotNull() & F.col(key).isNotNull())
    ranks = average_ranks(value_ranks(src, col)).select(
        F.col("value").alias(col), "avg_rank", "cnt")
    per = src.groupBy(key, col).agg(F.count(F.lit(1)).alias("c"))
    sums = (per.join(ranks, col).groupBy(key)
               .agg(F.sum(F.col("c") * F.col("avg_rank")).alias("r"), F.sum("c").alias("ng")))
    ties = ranks.agg(F.sum(F.pow("cnt", 3) - F.col("cnt"))).scalar()
    total = sums.agg(F.sum(F.pow("r", 2) / F.col("ng")).alias("s"), F.count(F.lit(1)).alias("k"),
                     F.sum("ng").alias("n"))
    n = F.col("n")
    h_raw = F.try_divide(F.col("s") * 12.0, n * (n + 1)) - 3 * (n + 1)
    tied = F.try_divide(ties, F.pow(n, 3) - n)
    return total.select(F.try_divide(h_raw, 1 - tied).alias("h"), "k", "n")


def kruskal_wallis(df: DataFrame, key: str, col: str) -> DataFrame:
    """H, its degrees of freedom and p-value; nulls where H is not defined."""
    h, k, _ = kruskal_statistic(df, key, col).first()
    p = None if h is None or k < 2 else float(dist.chi2_sf(h, k - 1))
    return df.sparkSession.createDataFrame(
        [(h, max(0, k - 1), p)], "h double, df int, p_value double")


# --------------------------------------------------------------------- T3
def group_moments(df: DataFrame, key: str, col: str) -> DataFrame:
    return (df.filter(F.col(col).isNotNull() & F.col(key).isNotNull()).groupBy(key)
              .agg(F.count(F.lit(1)).alias("n"), F.avg(col).alias("mean"),
                   F.var_samp(col).alias("var")))


def anova_statistic(df: DataFrame, key: str, col: str) -> DataFrame:
    """One-way ANOVA F in Spark -> one row (f, df_between, df_within); f is null for
    fewer than two groups, and where no group has spread."""
    g = group_moments(df, key, col)
    grand = df.filter(F.col(col).isNotNull() & F.col(key).isNotNull()).agg(F.avg(col)).scalar()
    ssb = F.sum(F.col("n") * F.pow(F.col("mean") - grand, 2))
    ssw = F.sum(F.coalesce(F.col("var"), F.lit(0.0)) * (F.col("n") - 1))
    k = F.count(F.lit(1))
    n = F.sum("n")
    f = F.try_divide(F.try_divide(ssb, k - 1), F.try_divide(ssw, n - k))
    return g.agg(f.alias("f"), F.greatest(k - 1, F.lit(0)).alias("df_between"),
                 F.coalesce(n - k, F.lit(0)).alias("df_within"), ssw.alias("ssw"))


def anova_oneway(df: DataFrame, key: str, col: str) -> DataFrame:
    f, between, within, _ = anova_statistic(df, key, col).first()
    p = None if f is None else float(dist.f_sf(f, between, within))
    return df.sparkSession.createDataFrame(
        [(f, between, within, p)], "f double, df_between long, df_within long, p_value double")


# --------------------------------------------------------------------- T4
#: Groups in a block of ``tukey_pairs``, about.
TUKEY_BLOCK = 256


def tukey_pairs(df: DataFrame, key: str, col: str) -> DataFrame:
    """Tukey-Kramer: for each pair of groups the mean difference, the q
    statistic and the adjusted p-value (to about 1e-12).

    The result has a row per pair of groups by definition. Groups are dealt to
    blocks of about TUKEY_BLOCK, every pair of blocks is one key, and the pairs
    of groups come from an equi-join on it; p-values are computed in Arrow
    batches of pairs. q and p are null where no group has spread.
    """
    g = written(group_moments(df, key, col).select(
        F.col(key).cast("string").alias("g"), "n", "mean",
        F.coalesce("var", F.lit(0.0)).alias("var")), "tukey-groups")
    total = g.agg(F.struct(
        F.count(F.lit(1)).alias("k"), (F.sum("n") - F.count(F.lit(1))).alias("dfw"),
        F.sum(F.col("var") * (F.col("n") - 1)).alias("ssw"))).scalar()
    blocks = max(1, -(-g.count() // TUKEY_BLOCK))
    dealt = g.withColumn("b", F.pmod(F.xxhash64("g"), F.lit(blocks))).select("g", "n", "mean", F.explode(
        F.transform(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")), lambda o: F.struct(
            F.least(F.col("b"), o).alias("lo"), F.greatest(F.col("b"), o).alias("hi"),
            (F.col("b") <= o).alias("left"), (F.col("b") >= o).alias("right")))).alias("s")).select(
        "g", "n", "mean", "s.*")
    # a pair of blocks meets from both sides; inside one block every group is on both
    one, other = dealt.where("left").alias("l"), dealt.where("right").alias("r")
    met = one.join(other, (F.col("l.lo") == F.col("r.lo")) & (F.col("l.hi") == F.col("r.hi"))
                   & ((F.col("l.lo") != F.col("l.hi")) | (F.col("l.g") < F.col("r.g"))))
    first = F.col("l.g") < F.col("r.g")

    def side(c, smaller):
        return F.when(first == smaller, F.col(f"l.{c}")).otherwise(F.col(f"r.{c}"))

    mse = F.try_divide(total["ssw"], total["dfw"])
    diff = side("mean", False) - side("mean", True)
    q = F.try_divide(F.abs(diff), F.sqrt(mse / 2 * (1 / F.col("l.n") + 1 / F.col("r.n"))))
    pairs = met.select(side("g", True).alias("group_a"), side("g", False).alias("group_b"),
                       diff.alias("diff"), q.alias("q"), total["k"].alias("k"),
                       total["dfw"].alias("dfw"))

    @F.pandas_udf("double")
    def p_adjusted(q: pd.Series, k: pd.Series, dfw: pd.Series) -> pd.Series:
        return pd.Series([None if math.isnan(x[0]) else max(0.0, 1.0 - dist.ptukey(*x))
                          for x in zip(q.astype(float), k, dfw)], dtype=float)

    return pairs.select("group_a", "group_b", "diff", "q", F.when(
        F.col("q").isNotNull(), p_adjusted("q", "k", "dfw")).alias("p_adj"))


# --------------------------------------------------------------------- T5
def cluster_groups(df: DataFrame, key: str, features: Sequence[str], k: int = 3,
                   seed: int = 1) -> tuple[DataFrame, DataFrame, float]:
    """Re-aimed complete-linkage grouping: one feature row per group (means),
    standardised, clustered by k-means; silhouette of the grouping; the
    cluster label joined back to every row."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    prof = df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.avg(c).alias(c) for c in features]).na.drop()
    va = VectorAssembler(inputCols=list(features), outputCol="__raw").transform(prof)
    sc = StandardScaler(inputCol="__raw", outputCol="features", withMean=True, withStd=True)
    scaled = sc.fit(va).transform(va)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(scaled)
    labelled = model.transform(scaled)
    sil = ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(labelled)
    labels = measured(labelled.select(key, "cluster"))
    return labels, df.join(labels, key, "left"), float(sil)


# ------------------------------------------------------- products about the means
def centred(df: DataFrame, xs: Sequence[str], y: str, intercept: bool = True):
    """Sums of products about the means, over complete rows.

    One aggregate for the means, a second one for the products of centred
    columns: sums of large raw squares would swallow the spread. Without an
    intercept nothing is centred. -> (S, b, yy, n, means of x, mean of y).
    """
    xs = list(xs)
    src = df.select(*xs, y).na.drop().select(*[
        F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate([*xs, y])])
    d = len(xs)
    cols = [F.col(f"x{i}") for i in range(d + 1)]
    if intercept:
        mean = src.agg(F.struct(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)])).scalar()
        cols = [c - mean[f"m{i}"] for i, c in enumerate(cols)]
    else:
        mean = F.struct(*[F.lit(0.0).alias(f"m{i}") for i in range(d + 1)])
    r = src.agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(cols[i] * cols[j]).alias(f"s{i}_{j}") for i in range(d + 1) for j in range(i, d + 1)],
        *[F.first(mean[f"m{i}"]).alias(f"m{i}") for i in range(d + 1)]).first().asDict()
    full = np.zeros((d + 1, d + 1))
    for i in range(d + 1):
        for j in range(i, d + 1):
            full[i, j] = full[j, i] = r[f"s{i}_{j}"] or 0.0
    means = np.array([r[f"m{i}"] or 0.0 for i in range(d + 1)])
    return full[:d, :d], full[:d, d], float(full[d, d]), int(r["n"]), means[:d], float(means[d])


#: A column whose spread the columns before it explain up to this share is collinear.
COLLINEAR = 1e-10


def independent(S: np.ndarray) -> list[int]:
    """Columns that are no combination of earlier ones (R drops the others too)."""
    kept: list[int] = []
    for j in range(len(S)):
        rest = S[j, j]
        if kept and rest > 0:
            rest -= S[j, kept] @ np.linalg.solve(S[np.ix_(kept, kept)], S[kept, j])
        if rest > COLLINEAR * S[j, j]:
            kept.append(j)
    return kept


def solved(S, b, yy, kept):
    """Slopes of the kept columns and the residual sum of squares."""
    beta = np.linalg.solve(S[np.ix_(kept, kept)], b[kept]) if kept else np.zeros(0)
    return beta, max(0.0, float(yy - beta @ b[kept]))


# --------------------------------------------------------------------- T6, T10
def ols(df: DataFrame, y: str, xs: Sequence[str], level: float = 0.95,
        intercept: bool = True) -> tuple[DataFrame, DataFrame]:
    """Linear model summary (R ``lm`` + ``confint``): coefficient table
    (estimate, std error, t, p, interval) and model table (n, p, RSS,
    sigma, R squared, adjusted R squared, AIC). Rows with nulls are
    dropped, and terms collinear with earlier ones get nulls, as in R;
    without an intercept R squared is about zero. Without a complete row
    every estimate is null."""
    S, b, yy, n, x_mean, y_mean = centred(df, xs, y, intercept)
    kept = independent(S)
    beta, rss = solved(S, b, yy, kept)
    k = len(kept) + (1 if intercept and n else 0)
    dof = n - k
    sigma2 = rss / dof if dof > 0 else math.nan
    inverse = np.linalg.inv(S[np.ix_(kept, kept)]) if kept else np.zeros((0, 0))
    found = {j: (float(e), math.sqrt(sigma2 * v) if sigma2 >= 0 else math.nan)
             for j, e, v in zip(kept, beta, np.diag(inverse))}
    estimates = [(x, *found.get(j, (None, None))) for j, x in enumerate(xs)]
    if intercept and not n:
        estimates.insert(0, ("(Intercept)", None, None))
    elif intercept:
        at = x_mean[kept]
        spread = sigma2 * (1 / n + at @ inverse @ at) if n else math.nan
        estimates.insert(0, ("(Intercept)", float(y_mean - beta @ at),
                             math.sqrt(spread) if spread >= 0 else math.nan))
    tq = dist.t_ppf(0.5 + level / 2, dof) if dof > 0 else math.nan
    rows = []
    for name, est, se in estimates:
        if est is None:  # collinear with the terms before it
            rows.append((name, None, None, None, None, None, None))
            continue
        t = est / se if se > 0 else math.nan
        p = dist.t_sf2(t, dof) if se > 0 else math.nan
        rows.append((name, est, se, t, p, est - tq * se, est + tq * se))
    spark = df.sparkSession
    coef = spark.createDataFrame(rows, "term string, estimate double, std_error double, "
                                       "t_value double, p_value double, lo double, hi double")
    r2 = 1 - rss / yy if yy > 0 else math.nan
    adj = 1 - (1 - r2) * (n - (1 if intercept else 0)) / dof if dof > 0 else math.nan
    model = spark.createDataFrame(
        [(n, k, rss, math.sqrt(sigma2) if dof > 0 else None, float(r2), float(adj),
          _aic(rss, n, k))],
        "n long, p int, rss double, sigma double, r2 double, adj_r2 double, aic double")
    return coef, model


def _aic(rss: float, n: int, k: int) -> float:
    """n ln(RSS / n) + 2 k; minus infinity for a perfect fit."""
    return math.nan if not n else n * math.log(rss / n) + 2 * k if rss > 0 else -math.inf


def conf_int(coef: DataFrame) -> DataFrame:
    """The interval columns of the coefficient table."""
    return coef.select("term", "lo", "hi")


def predict_expr(coef_rows: Sequence[tuple[str, float]],
                 override: dict[str, Column] | None = None) -> Column:
    """Prediction as a column expression from (term, estimate) pairs;
    ``override`` replaces input columns (for what-if scoring)."""
    override = override or {}
    expr = F.lit(0.0)
    for term, est in coef_rows:
        if est is None:  # a collinear term
            continue
        x = override.get(term, F.col(term))
        expr = expr + (F.lit(est) if term == "(Intercept)" else x * F.lit(est))
    return expr


# --------------------------------------------------------------------- T7
def least_squares_weights(df: DataFrame, xs: Sequence[str], y: str) -> DataFrame:
    """Least-squares weights with a column of ones, from sums about the
    means; a collinear column weighs null, as all do without a row."""
    S, b, yy, n, x_mean, y_mean = centred(df, xs, y)
    kept = independent(S)
    beta, _ = solved(S, b, yy, kept)
    slope = dict(zip(kept, map(float, beta)))
    rows = [("(Intercept)", float(y_mean - beta @ x_mean[kept]) if n else None)]
    rows += [(x, slope.get(j)) for j, x in enumerate(xs)]
    return df.sparkSession.createDataFrame(rows, "term string, weight double")


# --------------------------------------------------------------------- T8
def gradient_steps(S, b, yy, n, x_mean, y_mean, w0, n_iter, eta, normalize=True):
    """Batch gradient descent on the squared loss, from sums about the means.

    With slopes v and intercept a, the residuals are (y - ybar) - (x - xbar) v + c with
    c = ybar - a - xbar v. The centred parts sum to zero, so the loss (before each
    step) is v'Sv - 2 v'b + yy + n c^2: sums of squares, with no large terms that
    cancel.
    """
    w = np.asarray(w0, dtype=float)
    ws, losses = [w.copy()], []
    scale = eta / max(n, 1) if normalize else eta
    for _ in range(n_iter):
        v = w[1:]
        c = y_mean - w[0] - x_mean @ v
        losses.append(float(max(0.0, v @ S @ v - 2 * v @ b + yy) + n * c * c))
        slope = S @ v - b - n * c * x_mean
        w = w - scale * np.concatenate([[-n * c], slope])
        ws.append(w.copy())
    return ws, losses


def gradient_descent(df: DataFrame, xs: Sequence[str], y: str, w0: Sequence[float],
                     n_iter: int, eta: float, normalize: bool = True,
                     standardize: bool = True) -> DataFrame:
    """One Spark aggregate (sums about the means), then the iterations on
    the d x d system; ``standardize`` z-scores x with the sample sd first
    (as the reference does; a column without spread is only centred).
    -> (step, loss, weights); without a complete row only the start weights."""
    S, b, yy, n, x_mean, y_mean = centred(df, xs, y)
    if standardize and n > 1:
        sd = np.sqrt(np.diag(S) / (n - 1))
        sd = np.where(sd > 0, sd, 1.0)
        S, b, x_mean = S / np.outer(sd, sd), b / sd, np.zeros(len(sd))
    ws, losses = gradient_steps(S, b, yy, n, x_mean, y_mean, w0, n_iter if n else 0, eta, normalize)
    rows = [(i, losses[i] if i < len(losses) else None, [float(v) for v in ws[i]])
            for i in range(len(ws))]
    return df.sparkSession.createDataFrame(rows, "step int, loss double, weights array<double>")


# --------------------------------------------------------------------- T9
def step_aic(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """Backward selection by AIC = n ln(RSS/n) + 2p, every candidate model
    solved from sub-blocks of one matrix of centred products; collinear
    terms are left out from the start."""
    S, b, yy, n, _, _ = centred(df, xs, y)

    def aic(terms):
        return _aic(solved(S, b, yy, terms)[1], n, len(terms) + 1)

    def named(terms):
        return ",".join(xs[j] for j in terms)

    keep = independent(S)
    steps = [(0, "<none>", aic(keep), named(keep))]
    while keep:
        best, gone = min((aic([k for k in keep if k != j]), j) for j in keep)
        if best >= steps[-1][2]:
            break
        keep.remove(gone)
        steps.append((len(steps), xs[gone], best, named(keep)))
    return df.sparkSession.createDataFrame(steps, "step int, dropped string, aic double, terms string")


# --------------------------------------------------------------------- T11
def qq_points(df: DataFrame, col: str, grid: int = 99) -> DataFrame:
    """Sample quantiles at p = (i - 0.5)/grid against normal quantiles, and
    the line through the quartiles (R ``qqline``). Without a value there are
    no points."""
    probs = [(i - 0.5) / grid for i in range(1, grid + 1)]
    q = quantiles(df, col, probs + [0.25, 0.75])
    z = {p: dist.norm_ppf(p) for p in probs + [0.25, 0.75]}
    zt = df.sparkSession.createDataFrame(
        [(float(p), float(v)) for p, v in z.items()], "p double, theoretical double")
    pts = written(q.join(F.broadcast(zt), "p"), "qq-points")
    q1, q3 = (pts.agg(F.max(F.when(F.col("p") == p, F.col("q")))).scalar() for p in (0.25, 0.75))
    slope = (q3 - q1) / (z[0.75] - z[0.25])
    return pts.where(F.col("p").isin(probs)).select("p", "theoretical", F.col("q").alias("sample")) \
        .withColumn("line", q1 + slope * (F.col("theoretical") - z[0.25]))


# --------------------------------------------------------------------- T12, T13
def predict_and_fill(df: DataFrame, col: str, coef_rows: Sequence[tuple[str, float]],
                     out: str | None = None) -> DataFrame:
    """Null values of ``col`` replaced by the model's prediction; rows
    whose inputs are null stay null (no row loop)."""
    return df.withColumn(out or col, F.coalesce(F.col(col), predict_expr(coef_rows)))


def what_if(df: DataFrame, coef_rows: Sequence[tuple[str, float]], col: str, step: float
            ) -> DataFrame:
    """Prediction for every row and with ``col + step``, and the difference
    (one projection, both scores from the same row)."""
    moved = predict_expr(coef_rows, {col: F.col(col) + F.lit(step)})
    return (df.withColumn("prediction", predict_expr(coef_rows))
              .withColumn("prediction_moved", moved)
              .withColumn("difference", F.col("prediction_moved") - F.col("prediction")))
