"""Queries of the statistics operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import views
from ..operators import stats as st
from .registry import register

L = views.listings


def r6(*cols):
    return [F.round(c, 6).alias(c) for c in cols]


@register("T1_normality_by_group", sql="""
    WITH m AS (SELECT room_type, count(*) AS n, avg(price) AS mu FROM listings
               WHERE price IS NOT NULL GROUP BY 1),
    c AS (SELECT l.room_type, n, avg(pow(price - mu, 2)) AS m2, avg(pow(price - mu, 3)) AS m3,
                 avg(pow(price - mu, 4)) AS m4
          FROM listings l JOIN m ON l.room_type = m.room_type WHERE price IS NOT NULL
          GROUP BY l.room_type, n),
    s AS (SELECT room_type, n, m3 / pow(m2, 1.5) AS skewness, m4 / (m2 * m2) - 3 AS kurtosis FROM c)
    SELECT room_type, n, round(skewness, 6) AS skewness, round(kurtosis, 6) AS kurtosis,
           round(n / 6.0 * (skewness * skewness + kurtosis * kurtosis / 4), 6) AS jb,
           round(exp(-(n / 6.0 * (skewness * skewness + kurtosis * kurtosis / 4)) / 2), 6) AS p_value
    FROM s""")
def q_t1(spark, d):
    r = st.normality_by_group(L(spark, d), "room_type", "price")
    return r.select("room_type", "n", *r6("skewness", "kurtosis", "jb", "p_value"))


@register("T2_kruskal_statistic", sql="""
    WITH t AS (SELECT neighbourhood AS g, price AS x FROM listings
               WHERE price IS NOT NULL AND neighbourhood IS NOT NULL),
    v AS (SELECT x, count(*) AS c FROM t GROUP BY x),
    r AS (SELECT x, c, coalesce(sum(c) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 + (c + 1) / 2.0 AS avg_rank FROM v),
    n AS (SELECT count(*) AS n FROM t),
    sums AS (SELECT g, sum(avg_rank) AS rs, count(*) AS ng FROM t JOIN r ON t.x = r.x GROUP BY g),
    ties AS (SELECT sum(c * c * c - c) AS tt FROM v)
    SELECT round((12.0 / (n * (n + 1)) * sum(rs * rs / ng) - 3 * (n + 1)) / (1 - tt / (pow(n, 3) - n)), 6) AS h,
           count(*) AS k, CAST(sum(ng) AS BIGINT) AS n
    FROM sums, n, ties GROUP BY n.n, tt""")
def q_t2(spark, d):
    r = st.kruskal_statistic(L(spark, d), "neighbourhood", "price")
    return r.select(*r6("h"), "k", "n")


@register("T2_kruskal_wallis")
def q_t2b(spark, d):
    return st.kruskal_wallis(L(spark, d), "neighbourhood", "price")


@register("T3_anova_statistic", sql="""
    WITH g AS (SELECT room_type, count(*) AS n, avg(price) AS mu, var_samp(price) AS v FROM listings
               WHERE price IS NOT NULL AND room_type IS NOT NULL GROUP BY 1),
    gm AS (SELECT avg(price) AS m FROM listings WHERE price IS NOT NULL AND room_type IS NOT NULL)
    SELECT round((sum(n * pow(mu - m, 2)) / (count(*) - 1)) /
                 (sum(coalesce(v, 0) * (n - 1)) / (sum(n) - count(*))), 6) AS f,
           count(*) - 1 AS df_between, CAST(sum(n) - count(*) AS BIGINT) AS df_within
    FROM g, gm""")
def q_t3(spark, d):
    r = st.anova_statistic(L(spark, d), "room_type", "price")
    return r.select(*r6("f"), "df_between", F.col("df_within").cast("bigint"))


@register("T3_anova_oneway")
def q_t3b(spark, d):
    return st.anova_oneway(L(spark, d), "room_type", "price")


@register("T4_tukey_q", sql="""
    WITH g AS (SELECT room_type, count(*) AS n, avg(price) AS mu, var_samp(price) AS v FROM listings
               WHERE price IS NOT NULL AND room_type IS NOT NULL GROUP BY 1),
    m AS (SELECT sum(v * (n - 1)) / (sum(n) - count(*)) AS mse FROM g)
    SELECT a.room_type AS group_a, b.room_type AS group_b, round(b.mu - a.mu, 6) AS diff,
           round(abs(b.mu - a.mu) / sqrt(mse / 2 * (1.0 / a.n + 1.0 / b.n)), 6) AS q
    FROM g a JOIN g b ON a.room_type < b.room_type, m""")
def q_t4(spark, d):
    r = st.tukey_pairs(L(spark, d), "room_type", "price")
    return r.select("group_a", "group_b", *r6("diff", "q"))


@register("T4_tukey_pairs")
def q_t4b(spark, d):
    return st.tukey_pairs(L(spark, d), "neighbourhood", "price")


@register("T5_cluster_groups")
def q_t5(spark, d):
    labels, rows, sil = st.cluster_groups(
        L(spark, d), "neighbourhood", ["price", "accommodates", "bedrooms", "square_feet"], k=3)
    return rows.select("listing_id", "neighbourhood", "cluster").withColumn("silhouette", F.lit(sil))


OLS_X = ["accommodates", "bedrooms", "bathrooms"]


@register("T6_ols_summary")
def q_t6(spark, d):
    coef, model = st.ols(L(spark, d), "price", OLS_X)
    return coef


@register("T6_ols_one_x", sql="""
    SELECT '(Intercept)' AS term, round(regr_intercept(y, x1), 4) AS estimate FROM houses
    UNION ALL SELECT 'x1', round(regr_slope(y, x1), 4) FROM houses""")
def q_t6b(spark, d):
    coef, _ = st.ols(views.houses(spark, d), "y", ["x1"])
    return coef.select("term", F.round("estimate", 4).alias("estimate"))


@register("T6_ols_model_r2", sql="""
    SELECT count(*) AS n, round(regr_r2(y, x1), 6) AS r2 FROM houses""")
def q_t6c(spark, d):
    _, model = st.ols(views.houses(spark, d), "y", ["x1"])
    return model.select("n", *r6("r2"))


@register("T7_least_squares_weights", sql="""
    SELECT '(Intercept)' AS term, round(regr_intercept(y, x1), 4) AS weight FROM houses
    UNION ALL SELECT 'x1', round(regr_slope(y, x1), 4) FROM houses""")
def q_t7(spark, d):
    w = st.least_squares_weights(views.houses(spark, d), ["x1"], "y")
    return w.select("term", F.round("weight", 4).alias("weight"))


def two_slopes(table: str, x: str, z: str, y: str) -> str:
    """SQL of one row (b0, b1, b2): least squares on two columns, from covariances."""
    return f"""
    SELECT my - b1 * mx - b2 * mz AS b0, b1, b2 FROM (
      SELECT *, (p * b - q * c) / (a * b - c * c) AS b1, (q * a - p * c) / (a * b - c * c) AS b2
      FROM (SELECT var_pop({x}) AS a, var_pop({z}) AS b, covar_pop({x}, {z}) AS c,
                   covar_pop({x}, {y}) AS p, covar_pop({z}, {y}) AS q,
                   avg({x}) AS mx, avg({z}) AS mz, avg({y}) AS my
            FROM {table} WHERE {x} IS NOT NULL AND {z} IS NOT NULL AND {y} IS NOT NULL))"""


@register("T7_least_squares_two_features", sql=f"""
    WITH w AS ({two_slopes("houses", "x1", "x2", "y")})
    SELECT '(Intercept)' AS term, round(b0, 4) AS weight FROM w
    UNION ALL SELECT 'x1', round(b1, 4) FROM w UNION ALL SELECT 'x2', round(b2, 4) FROM w""")
def q_t7b(spark, d):
    w = st.least_squares_weights(views.houses(spark, d), ["x1", "x2"], "y")
    return w.select("term", F.round("weight", 4).alias("weight"))


# Start weights of the worked example.
START_WEIGHTS = [0.69646919, 0.28613933]


@register("T8_gradient_descent")
def q_t8(spark, d):
    return st.gradient_descent(views.houses(spark, d), ["x1"], "y", START_WEIGHTS, 2000, 0.01)


@register("T9_step_aic")
def q_t9(spark, d):
    return st.step_aic(L(spark, d), "price",
                       ["accommodates", "bedrooms", "bathrooms", "square_feet", "reviews_per_month"])


@register("T10_conf_int")
def q_t10(spark, d):
    coef, _ = st.ols(L(spark, d), "price", OLS_X)
    return st.conf_int(coef)


@register("T11_qq_points")
def q_t11(spark, d):
    return st.qq_points(L(spark, d), "price", 99)


def _size_model(spark, d):
    df = L(spark, d)
    coef, _ = st.ols(df, "square_feet", ["accommodates", "bedrooms"])
    return df, [(r["term"], r["estimate"]) for r in coef.collect()]


@register("T12_predict_and_fill", sql=f"""
    WITH w AS ({two_slopes("listings", "accommodates", "bedrooms", "square_feet")})
    SELECT listing_id, square_feet, accommodates, bedrooms,
           round(coalesce(square_feet, b0 + b1 * accommodates + b2 * bedrooms), 4)
             AS square_feet_filled
    FROM listings, w""")
def q_t12(spark, d):
    df, rows = _size_model(spark, d)
    filled = st.predict_and_fill(df.select("listing_id", "square_feet", "accommodates", "bedrooms"),
                                 "square_feet", rows, out="square_feet_filled")
    return filled.withColumn("square_feet_filled", F.round("square_feet_filled", 4))


@register("T13_what_if")
def q_t13(spark, d):
    df = L(spark, d).select("listing_id", *OLS_X)
    coef, _ = st.ols(L(spark, d), "price", OLS_X)
    rows = [(r["term"], r["estimate"]) for r in coef.collect()]
    return st.what_if(df, rows, "bedrooms", 1.0)


@register("T11_sample_quantiles", sql=" UNION ALL ".join(
    f"SELECT CAST({p!r} AS DOUBLE) AS p, round(quantile_cont(price, {p!r}), 6) AS sample FROM listings"
    for p in [(i - 0.5) / 20 for i in range(1, 21)]))
def q_t11b(spark, d):
    from ..operators.ranks import quantiles
    probs = [(i - 0.5) / 20 for i in range(1, 21)]
    q = quantiles(L(spark, d), "price", probs)
    return q.select("p", F.round("q", 6).alias("sample"))


# --- closed forms of one feature
@register("T8_gradient_descent_limit", sql="""
    SELECT round(avg(y), 4) AS w0, round(covar_samp(x1, y) / stddev_samp(x1), 4) AS w1 FROM houses""")
def q_t8b(spark, d):
    """After many steps on a standardised feature: the least-squares weights."""
    steps = st.gradient_descent(views.houses(spark, d), ["x1"], "y", START_WEIGHTS, 6000, 0.01)
    last = steps.where("loss IS NULL").select("weights")
    return last.select(F.round(F.get("weights", F.lit(0)), 4).alias("w0"),
                       F.round(F.get("weights", F.lit(1)), 4).alias("w1"))


@register("T9_step_aic_one_feature", sql="""
    WITH m AS (SELECT count(*) AS n, var_pop(price) * count(*) AS syy, regr_r2(price, accommodates) AS r2
               FROM listings WHERE price IS NOT NULL AND accommodates IS NOT NULL),
    a AS (SELECT n * ln(syy * (1 - r2) / n) + 4 AS one, n * ln(syy / n) + 2 AS none FROM m)
    SELECT 0 AS step, '<none>' AS dropped, round(one, 4) AS aic FROM a
    UNION ALL SELECT 1, 'accommodates', round(none, 4) FROM a WHERE none < one""")
def q_t9b(spark, d):
    steps = st.step_aic(L(spark, d), "price", ["accommodates"])
    return steps.select("step", "dropped", F.round("aic", 4).alias("aic"))


@register("T13_what_if_one_feature", sql="""
    WITH m AS (SELECT regr_slope(price, accommodates) AS b, regr_intercept(price, accommodates) AS a
               FROM listings)
    SELECT listing_id, round(a + b * accommodates, 4) AS prediction, round(b * 2, 4) AS difference
    FROM listings, m""")
def q_t13b(spark, d):
    df = L(spark, d)
    coef, _ = st.ols(df, "price", ["accommodates"])
    rows = [(r["term"], r["estimate"]) for r in coef.collect()]
    out = st.what_if(df.select("listing_id", "accommodates"), rows, "accommodates", 2.0)
    return out.select("listing_id", F.round("prediction", 4).alias("prediction"),
                      F.round("difference", 4).alias("difference"))
