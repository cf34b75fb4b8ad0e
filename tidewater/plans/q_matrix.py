"""Queries of the matrix operators (M1-M5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import views
from ..operators import matrix as mx
from .registry import register

PCA_COLS = ["price", "accommodates", "bathrooms", "bedrooms", "square_feet"]


@register("M1_svd_left_vectors")
def q_m1(spark, d):
    U, S, Vt = mx.svd(views.vectors(spark, d), "embedding", k=10, id_col="vec_id")
    return U


@register("M2_reconstruct")
def q_m2(spark, d):
    U, S, Vt = mx.svd(views.vectors(spark, d), "embedding", k=10, id_col="vec_id")
    return mx.reconstruct(U, S, Vt).select("vec_id", "approx")


@register("M3_low_rank_sse")
def q_m3(spark, d):
    rec, sse, ratio, dropped = mx.low_rank(views.vectors(spark, d), "embedding", 8, "vec_id")
    return sse.withColumn("ratio", F.lit(ratio)).withColumn("dropped_sigma2", F.lit(dropped))


@register("M4_pca_variance")
def q_m4(spark, d):
    m = mx.pca(views.listings(spark, d), PCA_COLS, 2, center=True, scale=True, id_col="listing_id")
    return m["variance"]


@register("M4_pca_uncentred_scores")
def q_m4b(spark, d):
    m = mx.pca(views.listings(spark, d), PCA_COLS, 2, center=False, id_col="listing_id")
    return m["scores"]


@register("M5_similar_rows")
def q_m5(spark, d):
    m = mx.pca(views.listings(spark, d), PCA_COLS, 2, center=False, id_col="listing_id")
    return mx.similar_rows(m, [60.0, 4, 2, 2, 600], 5, "listing_id")


@register("M1_left_vectors_orthonormal", sql="""
    SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j,
           CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS dot
    FROM range(10) a(i), range(10) b(j)""")
def q_m1b(spark, d):
    """U'U is the identity."""
    U, _, _ = mx.svd(views.vectors(spark, d), "embedding", k=10, id_col="vec_id")
    pairs = U.select(F.posexplode("u").alias("i", "a"), "u").select(
        "i", "a", F.posexplode("u").alias("j", "b"))
    return pairs.groupBy("i", "j").agg((F.round(F.sum(F.col("a") * F.col("b")), 6) + 0.0)
                                       .alias("dot"))


@register("M2_full_rank_reconstruction", sql="""
    SELECT vec_id, list_transform(embedding, lambda x: round(CAST(x AS DOUBLE), 4)) AS approx
    FROM vectors""")
def q_m2b(spark, d):
    """All singular vectors give every row back."""
    U, S, Vt = mx.svd(views.vectors(spark, d), "embedding", id_col="vec_id")
    return mx.reconstruct(U, S, Vt).select("vec_id", F.transform(
        "approx", lambda x: F.round(x, 4) + 0.0).alias("approx"))


@register("M3_squares_kept_and_dropped", sql="""
    SELECT round(sum(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 4)
      AS squares, 0.0::DOUBLE AS miss FROM vectors""")
def q_m3b(spark, d):
    """SSE is the sum of the dropped squared singular values; all of them are the squares."""
    v = views.vectors(spark, d)
    _, S, _ = mx.svd(v, "embedding", k=8, id_col="vec_id")
    _, sse, _, dropped = mx.low_rank(v, "embedding", 8, "vec_id")
    return sse.select(F.round(F.col("sse") + float((S ** 2).sum()), 4).alias("squares"),
                      (F.round(F.col("sse") - dropped, 6) + 0.0).alias("miss"))


@register("M4_pca_two_columns", sql="""
    WITH c AS (SELECT var_samp(price) AS a, var_samp(accommodates) AS b,
                      covar_samp(price, accommodates) AS c FROM listings
               WHERE price IS NOT NULL AND accommodates IS NOT NULL),
    w AS (SELECT (a + b) / 2 + sqrt((a - b) * (a - b) / 4 + c * c) AS one, a + b AS total FROM c)
    SELECT 1 AS component, round(one, 4) AS variance, round(one / total, 8) AS cumulative FROM w
    UNION ALL SELECT 2, round(total - one, 4), 1.0 FROM w""")
def q_m4c(spark, d):
    m = mx.pca(views.listings(spark, d), ["price", "accommodates"], 2)
    return m["variance"].select("component", F.round("variance", 4).alias("variance"),
                                F.round("cumulative", 8).alias("cumulative"))


@register("M5_similar_rows_all_components", sql="""
    SELECT listing_id, round(pow(price - 60, 2) + pow(accommodates - 4, 2) + pow(bathrooms - 2, 2)
      + pow(bedrooms - 2, 2) + pow(square_feet - 600, 2), 4) AS sq_dist
    FROM listings WHERE price IS NOT NULL AND accommodates IS NOT NULL AND bathrooms IS NOT NULL
      AND bedrooms IS NOT NULL AND square_feet IS NOT NULL
    ORDER BY round(pow(price - 60, 2) + pow(accommodates - 4, 2) + pow(bathrooms - 2, 2)
      + pow(bedrooms - 2, 2) + pow(square_feet - 600, 2), 4), listing_id LIMIT 5""")
def q_m5b(spark, d):
    """A rotation by all components keeps the distances."""
    m = mx.pca(views.listings(spark, d), PCA_COLS, len(PCA_COLS), center=False,
               id_col="listing_id")
    near = mx.similar_rows(m, [60.0, 4, 2, 2, 600], 5, "listing_id")
    return near.select("listing_id", F.round("sq_dist", 4).alias("sq_dist"))
