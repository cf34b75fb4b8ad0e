"""Queries of the profiling aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import views
from ..operators import profile as pf
from .q_frames import LISTING_TYPES
from .registry import register

L = views.listings


def r6(*cols):
    return [F.round(c, 6).alias(c) for c in cols]


@register("A3_value_counts", sql="""
    SELECT room_type, count(*) AS count, round(count(*) / (SELECT count(room_type) FROM listings), 6) AS ratio,
           round(count(*) * 100.0 / (SELECT count(room_type) FROM listings), 2) AS percent
    FROM listings WHERE room_type IS NOT NULL GROUP BY 1""")
def q_a3(spark, d):
    v = pf.value_counts(L(spark, d), "room_type")
    return v.select("room_type", "count", *r6("ratio"), "percent")


@register("A25_class_balance", sql="""
    SELECT CASE WHEN overall < 3 THEN 0 ELSE 1 END AS sentiment, count(*) AS count,
           round(count(*) / (SELECT count(*) FROM reviews), 6) AS ratio,
           round(count(*) * 100.0 / (SELECT count(*) FROM reviews), 2) AS percent
    FROM reviews GROUP BY 1""")
def q_a25(spark, d):
    r = views.reviews(spark, d).withColumn("sentiment", F.when(F.col("overall") < 3, 0).otherwise(1))
    v = pf.value_counts(r, "sentiment")
    return v.select("sentiment", "count", *r6("ratio"), "percent")


@register("A4_value_counts_by", sql="""
    SELECT city, room_type, count(*) AS count,
           round(count(*) / sum(count(*)) OVER (PARTITION BY city), 6) AS ratio
    FROM listings WHERE city IS NOT NULL AND room_type IS NOT NULL GROUP BY 1, 2""")
def q_a4(spark, d):
    v = pf.value_counts_by(L(spark, d), "city", "room_type")
    return v.select("city", "room_type", "count", *r6("ratio"))


@register("A5_mean_by", sql="""
    SELECT neighbourhood, round(avg(price), 6) AS mean_price FROM listings
    WHERE neighbourhood IS NOT NULL GROUP BY 1""")
def q_a5(spark, d):
    return pf.mean_by(L(spark, d), "neighbourhood", "price", "mean_price").select(
        "neighbourhood", *r6("mean_price"))


@register("A6_group_profile", sql="""
    SELECT neighbourhood, count(*) AS n, round(avg(price), 6) AS mean_price,
           round(avg(square_feet), 6) AS mean_size FROM listings GROUP BY 1""")
def q_a6(spark, d):
    p = pf.group_profile(L(spark, d), "neighbourhood", "price", "square_feet")
    return p.select("neighbourhood", "n", *r6("mean_price", "mean_size"))


@register("A7_distinct_counts", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) "
    f"AS n_distinct FROM listings" for c in LISTING_TYPES))
def q_a7(spark, d):
    return pf.distinct_counts(L(spark, d))


@register("A8_distinct_values", sql="""
    SELECT DISTINCT room_type FROM listings WHERE city = 'EUROPE' AND room_type IS NOT NULL""")
def q_a8(spark, d):
    return pf.distinct_values(L(spark, d), "room_type", F.col("city") == "EUROPE")


@register("A9_null_report", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, "
    f"round((count(*) - count({c})) / count(*), 6) AS fraction, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 2) AS percent FROM listings"
    for c in LISTING_TYPES))
def q_a9(spark, d):
    r = pf.null_report(L(spark, d))
    return r.select("column", "nulls", *r6("fraction"), "percent")


@register("A10_null_share_by", sql="""
    SELECT neighbourhood, round(avg(CASE WHEN square_feet IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_share,
           count(*) AS n
    FROM listings GROUP BY 1 HAVING avg(CASE WHEN square_feet IS NULL THEN 1.0 ELSE 0.0 END) >= 0.25""")
def q_a10(spark, d):
    r = pf.null_share_by(L(spark, d), "neighbourhood", "square_feet", 0.25)
    return r.select("neighbourhood", *r6("null_share"), "n")


@register("A11_share_where", sql="""
    SELECT round(avg(CASE WHEN price > 75 THEN 1.0 ELSE 0.0 END) * 100, 2) AS percent FROM listings""")
def q_a11(spark, d):
    return pf.share_where(L(spark, d), F.col("price") > 75)


DESCRIBE_COLS = ["price", "accommodates", "square_feet", "reviews_per_month"]


@register("A12_describe", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, count(*) - count({c}) AS nulls, "
    f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
    f"round(quantile_cont({c}, 0.75), 6) AS q75 FROM listings" for c in DESCRIBE_COLS))
def q_a12(spark, d):
    r = pf.describe(L(spark, d), DESCRIBE_COLS)
    return r.select("column", "count", "nulls", *r6("mean", "std"), "min", "max",
                    *r6("q25", "q50", "q75"))


LEVEL_COLS = ["room_type", "property_type", "response_time", "city"]


@register("A12_describe_levels", sql="WITH l AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS level, count(*) AS count FROM listings "
    f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in LEVEL_COLS) + """)
    SELECT "column", CAST(row_number() OVER (PARTITION BY "column" ORDER BY count DESC, level)
             AS INTEGER) AS rank, level, count FROM l QUALIFY rank <= 4""")
def q_a12b(spark, d):
    return pf.describe_levels(L(spark, d), LEVEL_COLS, 4).select("column", "rank", "level", "count")


@register("A13_column_mode", sql="""
    SELECT response_time AS mode FROM listings WHERE response_time IS NOT NULL
    GROUP BY 1 ORDER BY count(*) DESC, response_time LIMIT 1""")
def q_a13(spark, d):
    return pf.column_stat(L(spark, d), "response_time", "mode")


@register("A13_column_mean_max_min", sql="""
    SELECT round(avg(reviews_per_month), 6) AS mean, max(price) AS max, min(accommodates) AS min
    FROM listings""")
def q_a13b(spark, d):
    df = L(spark, d)
    mean = pf.column_stat(df, "reviews_per_month", "mean")
    return mean.select(
        F.round("mean", 6).alias("mean"), pf.column_stat(df, "price", "max").scalar().alias("max"),
        pf.column_stat(df, "accommodates", "min").scalar().alias("min"))


CORR_COLS = ["accommodates", "bedrooms", "bathrooms", "square_feet", "reviews_per_month"]


@register("A14_corr_with", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(corr({c}, price), 6) AS corr FROM listings"
    for c in CORR_COLS))
def q_a14(spark, d):
    return pf.corr_with(L(spark, d), CORR_COLS, "price").select("column", *r6("corr"))


@register("A15_corr_matrix", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(abs(corr({a}, {b})), 6) AS corr FROM listings"
    for i, a in enumerate(CORR_COLS + ["price"]) for b in (CORR_COLS + ["price"])[i + 1:]))
def q_a15(spark, d):
    return pf.corr_matrix(L(spark, d), CORR_COLS + ["price"]).select("col_a", "col_b", *r6("corr"))


@register("A16_histogram", sql="""
    WITH e AS (SELECT min(price) AS lo, max(price) AS hi, count(price) AS n FROM listings),
    b AS (SELECT CAST(least(floor((price - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin
          FROM listings, e WHERE price IS NOT NULL),
    c AS (SELECT CAST(r.range AS INTEGER) AS bin, count(b.bin) AS count
          FROM range(10) r LEFT JOIN b ON b.bin = r.range GROUP BY 1)
    SELECT bin, count, round(lo + bin * (hi - lo) / 10, 6) AS "left",
           round(lo + (bin + 1) * (hi - lo) / 10, 6) AS "right",
           round(count / (n * (hi - lo) / 10), 6) AS density
    FROM c, e""")
def q_a16(spark, d):
    h = pf.histogram(L(spark, d), "price", 10, density=True)
    return h.select("bin", "count", *r6("left", "right", "density"))


@register("A17_box_stats", sql="""
    WITH q AS (SELECT room_type, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
                      quantile_cont(price, 0.75) AS q3 FROM listings
               WHERE price IS NOT NULL AND room_type IS NOT NULL GROUP BY 1),
    f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS flo, q3 + 1.5 * (q3 - q1) AS fhi FROM q)
    SELECT f.room_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
           round(iqr, 6) AS iqr,
           min(CASE WHEN price BETWEEN flo AND fhi THEN price END) AS whisker_lo,
           max(CASE WHEN price BETWEEN flo AND fhi THEN price END) AS whisker_hi,
           count(*) FILTER (WHERE NOT (price BETWEEN flo AND fhi)) AS outliers, count(*) AS n
    FROM f JOIN listings l ON l.room_type = f.room_type WHERE l.price IS NOT NULL
    GROUP BY f.room_type, q1, median, q3, iqr""")
def q_a17(spark, d):
    b = pf.box_stats(L(spark, d), "price", "room_type")
    return b.select("room_type", *r6("q1", "median", "q3", "iqr"), "whisker_lo", "whisker_hi",
                    "outliers", "n")


@register("A18_density_by", sql="""
    WITH e AS (SELECT min(price) - 27 AS lo, max(price) + 27 AS hi FROM listings
               WHERE price IS NOT NULL AND room_type IS NOT NULL),
    g AS (SELECT range AS g FROM range(0, 64)),
    s AS (SELECT room_type, count(*) AS n FROM listings WHERE price IS NOT NULL GROUP BY 1)
    SELECT l.room_type, CAST(g.g AS INTEGER) AS g, round(lo + g.g * (hi - lo) / 63, 6) AS x,
           round(sum(exp(-pow(((lo + g.g * (hi - lo) / 63) - price) / 9, 2) / 2))
                 / (s.n * 9 * sqrt(2 * pi())), 6) AS density
    FROM listings l, g, e, s WHERE l.room_type = s.room_type AND price IS NOT NULL
    GROUP BY l.room_type, g.g, lo, hi, s.n""")
def q_a18(spark, d):
    r = pf.density_by(L(spark, d), "room_type", "price", bw=9.0, grid=64)
    return r.select("room_type", "g", *r6("x", "density"))


@register("A19_neighbourhood_profile", sql="""
    WITH m AS (SELECT neighbourhood, avg(price) AS avgprice FROM listings
               WHERE neighbourhood IS NOT NULL GROUP BY 1),
    top AS (SELECT CAST(max(bedrooms) AS INTEGER) AS t FROM listings WHERE neighbourhood IS NOT NULL),
    c AS (SELECT neighbourhood, CAST(bedrooms AS INTEGER) AS b, count(*) AS total FROM listings
          WHERE bedrooms IS NOT NULL AND neighbourhood IS NOT NULL GROUP BY 1, 2)
    SELECT m.neighbourhood, round(m.avgprice, 6) AS avgprice, CAST(g.b AS INTEGER) AS bedrooms,
           coalesce(c.total, 0) AS total
    FROM m CROSS JOIN top CROSS JOIN LATERAL (SELECT unnest(range(0, top.t + 1)) AS b) g
    LEFT JOIN c ON c.neighbourhood = m.neighbourhood AND c.b = g.b""")
def q_a19(spark, d):
    r = pf.neighbourhood_profile(L(spark, d))
    return r.select("neighbourhood", *r6("avgprice"), "bedrooms", "total")


@register("A20_extent_scale", sql="""
    WITH m AS (SELECT neighbourhood, avg(price) AS avgprice FROM listings GROUP BY 1)
    SELECT neighbourhood, round(avgprice, 6) AS avgprice,
           round((avgprice - (SELECT min(avgprice) FROM m)) /
                 ((SELECT max(avgprice) FROM m) - (SELECT min(avgprice) FROM m)), 6) AS position
    FROM m""")
def q_a20(spark, d):
    m = pf.group_profile(L(spark, d), "neighbourhood", "price", "square_feet") \
        .select("neighbourhood", F.col("mean_price").alias("avgprice"))
    return pf.extent_scale(m, "avgprice").select("neighbourhood", *r6("avgprice", "position"))


@register("A22_regression_metrics", sql="""
    WITH p AS (SELECT price AS y, avg(price) OVER (PARTITION BY neighbourhood) AS yhat FROM listings)
    SELECT count(*) AS n, round(sqrt(avg((y - yhat) * (y - yhat))), 6) AS rmse,
           round(avg(abs(y - yhat)), 6) AS mae,
           round(1 - sum((y - yhat) * (y - yhat)) / (count(*) * var_pop(y)), 6) AS r2 FROM p""")
def q_a22(spark, d):
    df = L(spark, d)
    means = pf.mean_by(df, "neighbourhood", "price", "yhat")
    pred = df.join(means, "neighbourhood").select(F.col("price").alias("y"), "yhat")
    return pf.regression_metrics(pred, "y", "yhat").select("n", *r6("rmse", "mae", "r2"))


@register("A23_sse", sql="""
    SELECT round(sum(list_sum(list_transform(embedding, lambda x: (x - round(x, 1)) * (x - round(x, 1))))), 6)
           AS sse FROM vectors""")
def q_a23(spark, d):
    v = views.vectors(spark, d).withColumn("approx", F.transform("embedding", lambda x: F.round(x, 1)))
    return pf.sse_arrays(v, "embedding", "approx").select(*r6("sse"))


@register("A23_sse_long_form", sql="""
    SELECT round(sum(list_sum(list_transform(embedding, lambda x: (x - round(x, 1)) * (x - round(x, 1))))), 6)
           AS sse FROM vectors""")
def q_a23b(spark, d):
    """The same from two matrices of (row, column, value), joined on their coordinates."""
    long = views.vectors(spark, d).select("vec_id", F.posexplode("embedding").alias("j", "x"))
    near = long.select("vec_id", "j", F.round("x", 1).alias("near"))
    return pf.sse(long, near, ["vec_id", "j"], "x", "near").select(*r6("sse"))


@register("A24_classification_metrics", sql="""
    WITH p AS (SELECT CASE WHEN overall < 3 THEN 0 ELSE 1 END AS label,
                      CASE WHEN length(review_text) > 2000 THEN 1 ELSE 0 END AS prediction
               FROM reviews),
    cm AS (SELECT label, prediction, count(*) AS c FROM p GROUP BY 1, 2),
    cls AS (SELECT label AS cls FROM cm UNION SELECT prediction FROM cm)
    SELECT cls, CAST(coalesce((SELECT sum(c) FROM cm WHERE label = cls), 0) AS BIGINT) AS support,
           CAST(coalesce((SELECT sum(c) FROM cm WHERE prediction = cls), 0) AS BIGINT) AS predicted,
           CAST(coalesce((SELECT sum(c) FROM cm WHERE label = cls AND prediction = cls), 0) AS BIGINT) AS tp,
           round((SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FROM p), 6) AS accuracy,
           round(coalesce((SELECT sum(c) FROM cm WHERE label = cls AND prediction = cls)
             / (SELECT sum(c) FROM cm WHERE prediction = cls), 0.0), 6) AS precision,
           round(coalesce((SELECT sum(c) FROM cm WHERE label = cls AND prediction = cls)
             / (SELECT sum(c) FROM cm WHERE label = cls), 0.0), 6) AS recall,
           round(coalesce(2.0 * (SELECT sum(c) FROM cm WHERE label = cls AND prediction = cls)
             / ((SELECT sum(c) FROM cm WHERE label = cls)
                + coalesce((SELECT sum(c) FROM cm WHERE prediction = cls), 0)), 0.0), 6) AS f1
    FROM cls""")
def q_a24(spark, d):
    r = views.reviews(spark, d).select(
        F.when(F.col("overall") < 3, 0).otherwise(1).alias("label"),
        F.when(F.length("review_text") > 2000, 1).otherwise(0).alias("prediction"))
    m = pf.classification_metrics(r)
    return m.select("cls", "support", "predicted", "tp", *r6("accuracy", "precision", "recall", "f1"))


@register("A24_confusion", sql="""
    SELECT CASE WHEN overall < 3 THEN 0 ELSE 1 END AS label,
           CASE WHEN length(review_text) > 2000 THEN 1 ELSE 0 END AS prediction, count(*) AS count
    FROM reviews GROUP BY 1, 2""")
def q_a24b(spark, d):
    r = views.reviews(spark, d).select(
        F.when(F.col("overall") < 3, 0).otherwise(1).alias("label"),
        F.when(F.length("review_text") > 2000, 1).otherwise(0).alias("prediction"))
    return pf.confusion(r)


@register("A26_regression_line", sql="""
    WITH e AS (SELECT min(x1) AS lo, max(x1) AS hi FROM houses)
    SELECT CAST(i AS INTEGER) AS i, round((lo - 500) + i * ((hi + 500) - (lo - 500)) / 49, 6) AS x,
           round(1000.0 + 950.0 * ((lo - 500) + i * ((hi + 500) - (lo - 500)) / 49), 6) AS y
    FROM e, range(0, 50) t(i)""")
def q_a26(spark, d):
    r = pf.regression_line(views.houses(spark, d), "x1", [1000.0, 950.0], n=50)
    return r.select("i", *r6("x", "y"))
