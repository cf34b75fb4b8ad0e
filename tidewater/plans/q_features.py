"""Queries of feature engineering (FE1-FE7) and the listing scalar
functions (S4-S8, S22-S24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import views
from ..functions import scalar as sc
from ..operators import features as fe
from ..operators import frames as fr
from .q_frames import QUERY_VEC, _vec_sql
from .registry import register

L = views.listings


def r6(*cols):
    return [F.round(c, 6).alias(c) for c in cols]


@register("S4_years_until", sql="""
    SELECT listing_id, CAST(2020 - year(try_strptime(host_since, '%Y-%m-%d')) AS INTEGER) AS years FROM listings""")
def q_s4(spark, d):
    return L(spark, d).select("listing_id", sc.years_until("host_since", 2020).alias("years"))


@register("S5_list_size", sql="""
    SELECT listing_id, CAST(coalesce(len(string_split(amenities, ',')), 0) AS INTEGER) AS n_amenities,
           CAST(coalesce(len(string_split(features, ',')), 1) AS INTEGER) AS n_features FROM listings""")
def q_s5(spark, d):
    return L(spark, d).select("listing_id", sc.list_size("amenities", 0).alias("n_amenities"),
                              sc.list_size("features", 1).alias("n_features"))


@register("S6_log_positive", sql="""
    SELECT listing_id, round(ln(reviews_per_month), 6) AS reviews_per_month FROM listings
    WHERE reviews_per_month > 0""")
def q_s6(spark, d):
    out = fe.log_positive(L(spark, d).select("listing_id", "reviews_per_month"), "reviews_per_month")
    return out.select("listing_id", *r6("reviews_per_month"))


def _postcode_sql(fixes):
    digits = "regexp_replace(split_part(zipcode, chr(10), 1), '[^0-9]', '', 'g')"
    case = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in fixes.items())
    fx = f"(CASE {digits} {case} ELSE {digits} END)"
    return f"CASE WHEN regexp_full_match({fx}, '28[0-9]{{3}}') THEN {fx} END"


@register("S7_clean_postcode", sql=f"""
    SELECT listing_id, zipcode, {_postcode_sql(sc.POSTCODE_FIXES)} AS postcode FROM listings""")
def q_s7(spark, d):
    return L(spark, d).select("listing_id", "zipcode", sc.clean_postcode("zipcode").alias("postcode"))


@register("S7_clean_postcode_variant", sql=f"""
    SELECT {_postcode_sql(sc.POSTCODE_FIXES_VARIANT)} AS postcode, count(*) AS n FROM listings
    GROUP BY 1""")
def q_s7b(spark, d):
    return (L(spark, d).select(sc.clean_postcode("zipcode", sc.POSTCODE_FIXES_VARIANT).alias("postcode"))
            .groupBy("postcode").agg(F.count(F.lit(1)).alias("n")))


@register("S8_round2", sql="""
    SELECT listing_id, round(reviews_per_month * 3.14159, 2) AS r FROM listings""")
def q_s8(spark, d):
    return L(spark, d).select("listing_id", sc.round2(F.col("reviews_per_month") * 3.14159).alias("r"))


@register("S22_price_band", sql="""
    SELECT listing_id, CASE WHEN price <= 30 THEN 'cheap' WHEN price <= 75 THEN 'affordable'
                            WHEN price IS NOT NULL THEN 'expensive' END AS band FROM listings""")
def q_s22(spark, d):
    return L(spark, d).select("listing_id", sc.price_band("price").alias("band"))


@register("S23_poisson_pmf", sql="""
    WITH l AS (SELECT avg(bedrooms) AS lam FROM listings)
    SELECT CAST(k AS INTEGER) AS k, round(exp(-lam) * pow(lam, k) / factorial(CAST(k AS INTEGER)), 6) AS pmf
    FROM l, range(0, 8) t(k)""")
def q_s23(spark, d):
    lam = L(spark, d).agg(F.avg("bedrooms")).scalar()
    ks = spark.range(0, 8).select(F.col("id").cast("int").alias("k"))
    return ks.select("k", F.round(sc.poisson_pmf(F.col("k"), lam), 6).alias("pmf"))


@register("S24_cosine", sql=f"""
    SELECT vec_id, round(list_cosine_similarity(embedding, {_vec_sql()}), 6) AS cosine FROM vectors""")
def q_s24(spark, d):
    q = F.array(*[F.lit(float(x)) for x in QUERY_VEC])
    return views.vectors(spark, d).select("vec_id", F.round(sc.cosine("embedding", q), 6).alias("cosine"))


NUM3 = ["bathrooms", "bedrooms", "reviews_per_month"]


@register("FE1_impute_mean", sql=f"""
    SELECT listing_id, {', '.join(f"round(coalesce({c}, (SELECT avg({c}) FROM listings)), 6) AS {c}" for c in NUM3)}
    FROM listings""")
def q_fe1(spark, d):
    df = L(spark, d).select("listing_id", *NUM3)
    out, _ = fe.impute_mean(df, None, NUM3)
    return out.select("listing_id", *r6(*NUM3))


@register("FE1_impute_mean_fit_on_train", sql=f"""
    SELECT listing_id, {', '.join(f"round(coalesce({c}, (SELECT avg({c}) FROM listings WHERE city = 'EUROPE')), 6) AS {c}" for c in NUM3)}
    FROM listings WHERE city IS DISTINCT FROM 'EUROPE'""")
def q_fe1b(spark, d):
    df = L(spark, d).select("listing_id", "city", *NUM3)
    train = df.filter(F.col("city") == "EUROPE")
    test = df.filter(F.col("city").isNull() | (F.col("city") != "EUROPE"))
    _, out = fe.impute_mean(train, test, NUM3)
    return out.select("listing_id", *r6(*NUM3))


@register("FE2_impute_mode", sql="""
    SELECT listing_id, coalesce(response_time, (SELECT response_time FROM listings
        WHERE response_time IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, response_time LIMIT 1))
        AS response_time FROM listings""")
def q_fe2(spark, d):
    df = L(spark, d).select("listing_id", "response_time")
    out, _ = fe.impute_mode(df, None, ["response_time"])
    return out


@register("FE3_target_encode", sql="""
    WITH enc AS (SELECT neighbourhood, avg(price) AS e, count(*) AS n FROM listings
                 WHERE city = 'ASIA' AND neighbourhood IS NOT NULL GROUP BY 1),
    fb AS (SELECT e FROM enc GROUP BY e ORDER BY sum(n) DESC, e LIMIT 1)
    SELECT l.listing_id, round(coalesce(enc.e, (SELECT e FROM fb)), 6) AS neighbourhood
    FROM listings l LEFT JOIN enc ON l.neighbourhood = enc.neighbourhood""")
def q_fe3(spark, d):
    df = L(spark, d).select("listing_id", "neighbourhood", "price", "city")
    train = df.filter(F.col("city") == "ASIA")
    _, out = fe.target_encode(train, df, ["neighbourhood"], "price")
    return out.select("listing_id", *r6("neighbourhood"))


@register("FE4_one_hot", sql="""
    SELECT listing_id, price,
           CAST(room_type = '1-URGENT' AS INTEGER) AS "room_type_1-URGENT",
           CAST(room_type = '2-HIGH' AS INTEGER) AS "room_type_2-HIGH",
           CAST(room_type = '3-MEDIUM' AS INTEGER) AS "room_type_3-MEDIUM",
           CAST(room_type = '4-NOT SPECIFIED' AS INTEGER) AS "room_type_4-NOT SPECIFIED",
           CAST(room_type = '5-LOW' AS INTEGER) AS "room_type_5-LOW"
    FROM listings""")
def q_fe4(spark, d):
    df = L(spark, d).select("listing_id", "price", "room_type")
    _, out = fe.one_hot(df.filter(F.col("price") < 200), df, ["room_type"])
    return out


@register("FE5_standardize", sql="""
    SELECT listing_id,
      round((price - (SELECT avg(price) FROM listings)) / (SELECT stddev_pop(price) FROM listings), 6) AS price,
      round((accommodates - (SELECT avg(accommodates) FROM listings)) /
            (SELECT stddev_pop(accommodates) FROM listings), 6) AS accommodates
    FROM listings""")
def q_fe5(spark, d):
    df = L(spark, d).select("listing_id", "price", "accommodates")
    out, _ = fe.standardize(df, None, ["price", "accommodates"])
    return out.select("listing_id", *r6("price", "accommodates"))


@register("FE6_min_max_fit_on_train", sql="""
    WITH s AS (SELECT min(price) AS lo, max(price) AS hi FROM listings WHERE city = 'EUROPE')
    SELECT listing_id, round((price - lo) / (hi - lo), 6) AS price FROM listings, s""")
def q_fe6(spark, d):
    df = L(spark, d).select("listing_id", "price", "city")
    _, out = fe.min_max(df.filter(F.col("city") == "EUROPE"), df, ["price"])
    return out.select("listing_id", *r6("price"))


FE7_SQL = """
    WITH a AS (SELECT listing_id, price, room_type, property_type, accommodates,
                      CAST(bathrooms AS DOUBLE) AS bathrooms, CAST(bedrooms AS DOUBLE) AS bedrooms,
                      CAST(coalesce(len(string_split(amenities, ',')), 0) AS INTEGER) AS amenities,
                      CAST(coalesce(len(string_split(features, ',')), 1) AS INTEGER) AS features,
                      host_since, response_time, reviews_per_month,
                      CAST(bedrooms * bathrooms AS DOUBLE) AS bed_bath
               FROM listings WHERE price < 200 AND city = 'EUROPE'),
    b AS (SELECT * FROM a WHERE (bedrooms IS NULL OR bedrooms <> 0) AND (bed_bath IS NULL OR bed_bath <> 0)
          AND (reviews_per_month IS NULL OR reviews_per_month <> 0) AND accommodates < 8
          AND host_since IS NOT NULL),
    mo AS (SELECT response_time AS m FROM b WHERE response_time IS NOT NULL GROUP BY 1
           ORDER BY count(*) DESC, response_time LIMIT 1),
    me AS (SELECT avg(bathrooms) AS mb, avg(bedrooms) AS mbd, avg(reviews_per_month) AS mr,
                  avg(bed_bath) AS mbb FROM b),
    c AS (SELECT listing_id, price, room_type, property_type, accommodates,
                 coalesce(bathrooms, mb) AS bathrooms, coalesce(bedrooms, mbd) AS bedrooms,
                 amenities, features, host_since, coalesce(response_time, m) AS response_time,
                 coalesce(reviews_per_month, mr) AS reviews_per_month, coalesce(bed_bath, mbb) AS bed_bath
          FROM b, mo, me),
    d AS (SELECT listing_id, price, room_type, property_type, accommodates, bathrooms, bedrooms,
                 amenities, features, response_time, ln(reviews_per_month) AS reviews_per_month,
                 ln(bed_bath) AS bed_bath, CAST(2020 - year(CAST(host_since AS DATE)) AS INTEGER) AS year
          FROM c WHERE bed_bath > 0 AND reviews_per_month > 0),
    e1 AS (SELECT room_type AS k, avg(price) AS v FROM d GROUP BY 1),
    e2 AS (SELECT property_type AS k, avg(price) AS v FROM d GROUP BY 1),
    e3 AS (SELECT response_time AS k, avg(price) AS v FROM d GROUP BY 1)
    SELECT listing_id, price, round(e1.v, 6) AS room_type, round(e2.v, 6) AS property_type,
           accommodates, round(bathrooms, 6) AS bathrooms, round(bedrooms, 6) AS bedrooms,
           amenities, features, round(e3.v, 6) AS response_time,
           round(reviews_per_month, 6) AS reviews_per_month, round(bed_bath, 6) AS bed_bath, year
    FROM d JOIN e1 ON d.room_type = e1.k JOIN e2 ON d.property_type = e2.k
           JOIN e3 ON d.response_time = e3.k"""

FE7_COLS = ["listing_id", "price", "room_type", "property_type", "accommodates", "bathrooms",
            "bedrooms", "amenities", "features", "response_time", "reviews_per_month",
            "bed_bath", "year"]
FE7_ROUND = {"room_type", "property_type", "bathrooms", "bedrooms", "response_time",
             "reviews_per_month", "bed_bath"}


def _fe7_out(df):
    return df.select(*[F.round(c, 6).alias(c) if c in FE7_ROUND else F.col(c) for c in FE7_COLS])


@register("FE7_listing_features", sql=FE7_SQL)
def q_fe7(spark, d):
    df = L(spark, d)
    out, _ = fe.listing_features(df)
    return _fe7_out(out)


@register("FE7_listing_features_train_test")
def q_fe7b(spark, d):
    df = L(spark, d)
    train, test = fr.train_test_split(df, 0.2, 42, "listing_id")
    tr, te = fe.listing_features(train, test)
    return _fe7_out(tr).withColumn("part", F.lit("train")).unionByName(
        _fe7_out(te).withColumn("part", F.lit("test")))
