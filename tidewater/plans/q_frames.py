"""Queries of the relational core (P, F, J, K, U) over the listing view."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import views
from ..functions import text as tx
from ..operators import frames as fr
from ..operators import profile as pf
from . import sqltext as sq
from .registry import register

L = views.listings
LISTING_TYPES = {
    "listing_id": "bigint", "price": "double", "city": "string", "neighbourhood": "string",
    "zipcode": "string", "room_type": "string", "property_type": "string",
    "accommodates": "bigint", "bathrooms": "bigint", "bedrooms": "bigint",
    "square_feet": "bigint", "amenities": "string", "features": "string",
    "host_since": "string", "response_time": "string", "reviews_per_month": "double",
    "mostly_null": "bigint", "constant": "string",
}


@register("P1_select_columns", sql="SELECT listing_id, price, city FROM listings")
def q_p1(spark, d):
    return fr.select_columns(L(spark, d), ["listing_id", "price", "city"])


DROP_GROUPS = {"lists": ["amenities", "features"], "dates": ["host_since"],
               "mostly_empty": ["mostly_null"]}


@register("P2_drop_columns",
          sql="SELECT * EXCLUDE (amenities, features, host_since, mostly_null) FROM listings")
def q_p2(spark, d):
    return fr.drop_columns(L(spark, d), DROP_GROUPS)


@register("P3_rename", sql="""
    SELECT listing_id AS id, price AS precio, city AS ciudad, room_type AS tipo FROM listings""")
def q_p3(spark, d):
    df = fr.rename(L(spark, d).select("listing_id", "price", "city", "room_type"),
                   names=["id", "precio", "ciudad", "room_type"])
    return fr.rename(df, {"room_type": "tipo"})


@register("P6_derive", sql="""
    SELECT listing_id, round(square_feet * CAST(0.092903 AS DOUBLE), 6) AS square_meters,
           bedrooms * bathrooms AS bed_bath FROM listings""")
def q_p6(spark, d):
    df = fr.derive(L(spark, d))
    return df.select("listing_id", F.round("square_meters", 6).alias("square_meters"), "bed_bath")


@register("P7_scale_by_max", sql="""
    SELECT listing_id, round(price / (SELECT max(price) FROM listings), 6) AS price_scaled,
           round(accommodates / 255.0, 6) AS acc_scaled FROM listings""")
def q_p7(spark, d):
    df = L(spark, d)
    out = fr.scale_by_max(df, "price", out="price_scaled")
    out = fr.scale_by_max(out, "accommodates", constant=255, out="acc_scaled")
    return out.select("listing_id", F.round("price_scaled", 6).alias("price_scaled"),
                      F.round("acc_scaled", 6).alias("acc_scaled"))


@register("P8_align_columns", sql="""
    SELECT price, 0 AS room_type_1_URGENT, listing_id FROM listings""")
def q_p8(spark, d):
    return fr.align_columns(L(spark, d).select("listing_id", "price", "city"),
                            ["price", "room_type_1_URGENT", "listing_id"])


def _p10_sql():
    parts = [f"SELECT (SELECT count(*) FROM listings) AS rows, {i} AS position, "
             f"'{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM listings"
             for i, (c, t) in enumerate(LISTING_TYPES.items())]
    return " UNION ALL ".join(parts)


@register("P10_schema_report", sql=_p10_sql())
def q_p10(spark, d):
    return fr.schema_report(L(spark, d))


@register("F1_keep_equal", sql="""
    SELECT * FROM listings WHERE city = 'EUROPE' AND room_type = '1-URGENT'""")
def q_f1(spark, d):
    return fr.keep_equal(L(spark, d), {"city": "EUROPE", "room_type": "1-URGENT"})


@register("F2_keep_below_above", sql="""
    SELECT * FROM listings WHERE price < 200 AND accommodates < 8 AND reviews_per_month > 0""")
def q_f2(spark, d):
    df = fr.keep_below(L(spark, d), "price", 200)
    df = fr.keep_below(df, "accommodates", 8)
    return fr.keep_above(df, "reviews_per_month", 0)


@register("F3_column_cutoff", sql="""
    SELECT * FROM listings WHERE price BETWEEN 30 AND 200 AND accommodates BETWEEN 2 AND 6
      AND square_feet BETWEEN 200 AND 1000""")
def q_f3(spark, d):
    return fr.column_cutoff(L(spark, d), [("price", 30, 200), ("accommodates", 2, 6),
                                          ("square_feet", 200, 1000)])


@register("F4_drop_value_keep_null", sql="""
    SELECT * FROM listings WHERE bedrooms IS NULL OR bedrooms <> 0""")
def q_f4(spark, d):
    return fr.drop_value_keep_null(L(spark, d), "bedrooms", 0)


@register("F5_drop_null_subset", sql="""
    SELECT * FROM listings WHERE bedrooms IS NOT NULL AND bathrooms IS NOT NULL""")
def q_f5(spark, d):
    return fr.drop_null(L(spark, d), ["bedrooms", "bathrooms"])


@register("F5_complete_cases", sql=f"""
    SELECT * FROM listings WHERE {' AND '.join(c + ' IS NOT NULL' for c in LISTING_TYPES)}""")
def q_f5b(spark, d):
    return fr.complete_cases(L(spark, d))


@register("F6_drop_blank", sql="SELECT * FROM listings WHERE neighbourhood <> ''")
def q_f6(spark, d):
    return fr.drop_blank(L(spark, d), "neighbourhood")


@register("F7_null_if", sql="""
    SELECT listing_id, CASE WHEN square_feet * 0.092903 < 20 THEN NULL ELSE square_feet END
           AS square_feet FROM listings""")
def q_f7(spark, d):
    df = L(spark, d).select("listing_id", "square_feet")
    return fr.null_if(df, "square_feet", F.col("square_feet") * fr.SQFT_TO_M2 < 20)


@register("F8_drop_rare", sql="""
    SELECT * FROM listings WHERE "constant" IN
      (SELECT "constant" FROM listings GROUP BY 1 HAVING count(*) >= 25)""")
def q_f8(spark, d):
    return fr.drop_rare(L(spark, d), "constant", 25)


@register("F9_null_report_drop")
def q_f9(spark, d):
    return fr.null_report_drop(L(spark, d), 25.0)


@register("F10_top_value_ratios", sql=f"""
    WITH long AS ({' UNION ALL '.join(
        f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS v FROM listings" for c in LISTING_TYPES)}),
    pv AS (SELECT col, v, count(*) AS n FROM long GROUP BY col, v)
    SELECT col AS "column", max(n) AS top_count, count(*) AS n_distinct,
           round(max(n) / (SELECT count(*) FROM listings), 6) AS top_ratio
    FROM pv GROUP BY col""")
def q_f10(spark, d):
    r = fr.top_value_ratios(L(spark, d))
    return r.select("column", "top_count", "n_distinct",
                    F.round("top_ratio", 6).alias("top_ratio"))


@register("F10_drop_constant")
def q_f10b(spark, d):
    return fr.drop_constant(L(spark, d), 0.995)


@register("F11_drop_correlated")
def q_f11(spark, d):
    df = fr.derive(L(spark, d))
    return fr.drop_correlated(df, [["bedrooms", "bed_bath"], ["square_feet", "square_meters"]],
                              "price")


@register("F12_keep_available", sql="""
    SELECT * FROM listings WHERE listing_id IN
      (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def q_f12(spark, d):
    mask = views.table(spark, d, "lineitem").filter("l_returnflag = 'R'") \
        .select(F.col("l_orderkey").alias("listing_id"))
    return fr.keep_available(L(spark, d), mask, "listing_id")


@register("J2_merge_on", sql="""
    SELECT l.listing_id, l.neighbourhood, l.price, round(m.mean_price, 6) AS mean_price
    FROM listings l JOIN (SELECT neighbourhood, avg(price) AS mean_price FROM listings
                          GROUP BY 1) m ON l.neighbourhood = m.neighbourhood""")
def q_j2(spark, d):
    df = L(spark, d)
    means = pf.mean_by(df, "neighbourhood", "price", out="mean_price")
    return fr.merge_on(df.select("listing_id", "neighbourhood", "price"), means, "neighbourhood") \
        .withColumn("mean_price", F.round("mean_price", 6))


@register("J3_drop_all_null_groups", sql="""
    SELECT * FROM listings WHERE accommodates NOT IN
      (SELECT accommodates FROM listings GROUP BY 1 HAVING count(mostly_null) = 0)""")
def q_j3(spark, d):
    return fr.drop_all_null_groups(L(spark, d), "accommodates", "mostly_null")


@register("J4_lookup", sql="""
    SELECT l.listing_id, l.neighbourhood,
           round(coalesce(m.enc, -1.0), 6) AS neighbourhood_enc
    FROM listings l LEFT JOIN (SELECT neighbourhood, avg(price) AS enc FROM listings
                               WHERE city = 'ASIA' GROUP BY 1) m
      ON l.neighbourhood = m.neighbourhood""")
def q_j4(spark, d):
    df = L(spark, d)
    enc = pf.mean_by(df.filter("city = 'ASIA'"), "neighbourhood", "price", out="enc")
    out = fr.lookup(df.select("listing_id", "neighbourhood"), enc, "neighbourhood", "enc",
                    default=-1.0, out="neighbourhood_enc")
    return out.withColumn("neighbourhood_enc", F.round("neighbourhood_enc", 6))


def _j5_tables(spark, d):
    part = views.table(spark, d, "part")
    li = views.table(spark, d, "lineitem")
    keys = part.select(F.col("p_partkey").alias("item"))
    cost = part.select(F.col("p_partkey").alias("item"),
                       F.round(F.col("p_retailprice") * 100).cast("bigint").alias("cost"))
    qty = li.groupBy(F.col("l_partkey").alias("item")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"))
    return keys, cost, qty


@register("J5_weighted_total", sql="""
    SELECT CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT) * q.qty) AS BIGINT) AS total
    FROM part JOIN (SELECT l_partkey, sum(CAST(l_quantity AS BIGINT)) AS qty FROM lineitem
                    GROUP BY 1) q ON p_partkey = q.l_partkey""")
def q_j5(spark, d):
    total, _ = fr.weighted_total(*_j5_tables(spark, d))
    return total.select(F.col("total").cast("bigint").alias("total"))


@register("J5_missing_items", sql="""
    SELECT p_partkey AS item FROM part
    WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)
       OR p_size < 3""")
def q_j5b(spark, d):
    """Parts without a large order, or without a price for small ones."""
    part = views.table(spark, d, "part")
    large = views.table(spark, d, "lineitem").where("l_quantity >= 49")
    qty = large.groupBy(F.col("l_partkey").alias("item")).agg(F.sum("l_quantity").alias("qty"))
    cost = part.where("p_size >= 3").select(F.col("p_partkey").alias("item"),
                                            F.col("p_retailprice").alias("cost"))
    _, missing = fr.weighted_total(part.select(F.col("p_partkey").alias("item")), cost, qty)
    return missing


@register("J6_take_by_row_id", sql="""
    SELECT l.* FROM listings l JOIN labels b ON l.listing_id = b.doc_id""")
def q_j6(spark, d):
    ids = views.table(spark, d, "labels").select(F.col("doc_id").alias("listing_id"))
    return fr.take_by_row_id(L(spark, d), ids, "listing_id")


QUERY_VEC = [round(0.05 * ((i % 7) - 3), 2) for i in range(64)]


def _vec_sql():
    return "[" + ", ".join(repr(float(x)) for x in QUERY_VEC) + "]::DOUBLE[]"


@register("J8_query_against_all", sql=f"""
    SELECT vec_id, round(list_sum(list_transform(list_zip(embedding, {_vec_sql()}),
                                  lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 6) AS sq_dist
    FROM vectors""")
def q_j8(spark, d):
    out = fr.query_against_all(views.vectors(spark, d), "embedding", QUERY_VEC)
    return out.select("vec_id", F.round("sq_dist", 6).alias("sq_dist"))


@register("K1_top_k", sql="""
    SELECT listing_id, price FROM listings ORDER BY price DESC, listing_id LIMIT 10""")
def q_k1(spark, d):
    return fr.top_k(L(spark, d).select("listing_id", "price"), ["price", "listing_id"], 10,
                    asc=[False, True])


@register("K2_top_k_groups", sql="""
    SELECT * FROM (SELECT zipcode, count(*) AS count FROM listings GROUP BY 1
                   ORDER BY count DESC, zipcode NULLS LAST LIMIT 3)""")
def q_k2(spark, d):
    return fr.top_k_groups(L(spark, d), "zipcode", 3)


@register("K2_bottom_k_groups", sql="""
    SELECT * FROM (SELECT neighbourhood, count(*) AS count FROM listings GROUP BY 1
                   ORDER BY count, neighbourhood LIMIT 5)""")
def q_k2b(spark, d):
    return fr.top_k_groups(L(spark, d), "neighbourhood", 5, largest=False)


@register("K3_top_k_where", sql="""
    SELECT * FROM (SELECT neighbourhood, count(*) AS n, round(avg(price), 6) AS mean_price,
                          round(avg(square_feet), 6) AS mean_size
                   FROM listings GROUP BY 1) WHERE n > 100
    ORDER BY mean_price, neighbourhood LIMIT 5""")
def q_k3(spark, d):
    prof = pf.group_profile(L(spark, d), "neighbourhood", "price", "square_feet")
    prof = prof.select("neighbourhood", "n", F.round("mean_price", 6).alias("mean_price"),
                       F.round("mean_size", 6).alias("mean_size"))
    return fr.top_k_where(prof, "n", 100, "mean_price", 5, asc=True, tie="neighbourhood")


@register("K4_cap_per_group", sql="""
    SELECT listing_id, neighbourhood, price FROM (
      SELECT listing_id, neighbourhood, price,
             row_number() OVER (PARTITION BY neighbourhood ORDER BY listing_id) AS rn
      FROM listings) WHERE rn <= 50""")
def q_k4(spark, d):
    return fr.cap_per_group(L(spark, d).select("listing_id", "neighbourhood", "price"),
                            "neighbourhood", 50, ["listing_id"])


@register("K5_k_nearest", sql=f"""
    SELECT vec_id, label, round(list_sum(list_transform(list_zip(embedding, {_vec_sql()}),
                                  lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 6) AS sq_dist
    FROM vectors ORDER BY sq_dist, vec_id LIMIT 5""")
def q_k5(spark, d):
    out = fr.k_nearest(views.vectors(spark, d), "embedding", QUERY_VEC, 5, "vec_id")
    return out.select("vec_id", "label", F.round("sq_dist", 6).alias("sq_dist"))


@register("K6_sort_values", sql="SELECT listing_id, price FROM listings ORDER BY price, listing_id")
def q_k6(spark, d):
    return fr.sort_values(L(spark, d).select("listing_id", "price"), ["price", "listing_id"])


@register("K7_train_test_split")
def q_k7(spark, d):
    df = L(spark, d)
    train, test = fr.train_test_split(df, 0.2, 42, "listing_id")
    return train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test")))


@register("K8_sample_n")
def q_k8(spark, d):
    return fr.sample_n(views.reviews(spark, d), 100, 7, "doc_id")


@register("K9_balance_classes")
def q_k9(spark, d):
    r = views.reviews(spark, d).withColumn("sentiment", F.when(F.col("overall") < 3, 0).otherwise(1))
    return fr.balance_classes(r, "sentiment", 50, 11, "doc_id")


@register("K9_balance_classes_with_replacement")
def q_k9b(spark, d):
    r = views.reviews(spark, d).withColumn("sentiment", F.when(F.col("overall") < 3, 0).otherwise(1))
    return fr.balance_classes(r, "sentiment", 120, 11, "doc_id", replace=True)


@register("U2_complement", sql="""
    SELECT * FROM listings WHERE listing_id NOT IN (SELECT listing_id FROM listings WHERE price < 30)""")
def q_u2(spark, d):
    df = L(spark, d)
    return fr.complement(df, df.filter("price < 30"), "listing_id")


@register("U3_token_union_intersection", sql=f"""
    WITH t AS (SELECT doc_id,
        list_distinct(string_split({sq.clean_text("split_part(text, chr(10), 1)")}, ' ')) AS a,
        CASE WHEN strpos(text, chr(10)) > 0 THEN list_distinct(string_split(
          {sq.clean_text("substr(text, strpos(text, chr(10)) + 1)")}, ' ')) ELSE [] END AS b
      FROM documents)
    SELECT doc_id, list_sort(list_distinct(list_concat(a, b))) AS token_union,
           list_sort(list_intersect(a, b)) AS token_intersection FROM t""")
def q_u3(spark, d):
    docs = views.table(spark, d, "documents")
    first = F.substring_index("text", "\n", 1)
    rest = F.expr("substr(text, instr(text, chr(10)) + 1)")
    # a text of one line has an empty second set
    second = F.when(F.instr("text", "\n") > 0, tx.token_set(tx.clean_text(rest))).otherwise(
        F.array().cast("array<string>"))
    t = docs.select("doc_id", tx.token_set(tx.clean_text(first)).alias("a"), second.alias("b"))
    return t.select("doc_id", F.array_sort(fr.token_union("a", "b")).alias("token_union"),
                    F.array_sort(fr.token_intersection("a", "b")).alias("token_intersection"))


@register("P9_split_xy")
def q_p9(spark, d):
    df = L(spark, d).select("listing_id", "price", "accommodates", "bathrooms", "bedrooms")
    return fr.split_xy(df, "price", ["accommodates", "bathrooms", "bedrooms"])


# --- invariants of operators whose rows SQL cannot repeat
@register("P5_column_kinds", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CASE WHEN any_value(typeof({c})) = 'VARCHAR' THEN 'categorical'
        ELSE 'numeric' END AS kind FROM listings""" for c in LISTING_TYPES))
def q_p5(spark, d):
    df = L(spark, d).select(*LISTING_TYPES)
    rows = [(c, "numeric") for c in fr.numeric_columns(df)] + [
        (c, "categorical") for c in fr.categorical_columns(df)]
    return spark.createDataFrame(rows, "column string, kind string")


@register("F9_columns_kept", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS "column" FROM listings
        HAVING round(100.0 * count_if({c} IS NULL) / count(*), 2) < 25""" for c in LISTING_TYPES))
def q_f9b(spark, d):
    kept = fr.null_report_drop(L(spark, d).select(*LISTING_TYPES), 25.0).columns
    return spark.createDataFrame([(c,) for c in kept], "column string")


@register("F11_columns_kept", sql="""
    WITH c AS (SELECT abs(corr(bedrooms, price)) AS a, abs(corr(bedrooms * bathrooms, price)) AS b
               FROM listings)
    SELECT CASE WHEN a >= b THEN 'bedrooms' ELSE 'bed_bath' END AS "column" FROM c""")
def q_f11b(spark, d):
    df = fr.derive(L(spark, d)).select("price", "bedrooms", "bed_bath")
    kept = fr.drop_correlated(df, [["bedrooms", "bed_bath"]], "price").columns
    return spark.createDataFrame([(c,) for c in kept if c != "price"], "column string")


@register("K7_split_is_disjoint_and_whole", sql="""
    SELECT count(*) AS n, 0::BIGINT AS overlap, CAST(sum(listing_id) AS BIGINT) AS ids
    FROM listings""")
def q_k7b(spark, d):
    train, test = fr.train_test_split(L(spark, d), 0.2, 42, "listing_id")
    both = train.select("listing_id").unionByName(test.select("listing_id"))
    overlap = train.join(test.select("listing_id"), "listing_id", "left_semi")
    return both.agg(F.count(F.lit(1)).alias("n"), F.sum("listing_id").cast("long").alias("ids")) \
        .withColumn("overlap", overlap.agg(F.count(F.lit(1))).scalar())


@register("K8_sample_size", sql="""
    SELECT least(count(*), 100) AS n, least(count(*), 100) AS ids, least(count(*), 100) AS known
    FROM reviews""")
def q_k8b(spark, d):
    r = views.reviews(spark, d)
    s = fr.sample_n(r, 100, 7, "doc_id").select("doc_id")
    known = s.join(r.select("doc_id"), "doc_id", "left_semi").agg(F.count(F.lit(1))).scalar()
    return s.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids")) \
        .withColumn("known", known)


@register("K9_draws_per_class", sql="""
    SELECT CASE WHEN overall < 3 THEN 0 ELSE 1 END AS sentiment, 120::BIGINT AS n, 120::BIGINT AS draws
    FROM reviews GROUP BY 1""")
def q_k9c(spark, d):
    r = views.reviews(spark, d).withColumn("sentiment", F.when(F.col("overall") < 3, 0).otherwise(1))
    drawn = fr.balance_classes(r, "sentiment", 120, 11, "doc_id", replace=True)
    return drawn.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"),
                                          F.count_distinct("draw").alias("draws"))


@register("P9_split_xy_values", sql="""
    SELECT price AS label, [CAST(accommodates AS DOUBLE), CAST(bedrooms AS DOUBLE)] AS x FROM listings
    WHERE bedrooms IS NOT NULL""")
def q_p9b(spark, d):
    from pyspark.ml.functions import vector_to_array
    df = L(spark, d).select("price", "accommodates", "bedrooms").where("bedrooms IS NOT NULL")
    return fr.split_xy(df, "price").select("label", vector_to_array("features").alias("x"))
