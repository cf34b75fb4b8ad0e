"""The pandas null rules that decide row counts."""

from pyspark.sql import functions as F

from tidewater.functions import scalar as sc
from tidewater.operators import features as fe
from tidewater.operators import frames as fr
from tidewater.operators import profile as pf


def frame(spark):
    return spark.createDataFrame(
        [(1, 100.0, 0, "Madrid", None, None, "a"), (2, None, 2, None, "x", "p,q", "b"),
         (3, 300.0, None, "Madrid", "x,y", None, "a"), (4, 250.0, 1, "Paris", None, "r", None)],
        "id int, price double, bedrooms int, city string, amen string, feat string, cat string")


def test_comparison_drops_null(spark):
    assert fr.keep_below(frame(spark), "price", 200).count() == 1


def test_delete_equal_keeps_null(spark):
    assert sorted(r.id for r in fr.drop_value_keep_null(frame(spark), "bedrooms", 0).collect()) == [2, 3, 4]


def test_not_equal_city_drops_null(spark):
    assert sorted(r.id for r in fr.keep_equal(frame(spark), {"city": "Madrid"}).collect()) == [1, 3]


def test_list_counts(spark):
    r = frame(spark).select("id", sc.list_size("amen", 0).alias("a"), sc.list_size("feat", 1).alias("f"))
    got = {x.id: (x.a, x.f) for x in r.collect()}
    assert got == {1: (0, 1), 2: (1, 2), 3: (2, 1), 4: (0, 1)}


def test_mode_smallest_of_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert pf.column_mode(df, "c").first()["c"] == "a"
    out, _ = fe.impute_mode(df, None, ["c"])
    assert sorted(r.c for r in out.collect()) == ["a", "a", "a", "b", "b"]


def test_map_unseen_to_fallback(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "cat string, y double")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "cat string")
    _, out = fe.target_encode(train, test, ["cat"], "y")
    # unseen and null categories get the most frequent encoded value (2.0, from 'a')
    assert sorted(r.cat for r in out.collect()) == [2.0, 2.0, 2.0]


def test_sample_std_and_population_option(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    pop, _ = fe.standardize(df, None, ["x"], population=True)
    samp, _ = fe.standardize(df, None, ["x"], population=False)
    assert abs(max(r.x for r in pop.collect()) - 1.3416407865) < 1e-9
    assert abs(max(r.x for r in samp.collect()) - 1.161895003) < 1e-8


def test_null_percent_rounded_before_cut(spark):
    # 1 null of 4 = 25% exactly -> dropped at >= 25
    df = spark.createDataFrame([(1, None), (2, 1), (3, 1), (4, 1)], "id int, v int")
    assert fr.null_report_drop(df, 25.0).columns == ["id"]


def test_round_half_up(spark):
    df = spark.createDataFrame([(2.675, -2.5)], "x double, y double")
    r = df.select(sc.round2(F.col("x")).alias("x"), F.round("y", 0).alias("y")).first()
    assert r.x == 2.68 and r.y == -3.0


def test_column_classes(spark):
    df = frame(spark)
    assert fr.numeric_columns(df) == ["id", "price", "bedrooms"]
    assert fr.categorical_columns(df) == ["city", "amen", "feat", "cat"]
    assert fr.columns_with_prefix(df, "c") == ["city", "cat"]


def test_one_hot_vectors_are_the_callers_choice(spark):
    train = spark.createDataFrame([(str(i),) for i in range(30)], "c string")
    test = spark.createDataFrame([("3",), ("zz",)], "c string")
    tr, te = fe.one_hot(train, test, ["c"], vectors=["c"])
    assert te.columns == ["c_vec"]
    vecs = [r.c_vec for r in te.collect()]
    assert all(v.size == 31 for v in vecs)  # 30 levels + 1 slot for unseen
    narrow_tr, narrow_te = fe.one_hot(train, test, ["c"])
    assert len(narrow_te.columns) == 30


def test_one_hot_counts_levels_before_reading_them(spark):
    import pytest

    from tidewater.operators import features as fe
    df = spark.range(30).selectExpr("id", "cast(id AS string) AS many", "cast(id % 3 AS string) AS few")
    with pytest.raises(ValueError, match="many"):
        fe.one_hot(df, None, ["many", "few"], max_levels=10)
    train, _ = fe.one_hot(df, None, ["many", "few"], vectors=["many"], max_levels=10)
    assert {"few_0", "few_1", "few_2", "many_vec"} <= set(train.columns)
