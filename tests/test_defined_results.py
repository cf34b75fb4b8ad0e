"""Constant, empty and one-group inputs give a defined result."""

import math

import pytest

from tidewater.operators import frames as fr
from tidewater.operators import profile as pf
from tidewater.operators import stats as st


@pytest.fixture(scope="module")
def flat(spark):
    return spark.createDataFrame([("a", 5.0, 0.0, float(i)) for i in range(4)],
                                 "g string, x double, zero double, id double")


def test_null_reports_of_an_empty_table(flat):
    none = flat.limit(0)
    assert {r.fraction for r in pf.null_report(none).collect()} == {None}
    assert fr.null_report_drop(none).columns == flat.columns


def test_histogram(flat):
    rows = pf.histogram(flat, "x", 4, density=True).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [0, 0, 4, 0]
    assert (rows[0].left, rows[-1].right) == (4.5, 5.5) and rows[2].density == 4.0
    rows = pf.histogram(flat.limit(0), "x", 3, density=True).collect()
    assert [(r["count"], r.left) for r in rows] == [(0, None)] * 3


def test_extent_scale_and_scale_by_max(flat):
    assert {r.position for r in pf.extent_scale(flat, "x").collect()} == {0.5}
    assert pf.extent_scale(flat.limit(0), "x").count() == 0
    assert {r.zero for r in fr.scale_by_max(flat, "zero").collect()} == {None}


def test_regression_metrics(flat):
    assert pf.regression_metrics(flat, "x", "x").first().r2 == 1.0
    assert pf.regression_metrics(flat, "x", "zero").first().r2 == 0.0
    r = pf.regression_metrics(flat.limit(0), "x", "zero").first()
    assert (r.n, r.rmse, r.r2) == (0, None, None)


def test_correlations_without_spread(flat):
    assert fr.drop_correlated(flat, [["x", "id"]], "id").columns == ["g", "zero", "id"]
    assert pf.corr_with(flat, ["x"], "id").first()["corr"] is None
    assert {r["corr"] for r in pf.corr_matrix(flat, ["x", "id", "zero"]).collect()} == {None}


def test_kruskal(flat):
    assert tuple(st.kruskal_wallis(flat, "g", "x").first()) == (None, 0, None)
    assert tuple(st.kruskal_wallis(flat.limit(0), "g", "x").first()) == (None, 0, None)
    assert st.kruskal_wallis(flat, "g", "id").first().p_value is None


def test_anova(spark, flat):
    assert st.anova_oneway(flat, "g", "id").first().f is None
    two = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0)], "g string, x double")
    assert st.anova_oneway(two, "g", "x").first().f is None
    r = st.anova_oneway(flat.limit(0), "g", "x").first()
    assert (r.f, r.p_value, r.df_between) == (None, None, 0)


def test_tukey(spark, flat, monkeypatch):
    two = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 2.0)], "g string, x double")
    r = st.tukey_pairs(two, "g", "x").collect()
    assert [(x.group_a, x.group_b, x["diff"], x.q, x.p_adj) for x in r] == [
        ("a", "b", 1.0, None, None)]
    assert st.tukey_pairs(flat, "g", "x").count() == 0
    assert st.tukey_pairs(flat.limit(0), "g", "x").count() == 0


def test_tukey_pairs_are_whole_over_blocks(spark, monkeypatch):
    rows = [(f"g{k:02d}", float(k + i * i % 7)) for k in range(25) for i in range(6)]
    df = spark.createDataFrame(rows, "g string, x double")
    once = sorted(map(tuple, st.tukey_pairs(df, "g", "x").collect()))
    monkeypatch.setattr(st, "TUKEY_BLOCK", 4)
    assert sorted(map(tuple, st.tukey_pairs(df, "g", "x").collect())) == once
    assert [r[:2] for r in once] == [(f"g{a:02d}", f"g{b:02d}") for a in range(25)
                                     for b in range(a + 1, 25)]


def test_ols_and_weights_of_an_empty_table(flat):
    coef, model = st.ols(flat.limit(0), "x", ["id"])
    assert {r.estimate for r in coef.collect()} == {None} and model.first().n == 0
    assert {r.weight for r in st.least_squares_weights(flat.limit(0), ["id"], "x").collect()} == {
        None}


def test_qq_points(flat):
    assert st.qq_points(flat.limit(0), "x", 5).count() == 0
    assert {(r.sample, r.line) for r in st.qq_points(flat, "x", 5).collect()} == {(5.0, 5.0)}


def test_gradient_descent_at_large_offsets(spark, flat):
    df = spark.createDataFrame([(float(i), 1e9 + 2.0 * i) for i in range(50)], "x double, y double")
    steps = st.gradient_descent(df, ["x"], "y", [1e9, 0.0], 200, 0.1).orderBy("step").collect()
    losses = [r.loss for r in steps if r.loss is not None]
    assert min(losses) >= 0 and losses[-1] < 1e-3 * losses[0]
    one = st.gradient_descent(flat, ["x"], "id", [0.0, 0.0], 5, 0.1).collect()
    assert all(math.isfinite(r.loss) for r in one if r.loss is not None)
    assert st.gradient_descent(flat.limit(0), ["x"], "id", [0.0, 0.0], 5, 0.1).count() == 1
