"""Numerics of the linear models, and distribution tails."""
import math

import numpy as np
import pytest

from tidewater.functions import dist
from tidewater.operators import stats as st


def frame(spark, x, y):
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, ", ".join(f"x{i} double" for i in range(x.shape[1]))
                                 + ", y double")


def test_large_offset(spark):
    rnd = np.random.default_rng(0)
    x = rnd.random((1000, 1)) * 100
    noise = rnd.normal(size=1000)
    want = np.polyfit(x[:, 0], 2 * x[:, 0] + noise, 1)
    y = 1e9 + 2 * x[:, 0] + noise
    coef, model = st.ols(frame(spark, x, y), "y", ["x0"])
    got = {r.term: r.estimate for r in coef.collect()}
    assert got["x0"] == pytest.approx(want[0], rel=1e-6)
    assert got["(Intercept)"] == pytest.approx(1e9 + want[1], rel=1e-12)
    rss = np.sum((2 * x[:, 0] + noise - np.polyval(want, x[:, 0])) ** 2)
    assert model.first().rss == pytest.approx(rss, rel=1e-5)
    assert st.step_aic(frame(spark, x, y), "y", ["x0"]).count() == 1


def test_collinear_terms_are_null(spark):
    rnd = np.random.default_rng(1)
    x = rnd.random((200, 2))
    x = np.column_stack([x[:, 0], 3 * x[:, 0] - 1, x[:, 1], np.ones(200)])
    y = 1 + 2 * x[:, 0] - x[:, 2] + rnd.normal(size=200) / 10
    names = ["x0", "x1", "x2", "x3"]
    coef, model = st.ols(frame(spark, x, y), "y", names)
    got = {r.term: r.estimate for r in coef.collect()}
    want = np.linalg.lstsq(np.column_stack([np.ones(200), x[:, 0], x[:, 2]]), y, rcond=None)[0]
    assert got["x1"] is None and got["x3"] is None and model.first().p == 3
    assert [got["(Intercept)"], got["x0"], got["x2"]] == pytest.approx(list(want))
    weights = {r.term: r.weight for r in st.least_squares_weights(
        frame(spark, x, y), names, "y").collect()}
    assert weights["x1"] is None and weights["x2"] == pytest.approx(want[2])
    assert "x1" not in st.step_aic(frame(spark, x, y), "y", names).first().terms


def test_standard_errors(spark):
    rnd = np.random.default_rng(2)
    x = rnd.random((80, 2)) + 5
    y = 3 + x @ [1.0, -2.0] + rnd.normal(size=80)
    full = np.column_stack([np.ones(80), x])
    beta, rss = np.linalg.lstsq(full, y, rcond=None)[:2]
    se = np.sqrt(np.diag(np.linalg.inv(full.T @ full)) * rss[0] / 77)
    rows = st.ols(frame(spark, x, y), "y", ["x0", "x1"])[0].collect()
    assert [r.std_error for r in rows] == pytest.approx(list(se))
    none = np.linalg.lstsq(x, y, rcond=None)[0]
    rows = st.ols(frame(spark, x, y), "y", ["x0", "x1"], intercept=False)[0].collect()
    assert [r.estimate for r in rows] == pytest.approx(list(none))


def test_tails_keep_small_values():
    assert dist.chi2_sf(200.0, 2) == pytest.approx(math.exp(-100), rel=1e-10)
    assert dist.f_sf(1e6, 2, 10) == pytest.approx((1 + 2e6 / 10) ** -5, rel=1e-9)
    assert dist.t_ppf(0.9999, 1) == pytest.approx(1 / math.tan(math.pi * 1e-4), rel=1e-8)
    assert dist.t_ppf(0.025, 10) == pytest.approx(-2.228138852, abs=1e-8)
    assert dist.chi2_sf(3.0, 4) == pytest.approx(math.exp(-1.5) * 2.5, rel=1e-12)


def test_studentised_range_has_no_step():
    assert dist.ptukey(3.5, 4, 5001) == pytest.approx(dist.ptukey(3.5, 4, 4999), abs=1e-5)
    assert dist.ptukey(3.633, 4, 1e7) == pytest.approx(0.95, abs=2e-4)
