"""Test statistics against direct numpy computations on a small fixture."""

import random

import numpy as np
import pytest

from tidewater.operators import stats as st


def _data(spark):
    rnd = random.Random(9)
    rows = [(g, float(rnd.randint(0, 30) + 3 * i)) for i, g in enumerate("abc") for _ in range(40)]
    return rows, spark.createDataFrame(rows, "g string, x double").repartition(3)


def test_anova_f_matches_numpy(spark):
    rows, df = _data(spark)
    groups = [np.array([x for g, x in rows if g == k]) for k in "abc"]
    allx = np.concatenate(groups)
    ssb = sum(len(v) * (v.mean() - allx.mean()) ** 2 for v in groups)
    ssw = sum(((v - v.mean()) ** 2).sum() for v in groups)
    f = (ssb / 2) / (ssw / (len(allx) - 3))
    r = st.anova_oneway(df, "g", "x").first()
    assert r.f == pytest.approx(f, rel=1e-9) and 0 <= r.p_value <= 1


def test_kruskal_h_matches_numpy(spark):
    rows, df = _data(spark)
    xs = np.array([x for _, x in rows])
    order = xs.argsort(kind="mergesort")
    ranks = np.empty(len(xs))
    ranks[order] = np.arange(1, len(xs) + 1)
    for v in np.unique(xs):  # average ranks of ties
        m = xs == v
        ranks[m] = ranks[m].mean()
    n = len(xs)
    h = 12 / (n * (n + 1)) * sum(ranks[[g == k for g, _ in rows]].sum() ** 2 / 40 for k in "abc") - 3 * (n + 1)
    _, counts = np.unique(xs, return_counts=True)
    h /= 1 - (counts ** 3 - counts).sum() / (n ** 3 - n)
    assert st.kruskal_wallis(df, "g", "x").first().h == pytest.approx(h, rel=1e-9)


def test_step_aic_reaches_a_local_optimum(spark):
    import math
    rnd = random.Random(2)
    rows = []
    for _ in range(300):
        a, b, noise = rnd.random(), rnd.random(), rnd.random()
        rows.append((a, b, noise, 3 * a - 2 * b + rnd.gauss(0, 0.01)))
    df = spark.createDataFrame(rows, "a double, b double, noise double, y double")
    steps = st.step_aic(df, "y", ["a", "b", "noise"]).orderBy("step").collect()
    names = ["a", "b", "noise"]
    X = np.array([[1.0, *r[:3]] for r in rows])
    y = np.array([r[3] for r in rows])

    def aic(terms):
        cols = [0] + [1 + names.index(t) for t in terms]
        beta = np.linalg.lstsq(X[:, cols], y, rcond=None)[0]
        rss = ((y - X[:, cols] @ beta) ** 2).sum()
        return len(y) * math.log(rss / len(y)) + 2 * len(cols)

    final = steps[-1].terms.split(",")
    assert steps[-1].aic == pytest.approx(aic(final), rel=1e-9)
    assert all(aic([t for t in final if t != d]) >= aic(final) for d in final)
    assert {"a", "b"} <= set(final)
