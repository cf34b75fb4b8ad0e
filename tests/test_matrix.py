"""Matrix operators: offsets, empty tables, reduction in several rounds."""

import numpy as np
import pytest

from tidewater.operators import matrix as mx


def table(spark, x, parts=5):
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, vec array<double>").repartition(parts)


def test_r_factor_over_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(mx, "FAN", 2)
    x = np.random.default_rng(1).normal(size=(200, 4))
    for parts in (1, 3, 9):
        r, _, n = mx.r_factor(table(spark, x, parts), "vec")
        assert n == 200 and np.allclose(r.T @ r, x.T @ x)
        r, mean, _ = mx.r_factor(table(spark, x, parts), "vec", center=True)
        assert np.allclose(mean, x.mean(0))
        assert np.allclose(r.T @ r, (x - x.mean(0)).T @ (x - x.mean(0)))


def test_pca_at_large_offsets(spark):
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.normal(size=300), 1e9 + np.sqrt(14) * rng.normal(size=300)])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                               "id long, a double, b double")
    want = np.sort(np.linalg.eigvalsh(np.cov((x - x.mean(0)).T)))[::-1]
    for scale in (False, True):
        m = mx.pca(df, ["a", "b"], 2, scale=scale, id_col="id")
        got = [r.variance for r in m["variance"].orderBy("component").collect()]
        if scale:
            want = np.sort(np.linalg.eigvalsh(np.corrcoef((x - x.mean(0)).T)))[::-1]
        assert np.allclose(got, want, rtol=1e-6)


def test_svd_of_badly_conditioned_rows(spark):
    rng = np.random.default_rng(3)
    u, _ = np.linalg.qr(rng.normal(size=(100, 3)))
    x = u * [1.0, 1e-5, 1e-9]  # squares would lose the last one
    _, S, _ = mx.svd(table(spark, x), "vec", id_col="id")
    assert np.allclose(S, [1.0, 1e-5, 1e-9], rtol=1e-6)
    U, S, Vt = mx.svd(table(spark, rng.normal(size=(60, 4))), "vec", id_col="id")
    g = np.array([r.u for r in U.collect()])
    assert np.allclose(g.T @ g, np.eye(4), atol=1e-9)


def test_rank_deficient_and_null_vectors(spark):
    x = np.outer(np.arange(1.0, 9.0), [1.0, 2.0, 0.0])
    df = table(spark, x).unionByName(
        spark.createDataFrame([(99, None)], "id long, vec array<double>"))
    U, S, Vt = mx.svd(df, "vec", id_col="id")
    got = {r.id: r.u for r in U.collect()}
    assert S[0] > 1 and np.allclose(S[1:], 0) and got[99] is None
    assert all(u[1:] == [0.0, 0.0] for i, u in got.items() if i != 99)
    rec = mx.reconstruct(U, S, Vt).where("id = 3").first()
    assert np.allclose(rec.approx, x[3])


def test_empty_tables_and_no_spread(spark):
    none = spark.createDataFrame([], "id long, vec array<double>")
    U, S, Vt = mx.svd(none, "vec", id_col="id")
    assert U.count() == 0 and len(S) == 0
    rec, sse, ratio, dropped = mx.low_rank(none, "vec", 2, "id")
    assert rec.count() == 0 and sse.first()["sse"] is None and dropped == 0
    df = spark.createDataFrame([(1, 2.0, 3.0)] * 4, "id long, a double, b double")
    for rows in (df, df.limit(0)):
        m = mx.pca(rows, ["a", "b"], 2, scale=True)
        assert [r.variance for r in m["variance"].collect()] == pytest.approx([0.0, 0.0])
