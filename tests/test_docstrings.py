"""The reference's docstring examples (the only exact expectations it has)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.functions import scalar as sc
from tidewater.functions import text as tx
from tidewater.operators import frames as fr
from tidewater.operators import matrix as mx
from tidewater.operators import profile as pf
from tidewater.operators import stats as st


def test_weighted_total_beer(spark):
    keys = spark.createDataFrame([(k,) for k in ["lupulo", "malta", "agua", "levadura", "limon"]],
                                 "item string")
    cost = spark.createDataFrame([("lupulo", 2.5), ("malta", 1.5), ("agua", 0.006), ("levadura", 0.45)],
                                 "item string, cost double")
    qty = spark.createDataFrame([("lupulo", 6), ("malta", 14), ("agua", 7), ("levadura", 11)],
                                "item string, qty long")
    total, missing = fr.weighted_total(keys, cost, qty)
    assert total.first()["total"] == pytest.approx(40.992)
    assert [r["item"] for r in missing.collect()] == ["limon"]


def test_sse_matrices(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)], "i int, j int, v double")
    b = spark.createDataFrame([(0, 0, 1.01), (0, 1, 1.75), (1, 0, 2.81), (1, 1, 3.99)], "i int, j int, v double")
    assert pf.sse(a, b, ["i", "j"], "v", "v").first()["sse"] == pytest.approx(0.0988)


def test_svd_and_reconstruct(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "rid int, x array<double>")
    U, S, Vt = mx.svd(df, "x", id_col="rid")
    assert S == pytest.approx([5.4649857, 0.36596619], rel=1e-7)
    rec = mx.reconstruct(U, S, Vt).orderBy("rid").collect()
    assert np.allclose([r["approx"] for r in rec], [[1, 2], [3, 4]])
    u = np.array([r["u"] for r in U.orderBy("rid").collect()])
    assert np.allclose(u.T @ u, np.eye(2))


def test_least_squares_houses(spark):
    y = [208500, 181500, 223500, 140000, 250000, 143000, 307000, 200000, 129900, 118000]
    x1 = [1710, 1262, 1786, 1717, 2198, 1362, 1694, 2090, 1774, 1077]
    x2 = [2003, 1976, 2001, 1915, 2000, 1993, 2004, 1973, 1931, 1939]
    df = spark.createDataFrame([tuple(map(float, t)) for t in zip(y, x1, x2)], "y double, x1 double, x2 double")
    w = {r["term"]: r["weight"] for r in st.least_squares_weights(df, ["x1", "x2"], "y").collect()}
    assert w["(Intercept)"] == pytest.approx(-2.29223802e6, rel=1e-8)
    assert w["x1"] == pytest.approx(59.2536529, rel=1e-8)
    assert w["x2"] == pytest.approx(1207.80450, rel=1e-8)


def test_gradient_descent_doc_example():
    x = np.array([[1.0, 0.37020659], [1.0, -0.48234664], [1.0, 0.51483616], [1.0, 0.38352774],
                  [1.0, 1.29888065]])
    y = np.array([208500, 181500, 223500, 140000, 250000], dtype=float)
    rng = np.random.RandomState(123)
    w0 = rng.rand(2)
    c, z = x[:, 1:] - x[:, 1:].mean(0), y - y.mean()
    ws, losses = st.gradient_steps(c.T @ c, c.T @ z, float(z @ z), 5, x[:, 1:].mean(0), y.mean(),
                                   w0, 2000, 0.01, normalize=True)
    assert ws[-1] == pytest.approx([183695.36963666, 40682.97678324], rel=1e-9)
    assert len(ws) == 2001 and len(losses) == 2000
    assert losses[7] == pytest.approx(((y - x @ ws[7]) ** 2).sum(), rel=1e-9)


def test_gradient_descent_spark_matches_numpy(spark):
    rows = [(0.37020659, 208500.0), (-0.48234664, 181500.0), (0.51483616, 223500.0),
            (0.38352774, 140000.0), (1.29888065, 250000.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    out = st.gradient_descent(df, ["x"], "y", [0.69646919, 0.28613933], 2000, 0.01,
                              standardize=False)
    last = out.orderBy(F.desc("step")).first()["weights"]
    assert last == pytest.approx([183695.36963666, 40682.97678324], rel=1e-6)


def test_token_union_and_intersection(spark):
    df = spark.createDataFrame([(["que", "hola"], ["que", "es", "guay"]),
                                (["que", "hola"], ["madrid", "la", "es"])], "a array<string>, b array<string>")
    out = df.select(F.array_sort(fr.token_union("a", "b")).alias("u"),
                    F.array_sort(fr.token_intersection("a", "b")).alias("i")).collect()
    assert set(out[0]["u"]) == {"que", "hola", "es", "guay"}
    assert set(out[1]["u"]) == {"que", "hola", "madrid", "la", "es"}
    assert out[0]["i"] == ["que"] and out[1]["i"] == []


def test_tokenizer_list_and_set(spark):
    df = spark.createDataFrame([("hola que que tal",)], "t string")
    r = df.select(tx.tokenize("t").alias("l"), tx.token_set("t").alias("s")).first()
    assert r["l"] == ["hola", "que", "que", "tal"] and sorted(r["s"]) == ["hola", "que", "tal"]


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [3.0, 2.0, 1.0])], "u array<double>, v array<double>")
    assert df.select(sc.cosine("u", "v")).first()[0] == pytest.approx(0.714285714)
