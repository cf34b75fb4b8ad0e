"""Invariants of splits, samples and models."""

import inspect
import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from core_helpers import SF_SMALL
from tidewater import views
from tidewater.operators import frames as fr
from tidewater.operators import models as md
from tidewater.operators import stats as st
from tidewater.sources.sinks import load_model, save_model


def test_split_disjoint_and_complete(spark):
    df = views.listings(spark, SF_SMALL)
    train, test = fr.train_test_split(df, 0.2, 42, "listing_id")
    a = {r[0] for r in train.select("listing_id").collect()}
    b = {r[0] for r in test.select("listing_id").collect()}
    assert not a & b and len(a | b) == df.count()
    assert 0.1 < len(b) / df.count() < 0.3


def test_sample_and_balance_sizes(spark):
    df = views.listings(spark, SF_SMALL)
    assert fr.sample_n(df, 37, 1, "listing_id").count() == 37
    bal = fr.balance_classes(df, "room_type", 10, 3, "listing_id")
    assert {r["count"] for r in bal.groupBy("room_type").count().collect()} == {10}
    rep = fr.balance_classes(df, "room_type", 400, 3, "listing_id", replace=True)
    assert {r["count"] for r in rep.groupBy("room_type").count().collect()} == {400}


def test_saved_pipeline_predicts_the_same(spark):
    df = spark.createDataFrame([(float(i), float(i % 7), float(2 * i + (i % 3))) for i in range(200)],
                               "a double, b double, price double")
    model = md.fit_price_forest(df, ["a", "b"], "price", num_trees=5, max_depth=3)
    path = os.path.join(tempfile.mkdtemp(prefix="tw-model-"), "m")
    save_model(model, path)
    p1 = [r.prediction for r in model.transform(df).orderBy("a").collect()]
    p2 = [r.prediction for r in load_model(path).transform(df).orderBy("a").collect()]
    assert p1 == p2


def test_ols_matches_spark_linear_regression(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    df = views.listings(spark, SF_SMALL).select("price", "accommodates", "bedrooms").na.drop()
    coef, model = st.ols(df, "price", ["accommodates", "bedrooms"])
    est = {r.term: r.estimate for r in coef.collect()}
    lr = LinearRegression(featuresCol="f", labelCol="price", solver="normal", regParam=0.0).fit(
        VectorAssembler(inputCols=["accommodates", "bedrooms"], outputCol="f").transform(df))
    assert abs(est["(Intercept)"] - lr.intercept) < 1e-6
    assert all(abs(est[c] - v) < 1e-6 for c, v in zip(["accommodates", "bedrooms"], lr.coefficients))
    ci = {r.term: (r.lo, r.hi) for r in st.conf_int(coef).collect()}
    assert all(lo < est[t] < hi for t, (lo, hi) in ci.items())


def test_what_if_difference_is_coefficient_times_step(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 5.0)], "a double, b double")
    out = st.what_if(df, [("(Intercept)", 1.0), ("a", 2.5), ("b", -1.0)], "a", 1.0).collect()
    assert all(abs(r.difference - 2.5) < 1e-12 for r in out)


def test_low_rank_sse_equals_dropped_sigma2(spark):
    from tidewater.operators import matrix as mx
    v = views.vectors(spark, SF_SMALL)
    rec, sse, ratio, dropped = mx.low_rank(v, "embedding", 5, "vec_id")
    assert abs(sse.first()["sse"] - dropped) / dropped < 1e-6


def test_depth_query_runs_the_whole_grid(spark, monkeypatch):
    from tidewater.plans import q_models as q
    bound = inspect.signature(md.depth_curve)
    seen = {}

    def record(*args, **kwargs):
        call = bound.bind(*args, **kwargs)
        call.apply_defaults()
        seen.update(call.arguments)

    monkeypatch.setattr(q.md, "depth_curve", record)
    monkeypatch.setattr(q, "listing_split", lambda spark, d: (None, None))
    q.q_l2(spark, SF_SMALL)
    assert list(seen["depths"]) == list(range(1, 15))
    assert (seen["folds"], seen["num_trees"]) == (10, 200)


def noisy(spark, n=400):
    return spark.createDataFrame(
        [(float(i), float(i % 7), float(i % 2), float(3 * (i % 7) + i / 50 + (i * 7919 % 13)))
         for i in range(n)], "a double, b double, c double, price double")


def test_forests_cache_node_ids_and_fold_fits_share_the_driver():
    assert md.price_forest(["a"]).getStages()[-1].getCacheNodeIds()
    assert md.fits_at_once(8_600, 200, 14, 10) == 10
    assert md.fits_at_once(10 ** 7, 200, 14, 10) == 4
    assert md.fits_at_once(0, 200, 14, 10) == 10 and md.fits_at_once(10 ** 9, 200, 29, 10) == 1


def test_cut_at_full_depth_is_the_fitted_forest(spark):
    df = noisy(spark)
    model = md.fit_price_forest(df, ["a", "b", "c"], "price", num_trees=7, max_depth=6)
    want = [r.prediction for r in model.transform(df).orderBy("a").collect()]
    x = np.array([[r.a, r.b, r.c] for r in df.orderBy("a").collect()])
    forest = md.cut_forest(model.stages[-1])
    got = forest.predict(x, [0, 3, 6, 9])
    assert np.allclose(got[:, 2], want) and np.allclose(got[:, 3], want)
    # depth 0: the root's mean, the same for every row
    assert np.ptp(got[:, 0]) < 1e-9 and np.ptp(got[:, 1]) > 1


def test_cut_forest_splits_by_category(spark):
    from pyspark.ml.feature import VectorAssembler, VectorIndexer
    from pyspark.ml.regression import RandomForestRegressor
    df = noisy(spark)
    v = VectorAssembler(inputCols=["b", "c"], outputCol="raw").transform(df)
    v = VectorIndexer(inputCol="raw", outputCol="f", maxCategories=7).fit(v).transform(v)
    model = RandomForestRegressor(featuresCol="f", labelCol="price", numTrees=5, maxDepth=4,
                                  seed=3).fit(v)
    forest = md.cut_forest(model)
    assert forest.categories
    rows = model.transform(v).orderBy("a").collect()
    assert np.allclose(forest.predict(np.array([r.f.toArray() for r in rows]), [4])[:, 0],
                       [r.prediction for r in rows])


def test_depth_errors_match_the_evaluator_and_curve_has_all_depths(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    df = noisy(spark)
    train, test = df.where("a % 3 != 0"), df.where("a % 3 = 0")
    model = md.fit_price_forest(train, ["a", "b", "c"], "price", num_trees=5, max_depth=4)
    r2 = RegressionEvaluator(labelCol="price", metricName="r2").evaluate(model.transform(test))
    found = md.depth_errors(md.cut_forest(model.stages[-1]), test, ["a", "b", "c"], "price",
                            [1, 4])
    by = {r.depth: r.r2 for r in found.collect()}
    assert abs(by[4] - r2) < 1e-9 and by[1] < by[4]
    best, curve = md.tune_depth(df, ["a", "b", "c"], "price", depths=(1, 2, 5), folds=3,
                                num_trees=5)
    means = {r.depth: r.mean_r2 for r in curve.collect()}
    assert set(means) == {1, 2, 5} and means[1] < means[5]
    assert best.stages[-1].getOrDefault("maxDepth") == max(means, key=means.get)


def test_window_counts_match_brute_force(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, [str(w) for w in rnd.integers(0, 9, n)]) for i, n in enumerate((0, 1, 3, 7, 40, 90))]
    docs = spark.createDataFrame(rows, "d long, t array<string>")
    terms = spark.createDataFrame([(0, 0, w) for w in ("0", "3", "5", "x")],
                                  "topic int, rank int, term string")
    counts, total = md.window_counts(docs, terms, "d", "t", window=5)
    want, n = {}, 0
    for _, t in rows:
        for s in range(max(1, len(t) - 4) if t else 0):
            n += 1
            seen = sorted(set(t[s:s + 5]) & {"0", "3", "5"})
            for k, a in enumerate(seen):
                for b in seen[k:]:
                    want[a, b] = want.get((a, b), 0) + 1
    assert {(r.a, r.b): r.n for r in counts.collect()} == want
    assert spark.range(1).select(total).first()[0] == n


def test_runs_come_from_rows_and_repeated_ids_are_one_document(spark):
    rows = [(1, ["a", "b", "x", "x", "x", "a"]), (1, ["a", "b", "x", "x", "x", "a"]),
            (None, ["a", "b"]), (2, None), (3, []), (4, ["b", None])]
    docs = spark.createDataFrame(rows, "d long, t array<string>")
    terms = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "term string")
    runs = md.term_runs(docs, terms, "d", "t", window=2)
    assert "Generate" not in runs._jdf.queryExecution().executedPlan().toString()
    got = [tuple(r) for r in runs.collect()]
    assert sum(r[3] for r in got if r[1] is None) == 5 + 5 + 1 + 1
    assert sorted((r for r in got if r[0] == 1)) == [
        (1, "a", 0, 0), (1, "a", 0, 0), (1, "a", 4, 4), (1, "a", 4, 4), (1, "b", 0, 1),
        (1, "b", 0, 1)]
    counts, total = md.window_counts(docs, terms, "d", "t", window=2)
    assert {(r.a, r.b): r.n for r in counts.collect()} == {
        ("a", "a"): 2, ("a", "b"): 1, ("b", "b"): 3}
    assert spark.range(1).select(total).first()[0] == 12


def test_one_topic_is_the_corpus(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["c", "a"])], "d long, t array<string>")
    terms, perplexity = md.one_topic(docs, "t", 2)
    assert [(r.topic, r["rank"], r.term) for r in terms.orderBy("rank").collect()] == [
        (0, 0, "a"), (0, 1, "b")]
    p = np.array([.6, .2, .2])
    assert abs(perplexity.first()[0] + (p * np.log(p)).sum()) < 1e-12
