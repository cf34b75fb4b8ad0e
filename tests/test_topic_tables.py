"""Topic models whose weights are a table, against Spark's and brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import models as md
from tidewater.operators import topics as tp


def two_kinds(spark, n=120):
    return spark.range(n).repartition(3, "id").select("id", F.transform(F.sequence(
        F.lit(1), F.lit(30)), lambda i: F.concat(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b"),
        F.floor(F.sqrt(F.pmod(F.xxhash64("id", i), F.lit(400)))).cast("string"))).alias(
        "tokens")).union(spark.sql("SELECT 999L, CAST(array() AS array<string>)")).union(
        spark.sql("SELECT 998L, array('a1', NULL, 'b1')"))


@pytest.fixture
def table(monkeypatch):
    monkeypatch.setattr(md, "HELD_WEIGHTS", 0)
    monkeypatch.setattr(tp, "CHUNK_TERMS", 7)
    monkeypatch.setattr(tp, "BLOCK_TOKENS", 500)


def test_weights_are_a_table_and_the_driver_reads_no_vocabulary(spark, table, monkeypatch):
    monkeypatch.setattr(md, "topic_estimator", None)
    df = two_kinds(spark)
    model = md.fit_topics(df, 2, passes=3)
    assert model.corpus.count > 3 and model.state.where("chunk >= 0").count() > 3
    again = md.fit_topics(df, 2, passes=3)
    best = md.topic_terms(model, 5).collect()
    assert len(best) == 10 and sorted(best) == sorted(md.topic_terms(again, 5).collect())
    assert md.topic_terms(model).columns == ["topic", "rank", "weight", "term"]
    q = md.topic_quality(model, df, "id").first()
    assert q["k"] == 2 and 0 < q["log_perplexity"] < 10


def test_table_model_equals_the_same_passes_in_memory(spark, table):
    df = two_kinds(spark)
    k, passes = 3, 4
    model = md.fit_topics(df, k, passes=passes)
    vocab = {}
    for r in model.corpus.chunks.collect():
        w = np.random.default_rng([42, r["chunk"]]).gamma(100.0, 0.01, (len(r["terms"]), k))
        vocab.update(zip(r["terms"], w))
    names = sorted(vocab)
    lam, alpha, eta = np.array([vocab[t] for t in names]), np.full(k, 1 / k), 1 / k
    docs = [sorted(t for t in r["tokens"] if t is not None) for r in df.collect()]
    docs = [np.unique([names.index(t) for t in d], return_counts=True) for d in docs if d]
    begun = {}
    for p in range(1, passes + 1):
        beta = np.exp(tp.digamma(lam) - tp.digamma(lam.sum(0)))
        stat, logs, rate = np.zeros(lam.shape), np.zeros(k), (1024 + p) ** -0.51
        for i, (ids, n) in enumerate(docs):
            # a document begins where it was
            g, theta, phi = tp.infer(beta, ids, n.astype(float), np.array([len(ids)]), alpha,
                                     begun.get(i))
            begun[i] = g
            stat[ids] += (n / phi)[:, None] * theta
            logs += (tp.digamma(g) - tp.digamma(g.sum()))[0]
        lam = (1 - rate) * lam + rate * (stat * beta + eta)
        n = len(docs)
        grad = n * (tp.digamma(alpha.sum()) - tp.digamma(alpha)) + logs
        c, q = n * tp.trigamma(alpha.sum()), -n * tp.trigamma(alpha)
        alpha = alpha - rate * (grad - (grad / q).sum() / (1 / c + (1 / q).sum())) / q
    share = lam / lam.sum(0)
    got = {(r["topic"], r["term"]): r["weight"] for r in md.topic_terms(model, 1000).collect()}
    assert len(got) == k * len(names)
    # weights travel with 32 bits
    assert max(abs(v / share[names.index(t), j] - 1) for (j, t), v in got.items()) < 1e-4
    assert np.allclose(model.alpha, alpha, rtol=1e-4)


def test_bound_of_a_table_model_is_that_of_spark(spark, table, monkeypatch):
    df = two_kinds(spark, 400)
    model = md.fit_topics(df, 2)
    mine = model.log_perplexity(df)
    assert model.log_perplexity(df.select("*")) == pytest.approx(mine, abs=1e-3)
    # unknown words are left out, as CountVectorizer does
    more = df.union(spark.sql("SELECT 997L, array('zz', 'a3')"))
    assert model.log_perplexity(more) == pytest.approx(mine, abs=0.05)
    monkeypatch.setattr(md, "HELD_WEIGHTS", 10 ** 6)
    whole = df.where("id <> 998")
    spark_model = md.fit_topics(whole, 2)
    assert mine == pytest.approx(spark_model.stages[-1].logPerplexity(
        spark_model.stages[0].transform(whole)), abs=0.05)


def test_trigamma():
    x = np.array([0.3, 1.0, 5.5, 80.0])
    assert np.allclose(tp.trigamma(x) - tp.trigamma(x + 1), 1 / (x * x))
    assert tp.trigamma(np.array([1.0]))[0] == pytest.approx(math.pi ** 2 / 6)
