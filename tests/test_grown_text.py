"""Stems, counts by buckets and TF-IDF of texts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import textops as to


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_meet_only_the_words_that_change(spark):
    df = spark.createDataFrame(
        [(1, ["cats", None, "cats", "tree"], "english"), (2, None, "english"), (3, [], "german"),
         (4, ["häuser"], "german"), (5, ["cats"], None), (5, ["cats"], "french")],
        "id int, t array<string>, lang string")
    out = to.stem_tokens(df, "t", F.col("lang"))
    assert "posexplode" not in plan_of(out) and out.columns == df.columns
    assert sorted(map(str, (r["t"] for r in out.collect()))) == sorted(map(str, [
        ["cat", None, "cat", "tree"], None, [], ["haus"], ["cats"], ["cats"]]))


def test_frequent_terms_equal_a_count_of_all(spark):
    df = spark.range(300).select("id", F.transform(F.sequence(F.lit(0), F.lit(40)), lambda i: F.when(
        i == 7, None).otherwise(F.concat(F.lit("t"), F.floor(F.pow(F.pmod(F.xxhash64(
            "id", i), F.lit(1000)) / 31.0, 2)).cast("string")))).alias("ts")).union(
        spark.sql("SELECT 300L, CAST(NULL AS array<string>)"))
    plain = df.select(F.col("id").alias("r"), F.explode("ts").alias("term")) \
        .where("term IS NOT NULL").groupBy("term").agg(
        F.count_distinct("r").alias("df"), F.count(F.lit(1)).alias("total"))
    assert sorted(to.term_partials(df, "ts").groupBy("term").agg(
        F.sum("df"), F.sum("total")).collect()) == sorted(plain.collect())
    for k, keep in ((5, None), (3, F.col("df") < 20), (10_000, F.col("df") >= 3)):
        want = (plain if keep is None else plain.where(keep)).orderBy(
            F.desc("total"), "term").limit(k).collect()
        assert sorted(to.frequent_terms(df, "ts", k, keep).collect()) == sorted(want)


def test_tfidf_weights_and_ties(spark):
    df = spark.createDataFrame([(["b", "a", "a"],), (["b", "c"],), (["c"],), (["d"],)],
                               "ts array<string>")
    model = to.fit_tfidf(df, "ts", vocab_size=2, min_df=1, max_df=0.95)
    assert model.stages[0].vocabulary == ["a", "b"]  # a, b and c are tied
    row = model.transform(df).first()["features"].toArray()
    want = np.array([2 * (1 + math.log(5 / 2)), 1 + math.log(5 / 3)])
    assert np.allclose(row, want / np.sqrt((want ** 2).sum()))
    with pytest.raises(ValueError):
        to.fit_tfidf(df, "ts", min_df=3)


def test_kept_columns_only(spark):
    df = spark.createDataFrame([(1, "The cats", "english"), (2, "Häuser", "german"),
                                (3, "...", None)], "id int, text string, lang string")
    whole = to.text_transformations(df, "text", F.col("lang"))
    kept = to.text_transformations(df, "text", F.col("lang"), keep=("id",))
    assert kept.columns == ["id", "standardized_text"]
    assert sorted(kept.collect()) == sorted(whole.select(*kept.columns).collect())
