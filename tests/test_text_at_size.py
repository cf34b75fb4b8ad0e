"""Stems and term counts in the task that holds the rows."""

import pytest
from pyspark.sql import functions as F

from tidewater.functions.stemmer import stemmer, stems
from tidewater.operators import textops as to


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def wide_batches(spark):
    keys = [f"spark.sql.execution.arrow.{k}" for k in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    was = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "10000")
    spark.conf.set(keys[1], str(256 << 20))
    yield keys
    for k, v in zip(keys, was):
        spark.conf.set(k, v)


def test_term_counts_take_small_batches_and_add_them_up(spark, wide_batches, monkeypatch):
    df = spark.range(1500).coalesce(1).select(F.array(
        F.lit("x"), F.concat(F.lit("t"), F.col("id") % 700)).alias("ts"))
    got = to.term_partials(df, "ts")
    assert [int(spark.conf.get(k).rstrip("b")) for k in wide_batches] == [512, 4 << 20]
    assert got.count() == 701 and got.where("term = 'x'").first()["df"] == 1500
    monkeypatch.setattr(to, "HELD_BYTES", 1)
    sums = to.term_partials(df, "ts").groupBy("term").agg(F.sum("df"), F.sum("total"))
    assert sorted(sums.collect()) == sorted(got.collect())


def test_frequent_terms_need_no_python_where_few_buckets_hold_them(spark, monkeypatch):
    df = spark.range(400).select(F.array(
        F.lit("x"), F.lit("x"), F.when(F.col("id") % 2 == 0, "y"),
        F.concat(F.lit("t"), F.col("id"))).alias("ts"))
    monkeypatch.delattr(to, "term_partials")
    assert sorted(to.frequent_terms(df, "ts", 2).collect()) == [("x", 400, 800), ("y", 200, 200)]


def test_stems_shuffle_nothing(spark):
    df = spark.createDataFrame([(1, ["cats", None, "running"], "english"), (2, ["katers"], "german")],
                               "id long, t array<string>, lang string")
    out = to.stem_tokens(df, "t", F.col("lang"))
    assert not any(x in plan_of(out) for x in ("Exchange", "Join", "Generate", "FileScan"))
    assert sorted(out.collect()) == [(1, ["cat", None, "run"], "english"), (2, ["kat"], "german")]


@pytest.mark.parametrize("language", ["english", "german"])
def test_stems_of_one_word_equal_those_of_a_table(spark, language):
    words = ("skis gently inning innings proceed y yes 'tis cat's' sayings eed feed agreed agreedly "
             "hopping falling fizzed sized tied ties us gas this kiwis conflated generically arsenals "
             "communism rational relational ology apology fluently adoption onion ball toll be e the "
             "hoffnungslosigkeit heiterkeit freundlichkeit kenntnisse haus mäuse büßen bauen quelle "
             "wichtigsten jährlich tanzend politisch eis est schönsten").split()
    words += [a + b for a in words[:40] for b in ("ing", "ed", "s", "ly", "ness", "en", "ung", "ig")]
    df = spark.createDataFrame([(w,) for w in ["", *words]], "word string")
    of = stemmer(language)
    got = stems(df, language).collect()
    assert [(r.word, r.stem) for r in got if of(r.word) != r.stem] == [] and len(got) > 300
