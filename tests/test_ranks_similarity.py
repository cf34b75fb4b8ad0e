"""Distributed order statistics and the exact similarity join against
brute force on small fixtures."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import frames as fr
from tidewater.operators import ranks
from tidewater.operators import similarity as sim


def test_quantiles_match_numpy(spark):
    rnd = random.Random(3)
    vals = [rnd.choice([rnd.random() * 100, float(rnd.randint(0, 9))]) for _ in range(2000)]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(vals)], "x double, g int").repartition(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.p: r.q for r in ranks.quantiles(df, "x", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12)
    grouped = ranks.quantiles(df, "x", [0.5], by=["g"]).collect()
    for r in grouped:
        sub = [v for i, v in enumerate(vals) if i % 3 == r.g]
        assert r.q == pytest.approx(float(np.median(sub)))


def test_value_ranks_dense_and_complete(spark):
    df = spark.createDataFrame([(x % 37,) for x in range(1000)], "x long").repartition(5)
    r = sorted((row.value, row.below, row.cnt) for row in ranks.value_ranks(df, "x").collect())
    below = 0
    for v, b, c in r:
        assert b == below
        below += c
    assert below == 1000


@pytest.mark.parametrize("cells", [2, 50])
def test_quantiles_of_odd_values(spark, cells):
    big = [1e300, -1e300, 3.5, 3.5, 0.0, -0.0, 1e-300, 7.0]
    rows = [("a", v) for v in big] + [("b", 2.0)] * 5 + [("c", None), ("c", float("nan"))] \
        + [(None, 1.0), (None, 4.0), ("d", float("inf")), ("d", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(3)
    probs = [0.0, 0.3, 0.5, 1.0]
    got = {(r.g, r.p): r.q for r in ranks.quantiles(df, "x", probs, by=["g"], cells=cells).collect()}
    for p in probs:
        assert got["a", p] == pytest.approx(float(np.quantile(big, p)))
        assert got["b", p] == 2.0
        assert got[None, p] == pytest.approx(1 + 3 * p)
    assert got["d", 0.0] == 1.0 and got["d", 1.0] > 1e308 and ("c", 0.5) not in got
    assert ranks.quantiles(df.limit(0), "x", probs).count() == 0


def test_quantiles_and_ranks_move_no_rows_to_python(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 1.5)
    for out in (ranks.quantiles(df, "x", [0.5]), ranks.value_ranks(df, "x")):
        assert "InPandas" not in out._jdf.queryExecution().toString()


def test_draws_with_replacement(spark, monkeypatch):
    monkeypatch.setattr(fr, "DRAW_BUCKET", 7)
    rows = [(i, "abc"[i % 3] if i % 11 else None) for i in range(300)] + [(999, "z")]
    df = spark.createDataFrame(rows, "id long, g string")
    once = sorted(map(tuple, fr.balance_classes(df.repartition(2), "g", 50, 5, "id", True)
                      .select("g", "id", "draw").collect()))
    again = sorted(map(tuple, fr.balance_classes(df.repartition(9), "g", 50, 5, "id", True)
                       .select("g", "id", "draw").collect()))
    assert once == again
    for g in "abcz":
        mine = [r for r in once if r[0] == g]
        assert sorted(r[2] for r in mine) == list(range(50))
        assert {r[1] for r in mine} <= {i for i, x in rows if x == g}
    assert 30 < len({r[1] for r in once if r[0] == "a"}) < 50  # some twice, most of them once
    assert fr.balance_classes(df.limit(0), "g", 5, 1, "id", True).count() == 0


def test_draws_are_even(spark):
    df = spark.range(20).withColumn("g", F.lit("x"))
    counts = [r["count"] for r in fr.balance_classes(df, "g", 4000, 3, "id", True)
              .groupBy("id").count().collect()]
    assert len(counts) == 20 and 140 < min(counts) and max(counts) < 260


def _brute(docs, t):
    out = {}
    for (a, sa), (b, sb) in itertools.combinations(sorted(docs.items()), 2):
        c = len(sa & sb) / math.sqrt(len(sa) * len(sb))
        if c >= t - 1e-12:
            out[(a, b)] = round(c, 3)
    return out


@pytest.mark.parametrize("t", [0.2, 0.5, 0.8, 1.0])
def test_similarity_join_exact(spark, t):
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(60)]
    docs = {}
    for i in range(80):
        k = rnd.randint(3, 25)
        docs[i] = set(rnd.sample(vocab[: rnd.choice([15, 60])], min(k, 15)))
    docs[80] = set(docs[3])  # exact copy
    df = spark.createDataFrame([(i, sorted(s)) for i, s in docs.items()], "page_id long, token_set array<string>")
    got = {(r.page_id_a, r.page_id_b): r.similarity for r in sim.page_similarity(df, t).collect()}
    assert got == _brute(docs, t)


def test_pages_text_strips_script_style(spark):
    html = ('<html><head><style>p{x}</style><script>var a="<p>";</script></head>'
            '<body><p>Hola&amp;adios</p>\n<p>que  tal</p></body></html>')
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(sim.pages_text("html")).first()[0] == "Hola&adios que tal"


def test_ranks_across_small_arrow_batches(spark):
    """Running sums must carry across Arrow batches inside one partition."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rnd = random.Random(5)
        rows = [(float(rnd.randint(0, 40)), rnd.choice(["a", "b", "c"])) for _ in range(900)]
        df = spark.createDataFrame(rows, "x double, g string").repartition(3)
        r = ranks.value_ranks(df, "x", by=["g"], partitions=2).collect()
        for row in r:
            sub = [x for x, g in rows if g == row.g]
            assert row.below == sum(1 for x in sub if x < row.value)
            assert row.cnt == sum(1 for x in sub if x == row.value)
            assert row.n == len(sub)
        got = {r.p: r.q for r in ranks.quantiles(df, "x", [0.3, 0.9]).collect()}
        allx = [x for x, _ in rows]
        assert got[0.3] == pytest.approx(float(np.quantile(allx, 0.3)))
        assert got[0.9] == pytest.approx(float(np.quantile(allx, 0.9)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
