import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from tidewater.llm import centroids

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("cluster", T.StringType()), T.StructField("distance", T.StringType()),
    T.StructField("n", T.StringType())])


def brute(rows, k, dim, scale=64, rounds=3, clip=1 << 40):
    kept = [(i, [max(-clip, min(clip, math.floor(scale * v))) for v in x]) for i, x in rows
            if x is not None and len(x) == dim
            and all(v is not None and math.isfinite(v) for v in x)]
    seed = sorted(kept, key=lambda r: (hashlib.sha256(
        f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cs = [x for _, x in seed[:k]]

    def assign():
        out = []
        for i, x in kept:
            d = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in cs]
            out.append((i, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        placed = assign()
        for c in range(len(cs)):
            mine = [x for (_, x), (_, own, _) in zip(kept, placed) if own == c]
            if mine:
                cs[c] = [sum(v) // len(mine) for v in zip(*mine)]
    total = sum(d for _, _, d in assign())
    by = [sum(d for _, own, d in assign() if own == c) for c in range(len(cs))]
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, c, d, by[c], total, shas[c]) for i, c, d in assign()), key=repr)


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, x, "a", "b", "c") for i, x in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in centroids.clustered(df, **how).collect()), key=repr)


def cloud(n, dim, seed):
    rng = random.Random(seed)
    centres = [[rng.uniform(-4, 4) for _ in range(dim)] for _ in range(5)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        out.append((i, [float(np.float32(v + rng.gauss(0, 0.5))) for v in c]))
    return out


def test_clusters_match_brute_force(spark):
    rows = cloud(300, 8, 3)
    assert run(spark, rows, k=5, dim=8) == brute(rows, 5, 8)


def test_odd_vectors_ties_and_repeats(spark):
    rows = cloud(40, 4, 5)
    rows += [(100, None), (101, []), (102, [1.0, 2.0]), (103, [1.0, None, 2.0, 3.0]),
             (104, [float("nan")] * 4), (105, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.0] * 4),
             (None, [0.5] * 4), (106, [1.0, 0.0, 0.0, 0.0]), (107, [-1.0, 0.0, 0.0, 0.0])]
    rows += [(7, rows[7][1])] * 30 + [(200 + i, [0.25] * 4) for i in range(30)]
    assert run(spark, rows, k=6, dim=4) == brute(rows, 6, 4)


def test_fewer_vectors_than_clusters_and_empty_table(spark):
    rows = cloud(3, 4, 9)
    assert run(spark, rows, k=16, dim=4) == brute(rows, 16, 4)
    assert run(spark, [], k=16, dim=4) == []
    assert run(spark, [(1, None)], k=16, dim=4) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32((i * 7919 % 13) * 1e5)), float(i), 0.0, 1e30 if i == 5 else 1.0])
            for i in range(12)]
    assert run(spark, rows, k=3, dim=4) == brute(rows, 3, 4, clip=centroids.clip_at(4))


def test_only_expired_vectors_are_measured(spark):
    rows = cloud(2000, 16, 11)
    df = spark.createDataFrame([(i, x, "a", "b", "c") for i, x in rows], SCHEMA)
    found = centroids.fit(df, k=5, dim=16, rounds=5)
    assert found.popped[0] > 0 and sum(found.popped) < 5 * len(rows) / 2
    assert found.popped[-1] < len(rows) / 10
    assert found.heaps.agg({"n": "sum"}).first()[0] == len(rows)


@pytest.mark.parametrize("seed", range(4))
def test_bounds_never_expire_late(seed):
    """A vector above the drift keeps its nearest centroid, whatever the moves."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-300, 300, (400, 6))
    c = rng.integers(-300, 300, (7, 6))
    own, gaps = centroids.nearest(x, c)
    drift = np.zeros(7)
    for _ in range(4):
        new = c + rng.integers(-25, 25, c.shape)
        drift, c = drift + centroids.drifts(c, new), new
        now = centroids.nearest(x, c)[0]
        still = gaps > drift[own]
        assert (now[still] == own[still]).all()
        assert (now == centroids.squared(x, c).argmin(1)).all()


def test_heaps_are_sorted_and_bounded():
    heaps = centroids.Heaps(2)
    rng = np.random.default_rng(0)
    n = centroids.BLOCK + 100
    heaps.spread(np.zeros(n, int), np.array([str(i) for i in range(n)], object), rng.random(n),
                 rng.integers(-9, 9, (n, 3)))
    rows = list(heaps.rows())
    rows += list(heaps.rows(True))
    assert [r["n"] for r in rows] == [centroids.BLOCK, 100]
    for r in rows:
        ids, keys, vectors = centroids.opened(r, 3)
        assert (np.diff(keys) >= 0).all() and vectors.sum(0).tolist() == r["sums"]
