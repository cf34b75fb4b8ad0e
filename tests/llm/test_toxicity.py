import math
from collections import Counter

import numpy as np
from corpus_helpers import SMALL, sentence
from pyspark.sql import functions as F

from tidewater.llm import toxicity as X
from tidewater.llm.queries import op8_toxicity


def random_vectors(n, rnd):
    out = []
    for _ in range(n):
        t = np.sort(rnd.choice(40, rnd.integers(1, 6), replace=False))
        w = rnd.random(len(t)) + 0.1
        out.append((t, w / np.sqrt((w * w).sum())))
    return out + out[:30]  # equal vectors tie


def test_search_is_exact():
    rnd = np.random.default_rng(7)
    vectors = random_vectors(700, rnd)
    dense = np.zeros((len(vectors), 40))
    for k, (t, w) in enumerate(vectors):
        dense[k, t] = w
    index = X.BlockMaxIndex(vectors)
    for t, w in random_vectors(60, rnd):
        q = np.zeros(40)
        q[t] = w
        cosine = np.round(dense @ q, 9)
        for k, out in ((1, -1), (15, 3), (2000, -1)):
            want = [r for r in np.lexsort((np.arange(len(cosine)), -cosine))
                    if cosine[r] > 0 and r != out][:k]
            rows, value = index.search(t, w, k, out)
            assert rows.tolist() == want and np.allclose(value, cosine[want])


def test_many_queries_at_once_give_the_same():
    rnd = np.random.default_rng(8)
    index = X.BlockMaxIndex(random_vectors(300, rnd))
    queries = random_vectors(50, rnd)
    for (at, cosine), q in zip(index.search_all(queries, 9), queries):
        one = index.search(*q, 9)
        assert at.tolist() == one[0].tolist() and np.allclose(cosine, one[1])


def brute(examples, texts, k):
    """Score and evidence of every text from all cosines; ``examples``: (id, text, label)."""
    bags = [(i, Counter(X.terms_of(t)), y) for i, t, y in
            sorted(examples, key=lambda e: (e[0], sorted(set(X.terms_of(e[1])))))]
    n_1 = sum(y for _, _, y in bags)
    n, n_0 = len(bags), len(bags) - n_1
    has = {1: Counter(), 0: Counter()}
    for _, c, y in bags:
        has[y].update(c.keys())

    def weight(t):
        a, b = has[1][t], has[0][t]
        if not a + b:
            return X.FLOOR * math.log1p(n)
        contrast = abs(math.log((a + X.SMOOTHING * n_1 / n) / n_1)
                       - math.log((b + X.SMOOTHING * n_0 / n) / n_0))
        return math.log1p(n / (a + b)) * (X.FLOOR + contrast)

    def unit(c):
        v = {t: (1 + math.log(m)) * weight(t) for t, m in c.items()}
        norm = math.sqrt(sum(w * w for w in v.values()))
        return {t: w / norm for t, w in v.items()}

    units = [unit(c) for _, c, _ in bags]

    def near(v, out=None):
        cosines = [(-round(sum(w * u.get(t, 0.0) for t, w in v.items()), 9), r)
                   for r, u in enumerate(units) if r != out]
        return [(r, -c) for c, r in sorted(cosines) if c < 0][:k]

    def vote(found):
        return sum(c * bags[r][2] for r, c in found) / sum(c for _, c in found)

    curve = [(vote(f), bags[r][2]) for r, v in enumerate(units) if (f := near(v, r))]
    knots, value = X.isotonic(np.array([x for x, _ in curve]), np.array([y for _, y in curve], float))
    out = []
    for t in texts:
        found = near(unit(Counter(X.terms_of(t))))
        p = float(np.interp(vote(found), knots, value)) if found else (n_1 + .5) / (n + 1)
        out.append((p, [(bags[r][0], c, bags[r][2]) for r, c in found]))
    return out


def test_fit_and_score_match_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    known = [(r.doc_id, rows[r.doc_id], r.toxic) for r in labels.collect()]
    model = X.fit(docs, labels, F.lit(True))
    assert sorted(model.ids.tolist()) == sorted(i for i, _, _ in known)
    got = {r.doc_id: r for r in X.score(docs, model).collect()}
    ids = sorted(rows)
    for i, (p, evidence) in zip(ids, brute(known, [rows[i] for i in ids], X.NEIGHBOURS)):
        assert abs(got[i].score - p) < 1e-6
        assert np.allclose([e.cosine for e in got[i].evidence], [c for _, c, _ in evidence])
        assert [(e.doc_id, e.label) for e in got[i].evidence] == [(j, y) for j, _, y in evidence]
        words = set(X.terms_of(rows[i]))
        assert bool(evidence) == any(words & set(X.terms_of(t)) for _, t, _ in known)


def test_isotonic_curve_rises_and_pools():
    x = np.array([0.1, 0.2, 0.2, 0.3, 0.4])
    knots, value = X.isotonic(x, np.array([0, 1, 0, 0, 1.0]))
    assert knots.tolist() == [0.1, 0.2, 0.3, 0.4] and (np.diff(value) >= 0).all()
    assert value[1] == value[2]


def test_held_out_labels(spark):
    sf = SMALL.replace("0.001", "0.01")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in op8_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    flagged = [r for r in got if r.predicted]
    assert flagged and all(labels[r.doc_id] for r in flagged)
    assert len(flagged) >= 0.6 * sum(labels[r.doc_id] for r in got)
    assert all(e is not None for r in flagged for e in r.evidence)


def test_edge_rows(spark, make_docs, edge_rows):
    rows = edge_rows + [(100 + k, sentence(k, 30) + (" vile" if k % 3 == 0 else ""))
                        for k in range(60)]
    docs = make_docs(rows)
    labels = spark.createDataFrame(
        [(100 + k, int(k % 3 == 0)) for k in range(60)] + [(None, 1), (5, None), (100, 1)],
        "doc_id long, toxic int")
    model = X.fit(docs, labels, F.lit(True))
    got = X.score(docs, model)
    assert got.count() == len(rows)
    by = {r.doc_id: r for r in got.collect()}
    assert by[103].predicted == 1 and by[104].predicted == 0 and by[1].evidence == []
    assert all(y.label == 1 for y in by[103].evidence)
    empty = X.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in X.score(docs, empty).collect()} == {0.5}
    assert X.score(docs.limit(0), model).count() == 0
