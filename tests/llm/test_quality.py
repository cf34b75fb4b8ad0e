import re
from collections import Counter

import numpy as np
from corpus_helpers import SMALL, sentence
from pyspark.sql import functions as F

from tidewater.llm import quality_rules as R
from tidewater.llm import quality_trees as Q
from tidewater.llm.queries import op6_quality

SPACES = " \t\n\x0b\x0c\r"


def brute(text):
    words = [w for w in re.split(f"[{SPACES}]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(SPACES)]
    wins = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    n, inside = Counter(wins), set()
    for k, w in enumerate(wins):
        if n[w] > 1:
            inside.update(range(k, k + 5))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(inside))


MORE = [(40, "a b c d e " * 3), (41, "a b c d e f g a b c d e f h"), (42, "x x x x x x"),
        (43, "same\nsame\n \n \nsame again"), (44, "## | <b> $5 & 100%"), (45, "😀😀 é\x1cq\x85w")]


def test_measures_against_brute_force(make_docs, edge_rows):
    rows = edge_rows + MORE
    got = R.measure(make_docs(rows)).collect()
    assert sorted(((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                    r.n_repeat_words) for r in got)) == sorted(
        (str(i), *brute(t)) for i, t in rows)


def test_groups_with_few_documents_use_wider_thresholds(make_docs, monkeypatch):
    rows = [(k, sentence(k, 40), "en", "big") for k in range(80)]
    rows += [(200 + k, sentence(k, 40) + " ###" * 12, "en", "small") for k in range(5)]
    rows += [(300 + k, sentence(k, 40), None, None) for k in range(3)]
    rows += [(400, None, "en", "big"), (401, sentence(1, 12) + " ||||||" * 12, "en", "big")]
    kept = {r.doc_id: r.kept for r in R.judge(make_docs(rows)).collect()}
    assert all(kept[k] for k in range(80)) and all(kept[300 + k] for k in range(3))
    assert not any(kept[200 + k] for k in range(5)) and not kept[400] and not kept[401]
    monkeypatch.setattr(R, "BROADCAST_GROUPS", -1)
    again = {r.doc_id: r.kept for r in R.judge(make_docs(rows)).collect()}
    assert again == kept


def test_rules_on_edge_rows_and_empty_table(make_docs, edge_rows):
    got = R.judge(make_docs(edge_rows))
    assert got.count() == len(edge_rows)
    assert R.judge(make_docs(edge_rows).limit(0)).count() == 0


def test_trees_walk_like_nested_tests():
    rnd = np.random.default_rng(3)
    x = rnd.random((400, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    trees = Q.grow(x, y, trees=30)

    def walk(row):
        total = trees.start
        for f, c, leaf in zip(trees.feature, trees.cut, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > c[node])
            total += leaf[node - len(f)]
        return total

    assert np.allclose(trees.margin(x[:50]), [walk(r) for r in x[:50]])
    assert ((trees.score(x) > 0.5) == y).mean() > 0.95
    one = Q.grow(x, np.ones(400))
    assert np.allclose(one.score(x), 400.5 / 401)
    assert np.allclose(Q.grow(x[:0], y[:0]).score(x), 0.5)


def test_quality_of_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in
              spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    got = [r for r in op6_quality(spark, SMALL).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in got) >= 0.85 * len(got)


def test_trees_on_edge_rows(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows)
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 0), (6, 0, 0), (8, None, 0), (None, 1, 0),
                                    (99, 1, 1)], "doc_id long, quality int, toxic int")
    trees = Q.fit(docs, labels, F.lit(True))
    got = Q.score(docs, trees)
    assert got.count() == len(edge_rows)
    assert all(0 <= r.score <= 1 for r in got.collect())
    nothing = Q.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in Q.score(docs, nothing).collect()} == {0.5}
