import itertools
import math

import numpy as np
from corpus_helpers import SMALL, sentence

from tidewater.llm import language_id as L
from tidewater.llm.queries import PIECES, op3_language_id

PIECE_LIST = ["a", "ab", "abc", "b", "bc", "c", L.SPACE, L.SPACE + "a", L.SPACE + "ab"]


def by_enumeration(word, prob, unknown):
    """Sum over all ways to cut the word."""
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for k, c in enumerate([*cuts, 1], 1):
            if c:
                parts.append(word[at:k])
                at = k
        p = 1.0
        for x in parts:
            p *= prob.get(x, unknown if len(x) == 1 else 0.0)
        total += p
    return total


def test_forward_sums_all_segmentations():
    lattice, rnd = L.Lattice(PIECE_LIST), np.random.default_rng(1)
    prob = rnd.random((lattice.size, 3)) / 10
    words = ["▁abc", "▁abcabc", "▁cab", "abz", "z", "▁", "▁aabbccabcab"]
    got = L.word_scores(lattice, prob, words)
    for k in range(3):
        table = {p: prob[i, k] for i, p in enumerate(PIECE_LIST)}
        want = [math.log(by_enumeration(w, table, prob[-1, k])) for w in words]
        assert np.allclose(got[:, k], want)


def test_long_words_do_not_underflow():
    lattice = L.Lattice(PIECE_LIST)
    prob = np.full((lattice.size, 2), 1e-6)
    prob[:, 1] = 1e-9
    got = L.word_scores(lattice, prob, ["z" * 5000, "▁z"])
    assert np.allclose(got[0], [5000 * math.log(1e-6), 5000 * math.log(1e-9)])


def test_expected_counts_are_those_of_the_segmentations():
    lattice, rnd = L.Lattice(PIECE_LIST), np.random.default_rng(2)
    prob = rnd.random((lattice.size, 1)) / 5
    word, h = "▁abcab", 1e-6
    got = L.expected_counts(lattice, prob, [word, "▁"], [3, 0])
    for i in range(lattice.size):  # p x the derivative of log P
        more = prob.copy()
        more[i] *= 1 + h
        slope = (L.word_scores(lattice, more, [word]) - L.word_scores(lattice, prob, [word])) / h
        assert abs(got[i] - 3 * slope[0, 0]) < 1e-3


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = [r for r in op3_language_id(spark, SMALL).collect() if r.held_out]
    assert got and sum(r.lang_pred == docs[r.doc_id] for r in got) >= 0.95 * len(got)


def test_edge_rows_and_unlabelled_tables(make_docs, edge_rows):
    rows = [(i, t, lang) for i, t in edge_rows for lang in ("en",)] + [
        (30 + k, "тест слово " * 3 + sentence(k, 3), "xx") for k in range(5)] + [
        (50, sentence(4, 30), None), (51, "слово " * 4000, None)]
    docs = make_docs(rows)
    model = L.fit(docs, PIECES)
    assert model.languages == ["en", "xx"]
    got = {r.doc_id: r for r in L.identify(docs, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 8)] == ["und"] * 4 and got[1].score == 0
    assert got[50].lang_pred == "en" and got[51].lang_pred == "xx"
    assert all(0 <= r.score <= 1 for r in got.values())
    assert L.identify(docs, model).count() == len(rows)
    assert L.identify(docs.limit(0), model).count() == 0
    none = L.fit(docs.where("lang IS NULL"), PIECES)
    assert {r.lang_pred for r in L.identify(docs, none).collect()} == {"und"}
