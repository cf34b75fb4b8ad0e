"""Toxicity scores from the nearest labelled examples.

Every text is the unit vector of the TF-IDF weights of all its words, and the
examples with the largest cosines to it are its neighbours. A word's weight is
(1 + log tf) idf contrast; idf comes from document counts among the examples, and the
contrast grows with the difference between the word's rates in the two labels
(the absolute logarithm of their smoothed ratio). A floor keeps words that both labels
use alike in the vector.

The search is exact and runs on an inverted index with block maxima. Examples are
stored in blocks. A rare word has a list of postings; a common one has a column of
weights and, per block, the largest of them. The rare words' products are added up from
their postings, the common words' are bounded per block by the block maxima; blocks are
opened by falling bound, and those whose bound stays below the k-th best cosine are not
opened at all.

Neighbours vote with their cosine as weight, and an isotonic curve fitted to
leave-one-out votes turns votes into probabilities.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, labelled_sample

WORD = re.compile(r"[^\W\d_]+")
#: Labelled examples of the model, chosen by id hash (in expectation).
MAX_EXAMPLES = 3_000
#: Least contrast of a word, and examples that its rates are smoothed by.
FLOOR, SMOOTHING = 0.02, 10.0
NEIGHBOURS = 15
BLOCK = 64
#: A word is common if more than one in so many examples has it.
COMMON = 16


def terms_of(text: str | None) -> list[str]:
    """Words in lower case."""
    return WORD.findall((text or "").lower())


class BlockMaxIndex:
    """Sparse unit vectors in blocks: postings of rare terms, block maxima of common ones.

    ``vectors``: (rising term ids, weights) per example, weights not negative.
    Examples are stored in order of their heaviest term, so that a block holds
    similar vectors and its bounds are tight; results name examples by their given
    position.
    """

    def __init__(self, vectors):
        heaviest = [int(t[np.argmax(w)]) if len(t) else -1 for t, w in vectors]
        self.order = np.array(sorted(range(len(vectors)), key=lambda k: (heaviest[k], k)), np.int64)
        self.n, self.place = len(vectors), {int(x): row for row, x in enumerate(self.order)}
        self.n_blocks = -(-self.n // BLOCK)
        sorted_vectors = [vectors[k] for k in self.order]
        rows = np.repeat(np.arange(self.n), [len(t) for t, _ in sorted_vectors])
        terms = np.concatenate([t for t, _ in sorted_vectors] or [np.empty(0, np.int64)])
        weights = np.concatenate([w for _, w in sorted_vectors] or [np.empty(0)])
        n_terms = int(terms.max()) + 1 if len(terms) else 0
        often = np.flatnonzero(np.bincount(terms, minlength=n_terms) * COMMON > self.n)
        #: column of a common term, -1 for a rare one
        self.column = np.full(n_terms, -1)
        self.column[often] = np.arange(len(often))
        common = self.column[terms] >= 0 if n_terms else np.empty(0, bool)
        self.dense = np.zeros((self.n_blocks * BLOCK, len(often)))
        self.dense[rows[common], self.column[terms[common]]] = weights[common]
        self.largest = self.dense.reshape(self.n_blocks, BLOCK, len(often)).max(
            1, initial=0.0)
        terms, rows, weights = terms[~common], rows[~common], weights[~common]
        by_term = np.argsort(terms, kind="stable")
        self.rows, self.weights = rows[by_term], weights[by_term]
        self.cut = np.searchsorted(terms[by_term], np.arange(n_terms + 1))

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, leave_out: int = -1):
        """Positions and cosines of the k nearest with a positive cosine.

        Falling cosine, then rising position among equals.
        """
        return self.search_all([(terms, weights)], k, [leave_out])[0]

    def search_all(self, queries, k: int, leave_out=None) -> list:
        """``search`` of several vectors; a block is opened for all that need it at once."""
        width = self.n_blocks * BLOCK
        if k < 1 or not width:
            return [(np.empty(0, np.int64), np.empty(0)) for _ in queries]
        q = np.zeros((len(queries), self.dense.shape[1]))
        score = np.zeros((len(queries), width))
        for i, (terms, weights) in enumerate(queries):
            there = terms < len(self.column)
            terms, weights = terms[there], weights[there]
            columns = self.column[terms]
            rare = columns < 0
            q[i, columns[~rare]] = weights[~rare]
            starts, ends = self.cut[terms[rare]], self.cut[terms[rare] + 1]
            postings = expand(starts, ends)
            score[i] = np.bincount(self.rows[postings], np.repeat(weights[rare], ends - starts)
                                   * self.weights[postings], width)
        bound = score.reshape(len(queries), self.n_blocks, BLOCK).max(2) + q @ self.largest.T
        whole = np.zeros((len(queries), width))

        def open_blocks(wanted):
            for b in np.flatnonzero(wanted.any(0)):
                rows, at = slice(b * BLOCK, (b + 1) * BLOCK), np.flatnonzero(wanted[:, b])
                whole[at, rows] = np.round(score[at, rows] + q[at] @ self.dense[rows].T, 9)
            return wanted

        opened = min(self.n_blocks, 1 + k // BLOCK)
        first = np.zeros(bound.shape, bool)
        np.put_along_axis(first, np.argpartition(-bound, opened - 1, 1)[:, :opened], True, 1)
        open_blocks(first)
        # the example left out does not count towards the k-th best
        out = [self.place.get(x, -1) for x in leave_out or []]
        for i, row in enumerate(out):
            if row >= 0:
                whole[i, row] = 0.0
        least = np.partition(whole, width - k, 1)[:, width - k] if k <= width else np.zeros(
            len(queries))
        open_blocks((bound >= least[:, None] - 1e-8) & (bound > 0) & ~first)
        found = []
        for i, values in enumerate(whole):
            if i < len(out) and out[i] >= 0:
                values[out[i]] = 0.0
            edge = np.partition(values, width - k)[width - k] if k <= width else 0.0
            rows = np.flatnonzero((values >= edge) & (values > 0))  # ties included
            at = self.order[rows]
            best = np.lexsort((at, -values[rows]))[:k]
            found.append((at[best], values[rows][best]))
        return found


def expand(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def isotonic(x, y):
    """Knots (x, value) of the rising step means of y by x."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order]
    knots, first = np.unique(x, return_index=True)
    pools = []
    for k, (a, b) in enumerate(zip(first, np.append(first[1:], len(x)))):
        pools.append([y[a:b].sum(), b - a, k, k])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            s, n, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + n, pools[-1][2], last]
    value = np.empty(len(knots))
    for s, n, a, b in pools:
        value[a:b + 1] = (s + 0.5) / (n + 1)  # never quite 0 or 1
    return knots, np.maximum.accumulate(value)


@dataclass
class ToxicityModel:
    """Words with their weights, labelled examples, their index, and the curve of votes.

    A word that no example has weighs ``unseen``: it lengthens a text's vector.
    """
    terms: dict
    weight: np.ndarray
    unseen: float
    ids: np.ndarray
    labels: np.ndarray
    base_rate: float
    neighbours: int = NEIGHBOURS
    curve: tuple | None = None
    index: BlockMaxIndex | None = None

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Rising ids and weights of the words that examples have; the whole text has length 1."""
        return self.unit(Counter(terms_of(text)))

    def unit(self, counts: dict) -> tuple[np.ndarray, np.ndarray]:
        look = self.terms.get
        t = np.array([look(w, -1) for w in counts], np.int64)
        n = 1 + np.log(np.fromiter(counts.values(), float, len(counts)))
        w = n * np.where(t >= 0, self.weight[t], self.unseen) if len(self.weight) else n
        norm = np.sqrt((w * w).sum())
        known = t >= 0
        t, w = t[known], w[known] / (norm if norm > 0 else 1.0)
        order = np.argsort(t)
        return t[order], w[order]

    def vote(self, rows, cosines) -> float:
        return float((cosines * self.labels[rows]).sum() / cosines.sum())

    def calibrate(self, vectors) -> None:
        """Fit the curve to the votes that each example gets from the others."""
        votes, labels = [], []
        for at in range(0, len(vectors), BLOCK):
            part = range(at, min(at + BLOCK, len(vectors)))
            for k, near in zip(part, self.index.search_all([vectors[k] for k in part],
                                                           self.neighbours, list(part))):
                if len(near[0]):
                    votes.append(self.vote(*near))
                    labels.append(self.labels[k])
        if votes:
            self.curve = isotonic(np.array(votes), np.array(labels, float))

    def score(self, texts: list) -> list:
        """Probability of the label, and positions and cosines of the neighbours, of every text."""
        found = []
        for at in range(0, len(texts), BLOCK):
            part = texts[at:at + BLOCK]
            near = [(np.empty(0, np.int64), np.empty(0))] * len(part) if self.curve is None else \
                self.index.search_all([self.vector(t) for t in part], self.neighbours)
            found += [(float(np.interp(self.vote(*n), *self.curve)) if len(n[0])
                       else self.base_rate, *n) for n in near]
        return found


def word_weights(has_1, has_0, n_1: int, n_0: int):
    """idf times contrast of words from the numbers of examples of either label with them."""
    n = n_1 + n_0
    rate_1 = (has_1 + SMOOTHING * n_1 / n) / max(n_1, 1)
    rate_0 = (has_0 + SMOOTHING * n_0 / n) / max(n_0, 1)
    contrast = np.abs(np.log(np.maximum(rate_1, 1e-12) / np.maximum(rate_0, 1e-12)))
    return np.log1p(n / np.maximum(1.0, has_1 + has_0)) * (FLOOR + contrast)


def fit(docs: DataFrame, labels: DataFrame, eligible: Column, *, label: str = "toxic",
        max_examples: int = MAX_EXAMPLES, neighbours: int = NEIGHBOURS) -> ToxicityModel:
    """Model from about ``max_examples`` labelled documents (see ``labelled_sample``).

    Every one of them is in the index with all its words. The driver receives the word
    counts of these documents; their number is the bound of the model.
    """
    bounded_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, eligible, max_examples, "toxicity-sample")

    def count_words(batches):
        for b in batches:
            found = [Counter(terms_of(t)) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "label": b["label"],
                                "words": [list(c) for c in found],
                                "n": [list(c.values()) for c in found]})

    examples = sample.mapInPandas(count_words, T.StructType(
        [docs.schema["doc_id"]] + T.StructType.fromDDL(
            "label int, words array<string>, n array<long>").fields)).toArrow().to_pylist()
    # repeated ids are ordered by their words, so that a repeated run gives the same model
    examples.sort(key=lambda e: (e["doc_id"], sorted(e["words"])))
    y = np.array([e["label"] > 0 for e in examples], float)
    n_1, n_0 = int(y.sum()), int(len(y) - y.sum())
    has = {0: Counter(), 1: Counter()}
    for e in examples:
        has[int(e["label"] > 0)].update(e["words"])
    terms = {t: k for k, t in enumerate(sorted(has[0].keys() | has[1].keys()))}
    counted = [np.array([has[v][t] for t in terms], float) for v in (1, 0)]
    model = ToxicityModel(
        terms, word_weights(*counted, n_1, n_0) if terms else np.empty(0),
        float(np.log1p(len(y)) * FLOOR), np.array([e["doc_id"] for e in examples]), y,
        (n_1 + 0.5) / (len(y) + 1), neighbours)
    vectors = [model.unit(dict(zip(e["words"], e["n"]))) for e in examples]
    model.index = BlockMaxIndex(vectors)
    model.calibrate(vectors)
    return model


def score(docs: DataFrame, model: ToxicityModel, *, threshold: float = 0.7, text: str = "text",
          keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``score``, ``predicted`` and ``evidence`` for every row's whole text.

    ``evidence``: the nearest examples (id, cosine, label), nearest first. Null and
    empty texts, and texts that share no word with an example, get the rate among the
    examples and no evidence; without labelled rows every score is 0.5. Rows come back
    one for one; other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType if "doc_id" in docs.columns else T.LongType()
    evidence = T.ArrayType(T.StructType([
        T.StructField("doc_id", id_type), T.StructField("cosine", T.DoubleType()),
        T.StructField("label", T.IntegerType())]))
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        T.StructField("evidence", evidence)])
    n_keep = len(keep)

    def batches(it):
        model = shared.value
        for b in it:
            texts = b.column(n_keep).to_pylist()
            known = list(dict.fromkeys(texts))
            known = dict(zip(known, model.score(known)))
            found = [known[t] for t in texts]
            p = np.array([f[0] for f in found])
            rows = np.concatenate([f[1] for f in found]).astype(np.int64)
            near = pa.StructArray.from_arrays(
                [pa.array(model.ids[rows] if len(model.ids) else [], pa.string() if isinstance(
                    id_type, T.StringType) else pa.int64()),
                 pa.array(np.concatenate([f[2] for f in found]), pa.float64()),
                 pa.array(model.labels[rows] if len(model.ids) else []).cast(pa.int32())],
                names=["doc_id", "cosine", "label"])
            cuts = pa.array(np.cumsum([0] + [len(f[1]) for f in found]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(n_keep)]
                + [pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32)),
                   pa.ListArray.from_arrays(cuts, near)],
                names=[*keep, "score", "predicted", "evidence"])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(batches, schema)
