"""Quality scores by histogram gradient-boosted trees over document statistics.

Statistics are computed in Arrow batches from whole texts. Trees are grown
level by level on binned statistics: the gradient sums of all (node,
statistic, bin) cells come from one counting pass per level. Every tree is
complete, so a model is three arrays (statistic, cut and leaf value by tree
and node), and a batch of documents walks all trees with array lookups.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, labelled_sample

#: Bound of the model: labelled documents used for fitting.
MAX_ROWS = 20_000
TREES, DEPTH, BINS = 80, 4, 64
RATE, RIDGE, MIN_WEIGHT = 0.2, 1.0, 2.0

STATISTICS = ["log_words", "word_length", "longest_word", "upper", "digits", "marks", "symbols",
              "bars", "shouts", "stops", "commas", "outside_ascii", "line_words", "dup_lines",
              "distinct_words", "doubled_words", "single_letters"]


def _bytes_of(chars: str) -> list[int]:
    return [ord(c) for c in chars]


SYMBOLS = _bytes_of("#*$%&|<>")
MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]


def statistics(text: str | None) -> list[float]:
    """STATISTICS of one text; zeros for null and for texts without a word."""
    words = (text or "").split()
    n = len(words)
    if n == 0:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    c = np.bincount(raw, minlength=256)
    chars = len(text)
    lengths = list(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    letters = max(1, int(c[65:91].sum() + c[97:123].sum()))
    return [
        float(np.log1p(n)), sum(lengths) / n, float(min(200, max(lengths))),
        c[65:91].sum() / letters, c[48:58].sum() / chars, c[MARKS].sum() / n,
        c[SYMBOLS].sum() / n, c[ord("|")] / n, c[ord("!")] / n, c[ord(".")] / n, c[ord(",")] / n,
        c[128:].sum() / len(raw), n / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        len(set(words)) / n, sum(map(eq, words, words[1:])) / n, lengths.count(1) / n,
    ]


def matrix(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(-1, len(STATISTICS))


@dataclass
class Trees:
    """Complete trees in arrays: node k's children are 2k + 1 and 2k + 2.

    ``feature`` and ``cut``: trees x inner nodes; ``leaf``: trees x leaves.
    """
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds per row; rows and trees walk down together."""
        inner = self.feature.shape[1]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        tree = np.arange(len(self.feature))
        row = np.arange(len(x))[:, None]
        for _ in range((inner + 1).bit_length() - 1):
            right = x[row, self.feature[tree, node]] > self.cut[tree, node]
            node = 2 * node + 1 + right
        return self.start + self.leaf[tree, node - inner].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def grow(x: np.ndarray, y: np.ndarray, *, trees: int = TREES, depth: int = DEPTH,
         bins: int = BINS, rate: float = RATE) -> Trees:
    """Boost ``trees`` trees on the logistic loss."""
    n, m = x.shape
    inner, leaves = 2 ** depth - 1, 2 ** depth
    feature = np.zeros((trees, inner), np.int64)
    cut = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    rate_1 = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(rate_1 / (1 - rate_1)))
    if n == 0 or y.min() == y.max():
        return Trees(feature[:0], cut[:0], leaf[:0], start)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
             for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    margin = np.full(n, start)
    columns = np.arange(m) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)  # within the level
        for level in range(depth):
            width = 2 ** level
            cell = (node[:, None] * (m * bins) + columns + binned).ravel()
            shape = (width, m, bins)
            sums = [np.bincount(cell, np.repeat(v, m), width * m * bins).reshape(shape).cumsum(2)
                    for v in (g, h)]
            (gl, hl), (ga, ha) = sums, (s[:, :, -1:] for s in sums)
            gain = gl ** 2 / (hl + RIDGE) + (ga - gl) ** 2 / (ha - hl + RIDGE) \
                - ga ** 2 / (ha + RIDGE)
            gain[(hl < MIN_WEIGHT) | (ha - hl < MIN_WEIGHT)] = 0
            flat = gain.reshape(width, -1)
            best = flat.argmax(1)
            best_feature, best_bin = best // bins, best % bins
            split = flat[np.arange(width), best] > 1e-9
            at = np.arange(width) + width - 1
            feature[t, at] = np.where(split, best_feature, 0)
            cut[t, at] = [edges[j][b] if s and b < len(edges[j]) else np.inf
                          for j, b, s in zip(best_feature, best_bin, split)]
            right = x[np.arange(n), feature[t, at[node]]] > cut[t, at[node]]
            node = 2 * node + right
        weight = np.bincount(node, h, leaves)
        leaf[t] = -rate * np.bincount(node, g, leaves) / (weight + RIDGE)
        margin += leaf[t, node]
    return Trees(feature, cut, leaf, start)


def fit(docs: DataFrame, labels: DataFrame, eligible: Column, *, label: str = "quality",
        max_rows: int = MAX_ROWS) -> Trees:
    """Trees from about ``max_rows`` labelled documents (see ``labelled_sample``).

    Statistics are computed in Spark tasks; the driver receives numbers only.
    """
    bounded_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, eligible, max_rows, "quality-sample")

    def rows(batches):
        for b in batches:
            yield pd.DataFrame(matrix(b["text"]), columns=STATISTICS).assign(
                y=b["label"].to_numpy(float))

    found = sample.select("text", "label").mapInPandas(
        rows, ", ".join(f"{s} double" for s in STATISTICS) + ", y double").toPandas()
    found = found.sort_values(list(found.columns))  # the same model for any row order
    return grow(found[STATISTICS].to_numpy(float), found["y"].to_numpy(float))


def score(docs: DataFrame, trees: Trees, *, threshold: float = 0.3, text: str = "text",
          keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``score`` (probability of label 1) and ``predicted`` per row.

    Null texts and texts without a word have zero statistics and are scored
    like any other; a model fitted on no rows or on one label only scores
    its rate for every text. Rows come back one for one, repeated ones and
    null ids included; other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(trees)
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    n_keep = len(keep)

    def batches(it):
        for b in it:
            p = shared.value.score(matrix(b.column(n_keep).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(n_keep)]
                + [pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))],
                names=[*keep, "score", "predicted"])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(batches, schema)
