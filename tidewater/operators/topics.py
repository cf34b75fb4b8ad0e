"""Topic models whose weights are a table (L6-L9): for vocabularies the driver cannot hold.

Variational Bayes as in Spark's online LDA (its rates, priors and stop), over every document
in each pass. Documents lie in blocks and terms in chunks of bounded size. In a pass a block
is sent the rows of its own terms, infers its documents and sends sums back by chunk, so no
task and no driver holds a matrix of the whole vocabulary; the driver holds numbers by topic.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import bounded_batches, shared_dir, written

#: Tokens of a block of documents and terms of a chunk of the vocabulary, about.
BLOCK_TOKENS, CHUNK_TERMS = 1_000_000, 32_768
# Fixed values of Spark's LDA: the rate of pass t is (OFFSET + t) ** -DECAY; first weights
# come from a gamma distribution of this shape and mean 1; a document stops at this change.
OFFSET, DECAY, SHAPE, CHANGE = 1024, 0.51, 100.0, 1e-3


def _raised(x, start, low):
    """x >= 6 with what ``low`` sums up on the way there."""
    x, total = np.array(x, float), start
    for _ in range(6):
        small = x < 6
        total = total + np.where(small, low(np.where(small, x, 1.0)), 0)
        x = np.where(small, x + 1, x)
    return x, total


def digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of ``log_gamma`` (x > 0): raised to 6 and more, then its series."""
    x, low = _raised(x, 0.0, lambda v: -1 / v)
    i = 1 / (x * x)
    return low + np.log(x) - 0.5 / x - i * (1 / 12 - i * (1 / 120 - i * (1 / 252 - i * (
        1 / 240 - i * (1 / 132)))))


def trigamma(x: np.ndarray) -> np.ndarray:
    """The derivative of ``digamma`` (x > 0), by the same way."""
    x, low = _raised(x, 0.0, lambda v: 1 / (v * v))
    i = 1 / (x * x)
    return low + 1 / x + i / 2 + i / x * (1 / 6 - i * (1 / 30 - i * (1 / 42 - i * (1 / 30))))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function (x > 0), by the same way."""
    x, low = _raised(x, 0.0, lambda v: -np.log(v))
    i = 1 / (x * x)
    return low + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + (
        1 / 12 - i * (1 / 360 - i * (1 / 1260 - i * (1 / 1680)))) / x


def infer(weights: np.ndarray, words: np.ndarray, counts: np.ndarray, sizes: np.ndarray,
          alpha: np.ndarray, gamma: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """``gamma`` (documents x topics), the exponential of its expected logarithms, and the
    norm of every word, as Spark's LDA infers documents. ``weights`` are the exponentials of
    the terms' expected logarithms; ``sizes`` (above 0) deals words to documents. ``gamma``,
    if given, is where documents begin.

    Spark repeats a step that climbs the bound until a document changes by CHANGE at most,
    often after hundreds of steps. Here Newton's steps (curvature taken by its size, so that
    they climb) come to the same stop; one that lowers the bound gives way to a plain step.
    """
    k = len(alpha)
    rows = [np.ascontiguousarray(weights[:, j], dtype=float)[words] for j in range(k)]
    if gamma is None:
        starts = np.cumsum(sizes) - sizes
        gamma = alpha + (np.add.reduceat(counts, starts) / k)[:, None]
    found, active = np.array(gamma, float), np.arange(len(sizes))
    e, c, s, g = rows, counts, sizes, found.copy()

    def norms(e, s, g):
        theta = np.exp(digamma(g) - digamma(g.sum(1))[:, None])
        phi = np.full(s.sum(), 1e-100)
        for j in range(k):
            phi += e[j] * np.repeat(theta[:, j], s)
        return theta, phi

    height, plain, reach = np.full(len(s), -np.inf), g, np.ones(len(s))
    while len(active):
        theta, phi = norms(e, s, g)
        r, starts = c / phi, np.cumsum(s) - s
        fits = [x * r for x in e]
        new = alpha + theta * np.stack([np.add.reduceat(x, starts) for x in fits], 1)
        off = np.abs(new - g).mean(1)
        bound = np.add.reduceat(c * np.log(phi), starts) + (
            (alpha - g) * np.log(theta) + log_gamma(g)).sum(1) - log_gamma(g.sum(1))
        fell = bound < height - 1e-10 * np.abs(height)
        open_ = fell | (off > CHANGE)
        plain, height = np.where(fell[:, None], plain, new), np.where(fell, height, bound)
        if open_.any():
            # the derivative of a step, in the scale that makes it symmetric
            root = np.sqrt(trigamma(g))
            m = np.empty((len(g), k, k))
            for j in range(k):
                fit = fits[j] / phi
                for i in range(j + 1):
                    m[:, i, j] = m[:, j, i] = np.add.reduceat(e[i] * fit, starts) * (
                        theta[:, i] * root[:, i] * theta[:, j] * root[:, j])
                m[:, j, j] -= (new[:, j] - alpha[j]) * root[:, j] ** 2 - 1
            value, vector = np.linalg.eigh(m)
            y = np.einsum("nij,ni->nj", vector, root * (new - g)) / np.maximum(
                np.abs(value), 1e-4)
            way = np.einsum("nij,nj->ni", vector, y) / root
            reach = np.where(fell, reach / 4, np.minimum(1, reach * 2))
            # towards a prior's edge, nine tenths of the way at most
            most = np.where(way < 0, 0.9 * (g - alpha) / np.maximum(-way, 1e-300), np.inf).min(1)
            new = np.where((fell | (most <= 0))[:, None], plain,
                           g + np.minimum(reach, most)[:, None] * way)
        g = np.where(open_[:, None], new, g)
        if open_.mean() < 0.7:
            found[active[~open_]] = g[~open_]
            words_open = np.repeat(open_, s)
            e, c, s = [x[words_open] for x in e], c[words_open], s[open_]
            g, active = g[open_], active[open_]
            height, plain, reach = height[open_], plain[open_], reach[open_]
    theta, phi = norms(rows, sizes, found)
    return found, theta, phi


@dataclass
class TopicCorpus:
    """``blocks`` (block, words, counts, sizes) of documents; ``places`` (chunk, block, place,
    pos): where a block's terms stand in the vocabulary; ``chunks`` (chunk, terms) of it, and
    its number of ``terms``; ``count`` of the blocks."""
    blocks: DataFrame
    places: DataFrame
    chunks: DataFrame
    terms: int
    count: int


def _block(key: int, lists: list):
    """A block row and the rows of its terms."""
    col = pa.chunked_array(lists).combine_chunks()
    sizes = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    coded = col.flatten().dictionary_encode()
    codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    n = max(1, len(coded.dictionary))
    row = np.repeat(np.arange(len(sizes)), sizes)
    pairs, counts = np.unique((row * n + codes)[codes >= 0], return_counts=True)
    filled = np.bincount(pairs // n, minlength=len(sizes))
    names = ["block", "term", "place", "words", "counts", "sizes"]
    if len(pairs):
        data = [(pairs % n), counts, filled[filled > 0]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([key]), pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()),
             *[pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in data]], names=names)
        for at in range(0, len(coded.dictionary), 1 << 14):
            some = coded.dictionary.slice(at, 1 << 14)
            m = len(some)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, key)), some, pa.array(np.arange(at, at + m), pa.int32()),
                 *[pa.nulls(m, pa.binary())] * 3], names=names)


def topic_corpus(df: DataFrame, tokens: str = "tokens", chunks: DataFrame | None = None,
                 terms: int = 0) -> TopicCorpus:
    """The documents of ``df`` in blocks, against their own vocabulary or that of ``chunks``
    (whose ``terms`` are counted); documents without terms and null terms are left out."""
    bounded_batches(df.sparkSession)

    def dealt(batches):
        task, n, lists, held = TaskContext.get().partitionId(), 0, [], 0
        for b in batches:
            lists.append(b.column(0))
            held += len(lists[-1].flatten())
            if held >= BLOCK_TOKENS:
                yield from _block((task << 32) + n, lists)
                n, lists, held = n + 1, [], 0
        if lists:
            yield from _block((task << 32) + n, lists)

    dealt_out = written(df.select(tokens).mapInArrow(
        dealt, "block long, term string, place int, words binary, counts binary, sizes binary"),
        "topic-blocks")
    blocks = dealt_out.where("words IS NOT NULL").select("block", "words", "counts", "sizes")
    held = dealt_out.where("words IS NULL").select("block", "term", "place")
    if chunks is None:
        known = written(held.select("term").distinct(), "topic-vocabulary")
        terms = known.count()
        n = max(1, -(-terms // CHUNK_TERMS))
        chunks = written(known.groupBy(F.pmod(F.xxhash64("term"), F.lit(n)).cast("int").alias(
            "chunk")).agg(F.array_sort(F.collect_list("term")).alias("terms")), "topic-chunks")
    at = chunks.select("chunk", F.posexplode("terms").alias("pos", "term"))

    def packed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[
                pa.array([np.asarray(x.values, np.int32).tobytes() for x in b.column(c)],
                         pa.binary()) for c in (2, 3)]], names=["chunk", "block", "place", "pos"])

    z = F.collect_list(F.struct("place", "pos"))
    places = written(held.join(at, "term").groupBy("chunk", "block").agg(z.alias("z")).select(
        "chunk", "block", "z.place", "z.pos").mapInArrow(
        packed, "chunk int, block long, place binary, pos binary"), "topic-places")
    return TopicCorpus(blocks, places, chunks, terms, blocks.count())


def _ints(x) -> np.ndarray:
    return np.frombuffer(x.as_py(), np.int32)


def _floats(x, k: int, kind=np.float32) -> np.ndarray:
    return np.frombuffer(x.as_py(), kind).reshape(-1, k)


#: Weights of chunks (chunk 0 and up), and what blocks have found (chunk below 0).
STATE = "chunk int, block long, w binary, sums array<double>"


def _state(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
        (pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.float64())))],
        names=["chunk", "block", "w", "sums"])


def _passed(corpus: TopicCorpus, state: DataFrame, alpha: np.ndarray, totals: np.ndarray,
            first: bool) -> DataFrame:
    """What the blocks find with the weights of ``state``: rows (chunk, block, pos, w) for the
    chunks, and one below chunk 0 for the block with its gamma and, as sums, the expected
    logarithms by topic, documents, bound and words."""
    k = len(alpha)
    logs = digamma(totals)

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = np.exp(digamma(_floats(right["w"][0], k, float)) - logs).astype(np.float32)
        return left.select(["block", "chunk", "place", "pos"]).append_column("w", pa.array(
            [rows[_ints(p)].tobytes() for p in left["pos"]], pa.binary()))

    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        block = left["block"][0].as_py()
        words, counts, sizes = (_ints(left[c][0]) for c in ("words", "counts", "sizes"))
        right = right.sort_by("chunk")
        gamma, asked, weights = None, [], np.full((words.max() + 1, k), np.nan)
        for chunk, place, pos, w in zip(*(right[c] for c in ("chunk", "place", "pos", "w"))):
            if chunk.as_py() < 0:
                gamma = _floats(w, k, float)
            else:
                place = _ints(place)
                weights[place] = _floats(w, k)
                asked.append((chunk.as_py(), place, pos.as_py()))
        row = np.repeat(np.arange(len(sizes)), sizes)
        known = ~np.isnan(weights[words, 0])
        words, counts = words[known], counts[known].astype(float)
        sizes = np.bincount(row[known], minlength=len(sizes))
        sizes = sizes[sizes > 0]
        if not len(words):
            return pa.table([[], [], [], [], []], schema=found)
        gamma, theta, phi = infer(weights, words, counts, sizes, alpha, gamma)
        expected = digamma(gamma) - digamma(gamma.sum(1))[:, None]
        bound = (counts * np.log(phi)).sum() + (
            ((alpha - gamma) * expected + log_gamma(gamma) - log_gamma(alpha)).sum(1)
            + log_gamma(alpha.sum()) - log_gamma(gamma.sum(1))).sum()
        r = counts / phi
        stat = np.stack([np.bincount(words, r * np.repeat(theta[:, j], sizes), len(weights))
                         for j in range(k)], 1).astype(np.float32)
        rows = [(c, block, p, stat[at].tobytes(), None) for c, at, p in asked]
        rows.append((-1 - block % 4096, block, None, gamma.tobytes(),
                     [*expected.sum(0), float(len(sizes)), float(bound), counts.sum()]))
        return pa.Table.from_pylist([dict(zip(found.names, r)) for r in rows], schema=found)

    found = pa.schema([("chunk", pa.int32()), ("block", pa.int64()), ("pos", pa.binary()),
                       ("w", pa.binary()), ("sums", pa.list_(pa.float64()))])
    weights = state.where("chunk >= 0").select("chunk", "w")
    sent = corpus.places.groupBy("chunk").cogroup(weights.groupBy("chunk")).applyInArrow(
        gather, "block long, chunk int, place binary, pos binary, w binary")
    if not first:
        none = F.lit(None).cast("binary")
        sent = sent.unionByName(state.where("chunk < 0").select(
            "block", "chunk", none.alias("place"), none.alias("pos"), "w"))
    # a task for each block, about: its work is not in its bytes
    parts = corpus.blocks.repartition(max(1, corpus.count), "block")
    return parts.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(
        step, "chunk int, block long, pos binary, w binary, sums array<double>")


class _Tables:
    """States written under the shared folder; all but the last are deleted."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path = spark, None

    def put(self, df: DataFrame) -> DataFrame:
        old, self.path = self.path, shared_dir(self.spark, f"topic-state-{uuid.uuid4().hex}")
        df.write.parquet(self.path)
        if old:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(old)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
            # lets go of the shuffles of finished passes
            self.spark._jvm.System.gc()
        return self.spark.read.schema(STATE).parquet(self.path)


def _sums(state: DataFrame, of_blocks: bool) -> np.ndarray:
    """Their sum, over the chunks (by topic) or over the blocks; in a fixed order."""
    rows = state.where("chunk < 0" if of_blocks else "chunk >= 0").select(
        "chunk", "block", "sums").collect()
    return np.sum([r["sums"] for r in sorted(rows, key=lambda r: (r["chunk"], r["block"] or 0))], 0)


def _updated(k: int, rate: float, logs: np.ndarray):
    """The next weights of a chunk, from what the blocks found; rows of blocks pass."""
    def update(key, left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = key[0].as_py()
        if chunk < 0:
            return left.select(["chunk", "block", "w", "sums"])
        w = _floats(right["w"][0], k, float)
        stat = np.zeros(w.shape)
        left = left.sort_by("block")
        for pos, part in zip(left["pos"], left["w"]):
            stat[_ints(pos)] += _floats(part, k)
        w = (1 - rate) * w + rate * (stat * np.exp(digamma(w) - logs) + 1.0 / k)
        return _state([(chunk, None, w.tobytes(), w.sum(0))])

    return update


@dataclass
class TopicTable:
    """A fitted model: ``state`` holds its weights by chunk, ``alpha`` the prior of documents."""
    corpus: TopicCorpus
    state: DataFrame
    alpha: np.ndarray
    source: DataFrame
    tokens: str

    @property
    def k(self) -> int:
        return len(self.alpha)

    def terms(self, n: int) -> DataFrame:
        """``topic``, ``rank``, ``weight``, ``term`` of the n best terms of each topic."""
        k, totals = self.k, _sums(self.state, False)

        def best(batches):
            for b in batches:
                for terms, w in zip(*b.columns):
                    w = _floats(w, k, float) / totals
                    for j in range(k):
                        at = np.lexsort((np.arange(len(w)), -w[:, j]))[:n]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), j), pa.int32()), pa.array(w[at, j]),
                             terms.values.take(pa.array(at))], names=["topic", "weight", "term"])

        rows = self.corpus.chunks.join(self.state.where("chunk >= 0").select("chunk", "w").hint(
            "merge"), "chunk").select("terms", "w").mapInArrow(
            best, "topic int, weight double, term string")
        order = Window.partitionBy("topic").orderBy(F.desc("weight"), "term")
        return rows.withColumn("rank", F.row_number().over(order) - 1).where(
            F.col("rank") < n).select("topic", "rank", "weight", "term")

    def log_perplexity(self, df: DataFrame) -> float:
        """The bound of ``LDAModel.logPerplexity`` over the documents of ``df``."""
        k, eta, totals = self.k, 1.0 / self.k, _sums(self.state, False)
        corpus = self.corpus if df is self.source else topic_corpus(
            df, self.tokens, self.corpus.chunks, self.corpus.terms)
        logs = digamma(totals)

        def scored(batches):
            for b in batches:
                for w in b.column(0):
                    w = _floats(w, k, float)
                    part = ((eta - w) * (digamma(w) - logs) + log_gamma(w) - log_gamma(eta)).sum()
                    yield pa.RecordBatch.from_arrays([pa.array([float(part)])], names=["part"])

        parts = self.state.where("chunk >= 0").select("w").mapInArrow(scored, "part double")
        topics = parts.agg(F.sum("part")).first()[0] + (
            log_gamma(eta * self.corpus.terms) - log_gamma(totals)).sum()
        found = written(_passed(corpus, self.state, self.alpha, totals, corpus is not self.corpus)
                        .where("chunk < 0").select("chunk", "block", "sums"), "topic-bounds")
        *_, bound, words = _sums(found, True)
        return float(-(bound + topics) / words)


def fit_topic_table(df: DataFrame, corpus: TopicCorpus, k: int, passes: int = 10, seed: int = 42,
                    tokens: str = "tokens") -> TopicTable:
    """``passes`` over all blocks of ``corpus``, the documents of ``df``."""
    tables, alpha = _Tables(df.sparkSession), np.full(k, 1.0 / k)

    def drawn(batches):
        for b in batches:
            for chunk, size in zip(*(c.to_pylist() for c in b.columns)):
                w = np.random.default_rng([seed, chunk]).gamma(SHAPE, 1 / SHAPE, (size, k))
                yield from _state([(chunk, None, w.tobytes(), w.sum(0))]).to_batches()

    state = tables.put(corpus.chunks.select("chunk", F.size("terms")).mapInArrow(drawn, STATE))
    for t in range(1, passes + 1):
        totals, rate = _sums(state, False), math.pow(OFFSET + t, -DECAY)
        found = _passed(corpus, state, alpha, totals, t == 1)
        weights = state.where("chunk >= 0").select("chunk", "w")
        state = tables.put(found.groupBy("chunk").cogroup(weights.groupBy("chunk")).applyInArrow(
            _updated(k, rate, digamma(totals)), STATE))
        sums = _sums(state, True)
        expected, n = sums[:k], sums[k]
        slope = n * (digamma(alpha.sum()) - digamma(alpha) + expected / n)
        c, q = n * trigamma(alpha.sum()), -n * trigamma(alpha)
        b = (slope / q).sum() / (1 / c + (1 / q).sum())
        new = alpha - rate * (slope - b) / q
        alpha = new if (new > 0).all() else alpha
    return TopicTable(corpus, state, alpha, df, tokens)
