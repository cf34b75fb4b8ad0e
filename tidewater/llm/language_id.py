"""Language identification with segmentation-marginalised unigrams.

A language is a probability for every piece of a fixed public vocabulary.
A word's probability is the sum, over all ways to cut it into pieces, of the
product of their probabilities; the forward algorithm adds them up, and a
text's log-likelihood is the sum over its words. A space mark opens every
word and stands nowhere else in a piece, so words are independent and the
sum over a text's segmentations is the product over its words.

Probabilities are fitted by expectation maximisation: a forward-backward
pass over word counts gives expected piece counts, a Spark aggregate adds
them up, and the next pass uses the new shares.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, hash_share, written
from .sentence_pieces import SPACE, forget, vocabulary

WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
#: Expected documents per language in the fitting sample (chosen by id hash).
SAMPLE_PER_LANGUAGE = 1500
#: Passes of expectation maximisation.
PASSES = 4
#: Count added to every piece of a language.
SMOOTHING = 0.05
#: Words whose scores a worker remembers, and their longest: those it meets first, as
#: frequent words do. Other words are scored once per Arrow batch.
REMEMBERED, LONGEST_WORD = 300_000, 64
#: Cells (words x positions) of one forward pass.
CELLS = 100_000
RESCALE_EVERY, SMALL, LIFT = 8, 1e-120, 1e120


class Lattice:
    """Edges (start, end, piece) of words over a vocabulary of lower-case pieces."""

    def __init__(self, pieces):
        self.unknown = len(pieces)  # a letter that is no piece
        self.size = len(pieces) + 1
        self.lexicon = {}
        self.longest = max(map(len, pieces), default=1)
        for i, p in enumerate(pieces):
            for k in range(1, len(p)):
                self.lexicon.setdefault(p[:k], -1)
            self.lexicon[p] = i

    def edges(self, word: str):
        """Lists of starts, ends and piece ids, in order of the start."""
        look, unknown, n = self.lexicon.get, self.unknown, len(word)
        starts, ends, ids = [], [], []
        for i in range(n):
            for j in range(i + 1, min(n, i + self.longest) + 1):
                p = look(word[i:j])
                if p is None or p < 0:
                    if j == i + 1:  # every single symbol is an edge
                        starts.append(i)
                        ends.append(j)
                        ids.append(unknown)
                    if p is None:
                        break
                    continue
                starts.append(i)
                ends.append(j)
                ids.append(p)
        return starts, ends, ids


def groups(words):
    """Words by rising length, in groups of at most CELLS cells."""
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    at = 0
    while at < len(order):
        stop, longest = at, 0
        while stop < len(order):
            longest = len(words[order[stop]])
            if stop > at and (stop + 1 - at) * (longest + 1) > CELLS:
                break
            stop += 1
        yield order[at:stop]
        at = stop


def build(lattice: Lattice, words):
    """(word, start, end, piece) arrays of a group of words."""
    w, s, e, p = [], [], [], []
    for k, word in enumerate(words):
        a, b, c = lattice.edges(word)
        w.append(len(a))
        s += a
        e += b
        p += c
    return (np.repeat(np.arange(len(words)), w), np.array(s, np.int32), np.array(e, np.int32),
            np.array(p, np.int32))


def pass_over(edges, near, far, n_words, last, prob):
    """Sums over partial segmentations, from position 0 or backwards.

    Position after position (``far`` end of the edges), adds value at the
    ``near`` end x piece probability. Returns the values and the logarithms
    of the factors that were divided out, both per word, position, column.
    """
    w, p = edges
    order = np.lexsort((w, far))
    w, p, near, far = w[order], p[order], near[order], far[order]
    cols = prob.shape[1]
    value = np.zeros((n_words, last + 1, cols))
    log_out = np.zeros((n_words, cols))
    out = np.zeros((n_words, last + 1, cols))
    value[:, 0] = 1.0
    cuts = np.searchsorted(far, np.arange(last + 2))
    reach = int((far - near).max(initial=1))
    for e in range(1, last + 1):
        a, b = cuts[e], cuts[e + 1]
        if a < b:
            words = w[a:b]
            add = value[words, near[a:b]] * prob[p[a:b]]
            first = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
            value[words[first], e] = np.add.reduceat(add, first, axis=0)
        if e % RESCALE_EVERY == 0:
            since = max(0, e - reach)
            low = (value[:, e] < SMALL) & (value[:, e] > 0)
            if low.any():
                value[:, since:e + 1] *= np.where(low, LIFT, 1.0)[:, None, :]
                log_out -= np.where(low, np.log(LIFT), 0.0)
                out[:, since:e] -= np.where(low, np.log(LIFT), 0.0)[:, None, :]
        out[:, e] = log_out
    return value, out


def word_scores(lattice: Lattice, prob: np.ndarray, words) -> np.ndarray:
    """log P(word | column) for every word and column of ``prob``."""
    result = np.empty((len(words), prob.shape[1]))
    for group in groups(words):
        chosen = [words[k] for k in group]
        w, s, e, p = build(lattice, chosen)
        sizes = np.array([len(x) for x in chosen])
        value, out = pass_over((w, p), s, e, len(chosen), int(sizes.max()), prob)
        row = np.arange(len(chosen))
        result[group] = np.log(value[row, sizes]) + out[row, sizes]
    return result


def expected_counts(lattice: Lattice, prob: np.ndarray, words, counts) -> np.ndarray:
    """Expected uses of every piece (one language: ``prob`` has one column)."""
    total = np.zeros(lattice.size)
    counts = np.asarray(counts, float)
    for group in groups(words):
        chosen = [words[k] for k in group]
        w, s, e, p = build(lattice, chosen)
        sizes = np.array([len(x) for x in chosen])
        last = int(sizes.max())
        ahead, ahead_log = pass_over((w, p), s, e, len(chosen), last, prob)
        # backwards: positions are counted from the word's end
        back, back_log = pass_over((w, p), sizes[w] - e, sizes[w] - s, len(chosen), last, prob)
        row = np.arange(len(chosen))
        whole = np.log(ahead[row, sizes, 0]) + ahead_log[row, sizes, 0]
        share = (np.log(ahead[w, s, 0]) + ahead_log[w, s, 0] + np.log(prob[p, 0])
                 + np.log(back[w, sizes[w] - e, 0]) + back_log[w, sizes[w] - e, 0] - whole[w])
        total += np.bincount(p, np.exp(share) * counts[group][w], lattice.size)
    return total


def public_pieces(model_file: str) -> list[str]:
    """Lower-case letter pieces of the vocabulary, with and without the space mark."""
    found = {p.lower() for p in vocabulary(model_file).scores}
    return sorted(p for p in found if p == SPACE or WORD.fullmatch(p.removeprefix(SPACE)))


def words_of(text: str | None) -> list[str]:
    """Letter runs in lower case, each after a space mark."""
    words = []
    for w in WORD.findall((text or "").lower()):
        if w.isalpha():
            words.append(SPACE + w)
        else:  # fractions, Roman numerals and the like are no letters
            words += [SPACE + x for x in "".join(c if c.isalpha() else " " for c in w).split()]
    return words


@dataclass
class LanguageModel:
    """Languages in order of name, and log-free piece probabilities by column."""
    languages: list[str]
    pieces: list[str]
    prob: np.ndarray
    _lattice: Lattice | None = field(default=None, repr=False)
    _rows: dict = field(default_factory=dict, repr=False)
    _scores: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"languages": self.languages, "pieces": self.pieces, "prob": self.prob,
                "_lattice": None, "_rows": {}, "_scores": None}

    def likelihoods(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """log P(text | language) per text and language, and words per text."""
        if self._lattice is None:
            self._lattice = Lattice(self.pieces)
        if self._scores is None:
            self._scores = np.empty((REMEMBERED, len(self.languages)))
        once = {}  # one object per distinct word of the batch, however often it occurs
        found = [[once.setdefault(w, w) for w in words_of(t)] for t in texts]
        rows, scores = self._rows, self._scores
        new = list(dict.fromkeys(w for words in found for w in words if w not in rows))
        if new:
            values = word_scores(self._lattice, self.prob, new)
            kept = [k for k, w in enumerate(new) if len(w) <= LONGEST_WORD][
                :REMEMBERED - len(rows)]
            at = len(rows)
            scores[at:at + len(kept)] = values[kept]
            rows.update((new[k], at + j) for j, k in enumerate(kept))
            if len(kept) < len(new):  # the others are known to this batch only
                scores = np.concatenate([scores, values])
                rows = {w: REMEMBERED + k for k, w in enumerate(new)} | {
                    w: rows[w] for words in found for w in words if w in rows}
        result = np.zeros((len(texts), len(self.languages)))
        for k, words in enumerate(found):
            if words:
                result[k] = scores[list(map(rows.__getitem__, words))].sum(0)
        return result, np.array([len(w) for w in found])

    def predict(self, texts) -> tuple[list[str], np.ndarray]:
        """Best language and its posterior under equal priors, per text."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        score, n = self.likelihoods(texts)
        share = np.exp(score - score.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        best = share.argmax(1)
        return ([self.languages[b] if k else UNDETERMINED for b, k in zip(best, n)],
                np.where(n > 0, share.max(1), 0.0))


def fit(labelled: DataFrame, model_file: str, *, text: str = "text", lang: str = "lang",
        key: str = "doc_id", sample_per_language: int = SAMPLE_PER_LANGUAGE,
        passes: int = PASSES) -> LanguageModel:
    """Fit on a bounded sample of labelled rows.

    Rows with a null language, key or text are left out. From each language
    about ``sample_per_language`` rows are taken, chosen by key hash
    (all, where there are no more). The driver receives one probability per
    language and piece of the vocabulary, never rows of the corpus.
    """
    spark = labelled.sparkSession
    bounded_batches(spark)
    rows = labelled.select(F.col(key).alias("key"), F.col(lang).alias("lang"),
                           F.col(text).alias("text")).where(
        F.col("lang").isNotNull() & F.col("key").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages, pieces = sorted(sizes), public_pieces(model_file)
    if not languages:
        return LanguageModel([], pieces, np.zeros((len(pieces) + 1, 0)))
    share = F.create_map(*[F.lit(x) for name in languages
                           for x in (name, min(1.0, sample_per_language / sizes[name]))])
    sample = rows.where(hash_share(F.col("key"), share[F.col("lang")]))

    def count_words(batches):
        forget()
        for b in batches:
            found = {}
            for name, t in zip(b["lang"], b["text"]):
                found.setdefault(name, Counter()).update(words_of(t))
            for name, c in found.items():
                yield pd.DataFrame({"lang": name, "word": list(c), "n": list(c.values())})

    words = written(sample.select("lang", "text").mapInPandas(
        count_words, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n")), "language-words")
    column = {name: k for k, name in enumerate(languages)}
    size = len(pieces) + 1
    prob = np.full((size, len(languages)), 1.0 / size)
    spark_context = spark.sparkContext
    for _ in range(passes):
        model = spark_context.broadcast((pieces, prob))

        def expect(batches, model=model):
            forget()
            known, prob = model.value
            lattice = Lattice(known)
            total = {}
            for b in batches:
                for name, part in b.groupby("lang"):
                    c = expected_counts(lattice, prob[:, [column[name]]], list(part["word"]),
                                        part["n"])
                    total[name] = total.get(name, 0) + c
            for name, c in total.items():
                used = np.flatnonzero(c)
                yield pd.DataFrame({"lang": name, "piece": used, "c": c[used]})

        counts = words.mapInPandas(expect, "lang string, piece int, c double").groupBy(
            "lang", "piece").agg(F.sum("c").alias("c")).toPandas()
        prob = np.full((size, len(languages)), SMOOTHING)
        prob[counts["piece"], counts["lang"].map(column)] += counts["c"]
        prob /= prob.sum(0)
        model.destroy()
    return LanguageModel(languages, pieces, prob)


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text",
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` for every row's whole text.

    ``lang_pred`` is the language with the largest likelihood (the first by
    name among equals) and ``score`` its posterior; a text that is null or
    has no letter is ``und`` with score 0, as is every text under a model
    without languages. Rows come back one for one, repeated ones and null
    ids included; other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    n_keep = len(keep)

    def batches(it):
        forget()
        for b in it:
            lang, score = shared.value.predict(b.column(n_keep).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(n_keep)] + [pa.array(lang, pa.string()),
                                                        pa.array(score, pa.float64())],
                names=[*keep, "lang_pred", "score"])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(batches, schema)
