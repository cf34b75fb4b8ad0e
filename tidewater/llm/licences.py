"""Licence scans: a trained paragraph classifier, confirmed by templates.

Paragraphs (lines) are described by the word n-grams that occur in licence
templates. A multinomial logistic regression, trained on altered templates
and on a bounded sample of the corpus, gives each family and the class
``unknown`` a probability, and its temperature is fitted on held-out
paragraphs. A predicted family counts once the paragraph also matches one of
the family's templates word by word.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, hash_share, written
from .licence_templates import TEMPLATES

WORD = re.compile(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*")
LONGEST_NGRAM = 3
UNKNOWN = "unknown"
#: Bounds of the training set: altered copies of a template, and corpus paragraphs.
COPIES, CORPUS_DOCS, CORPUS_PARAGRAPHS = 40, 400, 3_000
#: A corpus paragraph this similar to a template is not trained on as unknown.
LICENCE_LIKE = 0.3
#: Regularisation and passes of the regression.
RIDGE, PASSES = 1e-4, 60
#: Accept a family above this probability; confirm it from this share of matched word pairs.
ACCEPT, CONFIRM = 0.6, 0.6
SEED = 11


def words_of(paragraph: str) -> list[str]:
    return WORD.findall(paragraph.lower())


def ngrams(words: list[str], longest: int = LONGEST_NGRAM):
    for n in range(1, longest + 1):
        for i in range(len(words) - n + 1):
            yield " ".join(words[i:i + n])


def pairs_of(words: list[str]) -> set:
    return set(zip(words, words[1:])) if len(words) > 1 else {(w,) for w in words}


class Templates:
    """Families, their templates' word pairs, and the n-grams that are features."""

    def __init__(self, templates: dict[str, list[str]]):
        self.families = sorted(templates)
        self.words = {f: [words_of(t) for t in templates[f]] for f in self.families}
        self.pairs = {f: [pairs_of(w) for w in self.words[f]] for f in self.families}
        grams = sorted({g for ws in self.words.values() for w in ws for g in ngrams(w)})
        self.index = {g: i for i, g in enumerate(grams)}

    def features(self, words: list[str]) -> dict[int, float]:
        """N-grams of the templates in the paragraph, weighted by its length.

        Longer n-grams are only looked up where their words are known.
        """
        look = self.index.get
        known = [look(w) for w in words]
        hits = {i for i in known if i is not None}
        if not hits:
            return {}
        for n in range(2, LONGEST_NGRAM + 1):
            for i in range(len(words) - n + 1):
                if known[i] is not None and known[i + 1] is not None:
                    g = look(" ".join(words[i:i + n]))
                    if g is not None:
                        hits.add(g)
        weight = 1.0 / np.sqrt(len(words))
        return dict.fromkeys(hits, weight)

    def similarity(self, family: str, words: list[str]) -> float:
        """Largest share of matched word pairs with a template of the family.

        Of the template's pairs, or of the paragraph's, whichever are fewer;
        paragraphs of fewer than three words match only whole templates.
        """
        own = pairs_of(words)
        best = 0.0
        for t in self.pairs[family]:
            size = len(t) if len(words) < 3 else min(len(t), len(own))
            best = max(best, len(own & t) / max(1, size))
        return best

    def nearest(self, words: list[str]) -> float:
        return max((self.similarity(f, words) for f in self.families), default=0.0)


def altered(words: list[str], filler: list[str], rnd: random.Random) -> list[str]:
    """A copy of a template as it might stand in a text: cut, worn or amid other words."""
    out = list(words)
    if len(out) > 8 and rnd.random() < 0.5:
        keep = rnd.randint(max(5, len(out) // 2), len(out))
        at = rnd.randint(0, len(out) - keep)
        out = out[at:at + keep]
    worn = [w for w in out if len(out) < 6 or rnd.random() > 0.05]
    if filler and rnd.random() < 0.4:
        worn = rnd.choices(filler, k=rnd.randint(1, 8)) + worn
    if filler and rnd.random() < 0.4:
        worn += rnd.choices(filler, k=rnd.randint(1, 8))
    return worn


@dataclass
class LicenceModel:
    """Classes (families, then unknown), weights by n-gram, and the temperature."""
    templates: dict[str, list[str]]
    classes: list[str]
    weights: np.ndarray  # n-grams x classes
    intercept: np.ndarray
    temperature: float = 1.0
    _known: Templates | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_known": None}

    @property
    def known(self) -> Templates:
        if self._known is None:
            self._known = Templates(self.templates)
        return self._known

    def margins(self, features: dict[int, float]) -> np.ndarray:
        at = list(features)
        return self.intercept + (np.array(list(features.values())) @ self.weights[at]
                                 if at else 0.0)

    def probabilities(self, features: dict[int, float]) -> np.ndarray:
        m = self.margins(features) / self.temperature
        p = np.exp(m - m.max())
        return p / p.sum()

    def scan(self, text: str | None):
        """Paragraphs of a text, and findings (line, family, probability, similarity)."""
        lines = (text or "").split("\n")
        n, found = 0, []
        for k, line in enumerate(lines):
            words = words_of(line)
            if not words:
                continue
            n += 1
            features = self.known.features(words)
            if not features:
                continue
            p = self.probabilities(features)
            best = int(p.argmax())
            if self.classes[best] == UNKNOWN or p[best] < ACCEPT:
                continue
            family = self.classes[best]
            found.append((k, family, float(p[best]), self.known.similarity(family, words)))
        return n, found


def fit(docs: DataFrame, *, text: str = "text", templates: dict[str, list[str]] | None = None,
        corpus_docs: int = CORPUS_DOCS, corpus_paragraphs: int = CORPUS_PARAGRAPHS,
        copies: int = COPIES) -> LicenceModel:
    """Train on altered templates and a bounded sample of corpus paragraphs.

    About ``corpus_docs`` documents with an id, chosen by id hash, give at
    most ``corpus_paragraphs`` paragraphs for the class ``unknown``;
    paragraphs like a template are left out. An empty corpus leaves the
    class to fragments and shuffled words of templates alone.
    """
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    known = Templates(templates)
    rows = docs.where(F.col("doc_id").isNotNull() & F.col(text).isNotNull())
    share = min(1.0, corpus_docs / max(1, rows.count()))
    lines = written(rows.where(hash_share(F.col("doc_id"), F.lit(share))).select(
        F.explode(F.split(text, "\n")).alias("line")), "licence-paragraphs")
    line_share = min(1.0, corpus_paragraphs / max(1, lines.count()))
    corpus = [words_of(r["line"]) for r in lines.where(
        hash_share(F.col("line"), F.lit(line_share))).sort("line").collect()]
    corpus = [w for w in corpus if w and known.nearest(w) < LICENCE_LIKE]

    rnd = random.Random(SEED)
    filler = [w for ws in corpus[:500] for w in ws]
    everything = [w for ws in known.words.values() for t in ws for w in t]
    examples = [(known.families.index(f), altered(t, filler, rnd))
                for f in known.families for t in known.words[f] for _ in range(copies)]
    unknown = len(known.families)
    examples += [(unknown, w) for w in corpus]
    for _ in range(max(200, len(corpus) // 4)):  # words of licences that make no notice
        examples.append((unknown, rnd.choices(everything, k=rnd.randint(1, 12))
                         + rnd.choices(filler or everything, k=rnd.randint(0, 6))))
    rnd.shuffle(examples)
    data = [(float(y), known.features(w)) for y, w in examples]
    held = len(data) // 4
    size = len(known.index)
    frame = spark.createDataFrame(
        [(y, Vectors.sparse(size, sorted(x.items()))) for y, x in data[held:]],
        T.StructType([T.StructField("label", T.DoubleType()),
                      T.StructField("features", VectorUDT())]))
    frame = written(frame, "licence-training")
    fitted = LogisticRegression(family="multinomial", regParam=RIDGE, maxIter=PASSES).fit(frame)
    model = LicenceModel(templates, [*known.families, UNKNOWN],
                         fitted.coefficientMatrix.toArray().T.copy(),
                         fitted.interceptVector.toArray().copy())
    margins = np.array([model.margins(x) for _, x in data[:held]])
    labels = np.array([int(y) for y, _ in data[:held]])

    def loss(t):
        m = margins / t
        top = m.max(1)
        return float(np.mean(np.log(np.exp(m - top[:, None]).sum(1)) + top
                             - m[np.arange(held), labels]))

    model.temperature = min(np.exp(np.linspace(-2, 2, 41)), key=loss)
    return model


def scan(docs: DataFrame, model: LicenceModel, *, text: str = "text",
         keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``n_paragraphs`` and ``findings`` for every row's whole text.

    Paragraphs are lines with a word. A finding is a paragraph whose most
    probable class is a family, above ACCEPT: ``line`` (from 0), ``family``,
    ``probability``, ``similarity`` to the family's nearest template and
    ``confirmed`` (similarity of CONFIRM or more). Null and empty texts have
    neither. Rows come back one for one; other columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    finding = T.StructType.fromDDL("line int, family string, probability double, "
                                   "similarity double, confirmed boolean")
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_paragraphs", T.LongType()),
        T.StructField("findings", T.ArrayType(finding))])
    n_keep = len(keep)

    def batches(it):
        arrow = pa.list_(pa.struct([
            ("line", pa.int32()), ("family", pa.string()), ("probability", pa.float64()),
            ("similarity", pa.float64()), ("confirmed", pa.bool_())]))
        for b in it:
            found = [shared.value.scan(t) for t in b.column(n_keep).to_pylist()]
            rows = [[{"line": k, "family": f, "probability": p, "similarity": s,
                      "confirmed": s >= CONFIRM} for k, f, p, s in x] for _, x in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(n_keep)]
                + [pa.array([n for n, _ in found], pa.int64()), pa.array(rows, arrow)],
                names=[*keep, "n_paragraphs", "findings"])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(batches, schema)
