"""Text operators on DataFrames: stop words, stemming, n-grams, term
statistics, TF-IDF, bag of words (S18-S20, FE8, FE9, A21, A27).

Cleaning is one column expression (``functions.text.clean_text``). Token
arrays stay per row; corpus statistics explode tokens and aggregate with
partial aggregation, so a very common word costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..functions.stemmer import LANGUAGES, stemmer, stems
from ..functions.stopwords import stopwords
from ..session import bounded_batches, written
from .ranks import value_ranks

#: Languages whose stop words are dropped where a column names the language.
STOPWORD_LANGUAGES = ("english", "german", "french", "spanish")


# S18
def remove_stopwords(tokens: Column | str, language: str = "english",
                     words: Sequence[str] | None = None) -> Column:
    """Drop listed words and keep order and duplicates (``array_except``
    would deduplicate)."""
    stop = list(words if words is not None else stopwords(language))
    tok = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.filter(tok, lambda t: ~t.isin(stop))  # a hash set, not a scan of the list


# S19
def vocabulary_stems(df: DataFrame, tokens: str, language: str = "english") -> DataFrame:
    """Distinct vocabulary -> stem (``word``, ``stem``), by the rules of the language."""
    vocab = df.select(F.explode(tokens).alias("word")).distinct()
    return stems(vocab, language)


#: Words whose stems a task remembers.
KNOWN_WORDS = 200_000


def stem_tokens(df: DataFrame, tokens: str, language: str | Column = "english") -> DataFrame:
    """``df`` with the tokens of a column replaced by their stems, in place.

    ``language`` is a name, or a column of names; tokens of rows whose language has no
    rules (or is null) stay as they are. The distinct words of an Arrow batch of rows are
    stemmed once, in the task that holds the rows: nothing is shuffled, and words that
    come again are remembered. Null arrays and null tokens stay null.
    """
    lang = F.lit(language) if isinstance(language, str) else language
    if isinstance(language, str) and language not in LANGUAGES:
        raise ValueError(f"stemming rules exist for {', '.join(sorted(LANGUAGES))}")
    bounded_batches(df.sparkSession)
    at = [c.lower() for c in df.columns].index(tokens.lower())
    schema = T.StructType([T.StructField(f.name, T.ArrayType(T.StringType()) if k == at
                                         else f.dataType) for k, f in enumerate(df.schema)])

    def stemmed(batches):
        rules = {name: (stemmer(name), {}) for name in LANGUAGES}

        def stem(name: str, words: list[str]) -> list[str]:
            of, known = rules[name]
            if len(known) > KNOWN_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = of(w)
            return [known[w] for w in words]

        for b in batches:
            *columns, langs = b.columns
            lists = columns[at]
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            coded = lists.flatten().dictionary_encode()
            words, n = coded.dictionary, len(coded.dictionary)
            codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            for name in rules:
                mine = np.repeat(pc.equal(langs, name).fill_null(False).to_numpy(
                    zero_copy_only=False), sizes) & (codes >= 0) & (codes < n)
                used = np.unique(codes[mine])
                if len(used):
                    new = np.zeros(n, np.int64)
                    new[used] = len(words) + np.arange(len(used))
                    found = stem(name, coded.dictionary.take(pa.array(used)).to_pylist())
                    words = pa.concat_arrays([words, pa.array(found, words.type)])
                    codes[mine] = new[codes[mine]]
            columns[at] = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(sizes)), pa.int32()),
                words.take(pa.array(codes, mask=codes < 0)), mask=lists.is_null())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.withColumn("__lang", lang).mapInArrow(stemmed, schema)


# S20
def standardize_text(df: DataFrame, col: str, language: str | Column = "english",
                     stop: bool = True, out: str = "standardized",
                     keep: Sequence[str] | None = None) -> DataFrame:
    """Stop words (optional: the author's ablation) then stems; the
    result is joined back to text with single spaces. With a column of
    languages every row follows its own; one without a list or rules keeps its tokens.
    With ``keep`` only these columns are carried along (and written) beside the result."""
    tokens = tx.tokenize(col)
    if stop and isinstance(language, str):
        tokens = remove_stopwords(tokens, language)
    elif stop:
        plain = tokens
        for name in STOPWORD_LANGUAGES:
            tokens = F.when(language == name, remove_stopwords(plain, name)).otherwise(tokens)
    held = df.withColumn("__tokens", tokens)
    if keep is not None:
        named = F.lit(language) if isinstance(language, str) else language
        held = held.select(*keep, "__tokens", named.alias("__language"))
        language = language if isinstance(language, str) else F.col("__language")
    return stem_tokens(held, "__tokens", language).withColumn(
        out, F.array_join("__tokens", " ")).drop("__tokens", "__language")


def text_transformations(df: DataFrame, col: str, language: str | Column = "english",
                         stop: bool = True, keep: Sequence[str] | None = None) -> DataFrame:
    """The reference's text chain: clean, drop blank results, standardise."""
    cleaned = df.withColumn("text_clean", tx.clean_text(col)).filter(F.col("text_clean") != "")
    return standardize_text(cleaned, "text_clean", language, stop, "standardized_text", keep)


# A21
def word_freq(df: DataFrame, col: str, n: int = 50) -> DataFrame:
    """Most frequent whitespace tokens (ties by word)."""
    words = df.select(F.explode(F.split(F.col(col), " ")).alias("word")).filter(F.col("word") != "")
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), "word").limit(n)


# A27
def ngrams(tokens: Column | str, n: int) -> Column:
    """Space-joined n-grams of a token array (same as ``NGram``).

    The array is zipped with its ``n - 1`` shifted copies, so the work is
    linear in the text length (each token array is read ``n`` times, never
    once per element).
    """
    tok = F.col(tokens) if isinstance(tokens, str) else tokens
    m = F.size(tok) - (n - 1)
    shifted = [F.slice(tok, k + 1, F.greatest(m, F.lit(0))) for k in range(n)]
    if n == 1:
        return tok
    zipped = F.arrays_zip(*shifted)
    return F.transform(zipped, lambda z: F.concat_ws(" ", *[z[str(k)] for k in range(n)]))


#: Buckets of term hashes whose occurrences are counted before terms are.
BUCKETS = 2 ** 20


#: Bytes of counts that a task adds up before it passes them on.
HELD_BYTES = 32 << 20


def term_partials(df: DataFrame, terms: str) -> DataFrame:
    """``term``, ``df``, ``total`` of every run of rows: rows that hold the term and its
    occurrences (null terms: none). Sums over the runs are the term's counts.

    Rows come in small Arrow batches (see ``bounded_batches``); the counts of a task's
    batches are added up until they reach HELD_BYTES.
    """
    bounded_batches(df.sparkSession)

    def counted(b):
        lists = b.column(0)
        sizes = np.where(np.asarray(lists.is_null()), 0, lists.value_lengths().fill_null(
            0).to_numpy(zero_copy_only=False))
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        n = len(coded.dictionary)
        held = np.unique((np.repeat(np.arange(len(sizes)), sizes) * n + codes)[codes >= 0])
        return pa.RecordBatch.from_arrays([
            coded.dictionary,
            pa.array(np.bincount(held % n if n else held, minlength=n), pa.int64()),
            pa.array(np.bincount(codes[codes >= 0], minlength=n), pa.int64())],
            names=["term", "df", "total"])

    def added(held):
        sums = pa.Table.from_batches(held).group_by("term").aggregate(
            [("df", "sum"), ("total", "sum")]).rename_columns(["term", "df", "total"])
        yield from sums.combine_chunks().to_batches(max_chunksize=1 << 16)

    def partials(batches):
        held, size = [], 0
        for b in batches:
            held.append(counted(b))
            size += held[-1].nbytes
            if size >= HELD_BYTES:
                yield from added(held)
                held, size = [], 0
        if held:
            yield from added(held)

    return df.select(terms).mapInArrow(partials, "term string, df long, total long")


def frequent_terms(df: DataFrame, terms: str, k: int, keep: Column | None = None) -> DataFrame:
    """``term``, ``df``, ``total`` of the ``k`` terms of most occurrences (ties by term)
    among those that ``keep``, a condition on ``df`` and ``total``, admits.

    Occurrences are first counted by bucket of the term's hash; a bucket's count bounds
    that of its terms. Only terms of the fullest buckets are counted by themselves. Where
    k admitted terms reach the count of the least of these buckets, no other can precede
    them; else more buckets follow, all of them at last.
    """
    keep = F.lit(True) if keep is None else keep
    # outer: dropping null terms here would evaluate the term arrays a second time
    each = df.select(F.monotonically_increasing_id().alias("row"), terms).select(
        "row", F.explode_outer(terms).alias("term")).withColumn(
        "b", F.pmod(F.xxhash64("term"), F.lit(BUCKETS)))
    buckets = written(each.groupBy("b").agg(F.count("term").alias("c")), "term-buckets")
    for m in (4 * k, 64 * k, None):
        least = 0
        if m is not None:
            if buckets.count() <= m:
                continue
            least = buckets.orderBy(F.desc("c")).limit(m).agg(F.min("c")).first()[0]
            # BUCKETS numbers at most
            some = each.join(F.broadcast(buckets.where(F.col("c") >= least)), "b", "left_semi")
            sums = some.groupBy("row", "term").agg(F.count("term").alias("n")).groupBy("term").agg(
                F.count("term").alias("df"), F.sum("n").alias("total")).where("term IS NOT NULL")
        else:
            sums = term_partials(df, terms).groupBy("term").agg(
                F.sum("df").alias("df"), F.sum("total").alias("total"))
        counts = written(sums.where(keep), "term-counts")
        if m is None or counts.where(F.col("total") >= least).limit(k).count() == k:
            return counts.orderBy(F.desc("total"), "term").limit(k)


def ngram_counts(df: DataFrame, tokens: str, n: int, k: int | None = None) -> DataFrame:
    """Most frequent n-grams (``NGram`` transformer, then ``frequent_terms``); all of them,
    in no order, without ``k``."""
    from pyspark.ml.feature import NGram
    grams = NGram(n=n, inputCol=tokens, outputCol="ngram")
    if k:
        top = frequent_terms(grams.transform(written(df.select(tokens), "gram-tokens")), "ngram", k)
        return top.select(F.col("term").alias("ngram"), F.col("total").alias("count")).orderBy(
            F.col("count").desc(), "ngram")
    return term_partials(grams.transform(df.select(tokens)), "ngram").groupBy(
        F.col("term").alias("ngram")).agg(F.sum("total").alias("count"))


def vocabulary_size(df: DataFrame, tokens: str, name: str = "vocabulary") -> DataFrame:
    return (df.select(F.explode(tokens).alias("t")).filter(F.col("t") != "")
              .agg(F.count_distinct("t").alias(name)))


# FE8
def ngram_terms(df: DataFrame, text_col: str, ns: Sequence[int] = (2, 3),
                min_len: int = 2, out: str = "terms") -> DataFrame:
    """Whitespace tokens of at least ``min_len`` characters (sklearn's
    default token rule drops 1-letter tokens), then n-grams of each size by
    Spark's ``NGram`` transformer (JVM, linear in the text length)."""
    from pyspark.ml.feature import NGram
    tok = df.withColumn("__tok", F.filter(F.split(F.col(text_col), " "),
                                          lambda t: F.length(t) >= min_len))
    names = []
    for n in ns:
        name = f"__g{n}"
        tok = NGram(n=n, inputCol="__tok", outputCol=name).transform(tok)
        names.append(name)
    return tok.withColumn(out, F.concat(*[F.col(c) for c in names])).drop("__tok", *names)


def document_frequency(df: DataFrame, terms: str, min_df: int = 3, max_df: float = 0.95,
                       smooth_sklearn: bool = False) -> DataFrame:
    """Per term: documents containing it, total count, idf; filtered by
    ``min_df`` documents and ``max_df`` share. idf = ln((n+1)/(df+1)),
    +1 with ``smooth_sklearn`` (sklearn's smoothed idf).

    A row is a document. Terms are counted within Arrow batches of rows, in the task that
    holds them, and the counts added up by term; no text and no documents are shuffled.
    ``n`` is the row count of ``df`` (a scalar subquery that reads no text).
    """
    n = df.agg(F.count(F.lit(1))).scalar()
    return (term_partials(df, terms).groupBy("term").agg(
        F.sum("df").alias("df"), F.sum("total").alias("total"))
        .filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n))
        .withColumn("idf", F.log((n + 1) / (F.col("df") + 1))
                    + (1.0 if smooth_sklearn else 0.0)))


def fit_tfidf(train: DataFrame, terms: str, vocab_size: int = 3000, min_df: int = 3,
              max_df: float = 0.95):
    """Term counts over the ``vocab_size`` terms of most occurrences (ties by term) within
    the df limits, weights 1 + ln((n + 1) / (df + 1)), L2 normaliser, fitted on train only.
    Limits from 1 on are documents, lower ones shares of them, as for CountVectorizer."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
    from pyspark.ml.linalg import Vectors
    n = train.count()
    low, high = (x if x >= 1 else x * n for x in (min_df, max_df))
    vocab = frequent_terms(train, terms, vocab_size, F.col("df").between(low, high)).collect()
    if not vocab:
        raise ValueError("no term is within the df limits")
    # tied terms in a fixed order, so a repeated fit numbers them alike
    vocab.sort(key=lambda r: (-r["total"], r["term"]))
    cv = CountVectorizerModel.from_vocabulary([r["term"] for r in vocab], terms, "__tf")
    idf = np.log((n + 1) / (np.array([r["df"] for r in vocab]) + 1))
    weight = ElementwiseProduct(inputCol="__tf", outputCol="__tfidf",
                                scalingVec=Vectors.dense(idf + 1.0))
    norm = Normalizer(inputCol="__tfidf", outputCol="features", p=2.0)
    return PipelineModel(stages=[cv, weight, norm])


def tfidf_ngrams(train: DataFrame, test: DataFrame, text_col: str, **kw):
    """FE8: fit on train, transform both."""
    tr = ngram_terms(train, text_col)
    te = ngram_terms(test, text_col)
    model = fit_tfidf(tr, "terms", **kw)
    return model, model.transform(tr), model.transform(te)


# FE9
def dictionary(df: DataFrame, tokens: str) -> DataFrame:
    """Vocabulary with dense ids in alphabetical order (term -> id),
    numbered by the distributed rank machinery (no single-task window)."""
    terms = df.select(F.explode(tokens).alias("term")).filter(F.col("term") != "").distinct()
    r = value_ranks(terms, "term")
    return r.select(F.col("value").alias("term"), F.col("below").alias("id"))


def doc2bow(df: DataFrame, doc_id: str, tokens: str, vocab: DataFrame | None = None
            ) -> DataFrame:
    """Long-form bag of words ``(doc_id, term[, id], count)``; a row is a
    document. Tokens are counted inside the row, so nothing is shuffled
    unless ``vocab`` is joined."""
    def counted(ts):
        # in order, equal tokens stand together: counts are the steps between their starts
        starts = F.filter(F.sequence(F.lit(0), F.size(ts)), lambda i: (i == F.size(ts)) | (
            i == 0) | (F.get(ts, i) != F.get(ts, i - 1)))
        return F.get(F.transform(F.array(starts), lambda at: F.transform(
            F.slice(at, 1, F.size(at) - 1), lambda i, k: F.struct(
                F.get(ts, i).alias("term"),
                (F.get(at, k + 1) - i).cast("long").alias("count")))), F.lit(0))

    ordered = F.sort_array(F.filter(F.col(tokens), lambda t: t != ""))
    pairs = F.get(F.transform(F.array(ordered), counted), F.lit(0))
    bow = df.select(doc_id, F.inline_outer(pairs)).where(F.col("term").isNotNull())
    return bow.join(vocab, "term") if vocab is not None else bow
