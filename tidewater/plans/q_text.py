"""Queries of the text operators over ``documents`` and the review view."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import views
from ..functions import text as tx
from ..functions.scalar import sentiment_label
from ..functions.stopwords import ENGLISH
from ..operators import textops as to
from ..session import written
from . import sqltext as sq
from .registry import register


def docs(spark, d):
    return views.documents(spark, d).select("doc_id", "text")


def _one(name, fn, sqlfn):
    @register(name, sql=f"SELECT doc_id, {sqlfn('text')} AS out FROM documents")
    def q(spark, d):
        return docs(spark, d).select("doc_id", fn("text").alias("out"))
    return q


_one("S9_to_lower", tx.to_lower, sq.lower)
_one("S10_strip_marks", tx.strip_marks, sq.strip_marks)
_one("S11_strip_punctuation", tx.strip_punctuation, sq.strip_punctuation)
_one("S12_strip_accents", tx.strip_accents, sq.strip_accents)
_one("S13_strip_non_ascii", tx.strip_non_ascii, sq.strip_non_ascii)
_one("S14_digits_to_space", tx.digits_to_space, sq.digits_to_space)
_one("S15_squeeze_spaces", tx.squeeze_spaces, sq.squeeze_spaces)
_one("S16_clean_text", tx.clean_text, sq.clean_text)
_one("S25_strip_links", tx.strip_links, sq.strip_links)


@register("S16_clean_text_pages_with_links", sql=f"""
    SELECT page_id, {sq.clean_text('html', links=True)} AS out FROM pages""")
def q_s16b(spark, d):
    p = views.table(spark, d, "pages")
    return p.select("page_id", tx.clean_text("html", links=True).alias("out"))


@register("S17_tokenize", sql=f"""
    SELECT doc_id, CAST(len(string_split(c, ' ')) AS INTEGER) AS n_tokens,
           CAST(len(list_distinct(string_split(c, ' '))) AS INTEGER) AS n_distinct,
           list_sort(list_distinct(string_split(c, ' '))) AS token_set
    FROM (SELECT doc_id, {sq.clean_text('text')} AS c FROM documents)""")
def q_s17(spark, d):
    c = docs(spark, d).select("doc_id", tx.clean_text("text").alias("c"))
    return c.select("doc_id", F.size(tx.tokenize("c")).alias("n_tokens"),
                    F.size(tx.token_set("c")).alias("n_distinct"),
                    F.array_sort(tx.token_set("c")).alias("token_set"))


def _stop_sql():
    return "[" + ", ".join(sq.q(w) for w in ENGLISH) + "]"


@register("S18_remove_stopwords", sql=f"""
    SELECT doc_id, array_to_string(list_filter(string_split(c, ' '),
                   lambda t: NOT list_contains({_stop_sql()}, t)), ' ') AS out
    FROM (SELECT doc_id, {sq.clean_text('text')} AS c FROM documents)""")
def q_s18(spark, d):
    c = docs(spark, d).select("doc_id", tx.clean_text("text").alias("c"))
    return c.select("doc_id", F.array_join(to.remove_stopwords(tx.tokenize("c")), " ").alias("out"))


NAMES = {"en": "english", "de": "german", "fr": "french", "es": "spanish"}


def in_languages(spark, d):
    """Documents with the name of their language."""
    name = F.lit(None).cast("string")
    for code, long in NAMES.items():
        name = F.when(F.col("lang") == code, long).otherwise(name)
    return views.documents(spark, d).select("doc_id", "text", name.alias("language"))


@register("S19_vocabulary_stems")
def q_s19(spark, d):
    """The distinct words of the languages that have rules, with their stems."""
    c = in_languages(spark, d).select("language", tx.tokenize(tx.clean_text("text")).alias("tokens"))
    parts = [to.vocabulary_stems(c.where(F.col("language") == name), "tokens", name).withColumn(
        "language", F.lit(name)) for name in sorted(to.LANGUAGES)]
    return parts[0].unionByName(parts[1])


@register("S20_text_transformations")
def q_s20(spark, d):
    return to.text_transformations(in_languages(spark, d), "text", F.col("language"),
                                   keep=("doc_id", "text_clean")).select(
        "doc_id", "text_clean", "standardized_text")


@register("S20_text_transformations_keep_stopwords")
def q_s20b(spark, d):
    return to.text_transformations(in_languages(spark, d), "text", F.col("language"),
                                   stop=False, keep=("doc_id",))


@register("S21_sentiment_label", sql="""
    SELECT doc_id, CASE WHEN overall < 3 THEN 0 WHEN overall IS NOT NULL THEN 1 END AS sentiment
    FROM reviews""")
def q_s21(spark, d):
    r = views.reviews(spark, d)
    return r.select("doc_id", sentiment_label("overall").alias("sentiment"))


@register("A21_word_freq_raw", sql="""
    SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    WHERE word <> '' GROUP BY 1 ORDER BY count DESC, word LIMIT 50""")
def q_a21(spark, d):
    return to.word_freq(docs(spark, d), "text", 50)


@register("A21_word_freq_clean", sql=f"""
    SELECT word, count(*) AS count FROM (SELECT unnest(string_split({sq.clean_text('text')}, ' ')) AS word
                                         FROM documents)
    WHERE word <> '' GROUP BY 1 ORDER BY count DESC, word LIMIT 50""")
def q_a21b(spark, d):
    c = docs(spark, d).select(tx.clean_text("text").alias("c"))
    return to.word_freq(c, "c", 50)


def _ngrams_sql(tok: str, n: int) -> str:
    parts = " || ' ' || ".join(f"{tok}[i + {k}]" for k in range(n))
    return (f"CASE WHEN len({tok}) >= {n} THEN list_transform(range(1, len({tok}) - {n - 2}), "
            f"lambda i: {parts}) ELSE [] END")


@register("A27_bigram_counts", sql=f"""
    SELECT ngram, count(*) AS count FROM (
      SELECT unnest({_ngrams_sql('t', 2)}) AS ngram
      FROM (SELECT string_split({sq.clean_text('text')}, ' ') AS t FROM documents))
    GROUP BY 1 ORDER BY count DESC, ngram LIMIT 20""")
def q_a27(spark, d):
    c = docs(spark, d).select(tx.tokenize(tx.clean_text("text")).alias("t"))
    return to.ngram_counts(c, "t", 2, 20)


@register("A27_vocabulary_size", sql=f"""
    SELECT (SELECT count(DISTINCT w) FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)
            WHERE w <> '') AS before_cleaning,
           (SELECT count(DISTINCT w) FROM (SELECT unnest(string_split({sq.clean_text('text')}, ' ')) AS w
                                           FROM documents) WHERE w <> '') AS after_cleaning""")
def q_a27b(spark, d):
    dd = docs(spark, d)
    before = to.vocabulary_size(dd.select(F.split("text", " ").alias("t")), "t", "before_cleaning")
    after = to.vocabulary_size(dd.select(tx.tokenize(tx.clean_text("text")).alias("t")), "t",
                               "after_cleaning")
    return before.select(F.col("before_cleaning"), after.scalar().alias("after_cleaning"))


@register("FE8_ngram_document_frequency", sql=f"""
    WITH c AS (SELECT doc_id, list_filter(string_split({sq.clean_text('text')}, ' '),
                                          lambda t: length(t) >= 2) AS tk FROM documents),
    g AS (SELECT doc_id, list_concat({_ngrams_sql('tk', 2)}, {_ngrams_sql('tk', 3)}) AS terms FROM c),
    n AS (SELECT count(*) AS n FROM g),
    e AS (SELECT doc_id, unnest(terms) AS term FROM g),
    f AS (SELECT term, count(DISTINCT doc_id) AS df, count(*) AS total FROM e GROUP BY term)
    SELECT term, df, total, round(ln((n + 1.0) / (df + 1)), 6) AS idf FROM f, n
    WHERE df >= 3 AND df <= 0.95 * n""")
def q_fe8(spark, d):
    c = docs(spark, d).select("doc_id", tx.clean_text("text").alias("c"))
    t = to.ngram_terms(c, "c")
    out = to.document_frequency(t, "terms", min_df=3, max_df=0.95)
    return out.select("term", "df", "total", F.round("idf", 6).alias("idf"))


@register("FE8_tfidf_vectors")
def q_fe8b(spark, d):
    from ..operators.frames import train_test_split
    r = to.text_transformations(in_languages(spark, d), "text", F.col("language"),
                                keep=("doc_id",))
    # the vocabulary and the vectors read the stemmed texts, not the chain
    r = written(r, "tfidf-texts")
    train, test = train_test_split(r, 0.2, 42, "doc_id")
    _, tr, te = to.tfidf_ngrams(train, test, "standardized_text")
    return te.select("doc_id", "features")


@register("FE9_dictionary", sql=f"""
    SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS BIGINT) AS id FROM (
      SELECT DISTINCT unnest(string_split({sq.clean_text('text')}, ' ')) AS term FROM documents)
    WHERE term <> ''""")
def q_fe9(spark, d):
    c = docs(spark, d).select(tx.tokenize(tx.clean_text("text")).alias("t"))
    return to.dictionary(c, "t")


@register("FE9_doc2bow", sql=f"""
    SELECT doc_id, term, count(*) AS count FROM (
      SELECT doc_id, unnest(string_split({sq.clean_text('text')}, ' ')) AS term FROM documents)
    WHERE term <> '' GROUP BY 1, 2""")
def q_fe9b(spark, d):
    c = docs(spark, d).select("doc_id", tx.tokenize(tx.clean_text("text")).alias("t"))
    return to.doc2bow(c, "doc_id", "t")
