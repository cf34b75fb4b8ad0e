"""Text cleaning, stop words, stemming, n-grams."""

import pytest
from pyspark.sql import functions as F

from core_helpers import SF_SMALL
from tidewater import views
from tidewater.functions import text as tx
from tidewater.functions.stemmer import stems
from tidewater.operators import frames as fr
from tidewater.operators import textops as to
from tidewater.plans import q_text


def test_clean_text_chain(spark):
    df = spark.createDataFrame([("It's GREAT!!! Café 4 ever❤ über_cool, naïve",), (None,), ("",)],
                               "t string")
    got = [r[0] for r in df.select(tx.clean_text("t")).collect()]
    assert got == ["its great cafe ever ubercool naive", "", ""]


def test_strip_punctuation_keeps_underscore_only_after_marks(spark):
    df = spark.createDataFrame([("a_b-c",)], "t string")
    assert df.select(tx.strip_punctuation("t")).first()[0] == "abc"


def test_remove_stopwords_keeps_duplicates(spark):
    df = spark.createDataFrame([(["the", "cat", "and", "the", "cat", "dont"],)], "t array<string>")
    assert df.select(to.remove_stopwords("t")).first()[0] == ["cat", "cat", "dont"]


ENGLISH = [
    ("running", "run"), ("caresses", "caress"), ("ponies", "poni"), ("generously", "generous"),
    ("communication", "communic"), ("hopefulness", "hope"), ("skies", "sky"), ("news", "news"),
    ("relational", "relat"), ("knackeries", "knackeri"), ("tied", "tie"), ("ties", "tie"),
    ("cries", "cri"), ("gas", "gas"), ("gaps", "gap"), ("luxuriated", "luxuri"), ("hopping", "hop"),
    ("hoped", "hope"), ("by", "by"), ("say", "say"), ("cry", "cri"), ("consistency", "consist"),
    ("consolatory", "consolatori"), ("knightly", "knight"), ("kneeled", "kneel")]
GERMAN = [
    ("aufeinanderbiss", "aufeinanderbiss"), ("aufeinanderfolge", "aufeinanderfolg"),
    ("aufeinanderfolgenden", "aufeinanderfolg"), ("aufeinanderfolgt", "aufeinanderfolgt"),
    ("aufeinanderschlügen", "aufeinanderschlug"), ("kategorien", "kategori"),
    ("kategorisch", "kategor"), ("kategorischer", "kategor"), ("kater", "kat"),
    ("katers", "kat"), ("katze", "katz"), ("kätzchen", "katzch")]


@pytest.mark.parametrize("language,pairs", [("english", ENGLISH), ("german", GERMAN)])
def test_stems_of_published_words(spark, language, pairs):
    df = spark.createDataFrame(pairs, "word string, want string")
    got = stems(df, language).collect()
    assert {r.word: r.stem for r in got} == dict(pairs)


def test_english_rules_equal_the_word_by_word_stemmer(spark):
    from porter_words import stem
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = docs.select(F.explode(tx.tokenize(tx.clean_text("text"))).alias("word")).distinct()
    got = stems(words, "english").collect()
    wrong = [(r.word, r.stem, stem(r.word)) for r in got if r.stem != stem(r.word)]
    assert len(got) > 10_000 and wrong == []


def test_stem_tokens_by_language_and_in_place(spark):
    df = spark.createDataFrame(
        [(1, ["running", "cats", "running"], "english"), (2, None, "english"), (3, [], "german"),
         (4, ["katers", "running"], "german"), (5, ["running"], "klingon"), (6, ["cats"], None)],
        "id long, t array<string>, lang string")
    got = to.stem_tokens(df, "t", F.col("lang"))
    assert got.columns == ["id", "t", "lang"]
    assert {r.id: r.t for r in got.collect()} == {
        1: ["run", "cat", "run"], 2: None, 3: [], 4: ["kat", "running"], 5: ["running"],
        6: ["cats"]}
    assert "Python" not in got._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        to.stem_tokens(df, "t", "klingon")


def test_standardize_text_by_language(spark):
    df = spark.createDataFrame([(1, "the running cats", "english"), (2, "die katzen und the", "german")],
                               "id long, c string, lang string")
    got = to.standardize_text(df, "c", F.col("lang"), out="s")
    assert {r.id: r.s for r in got.collect()} == {1: "run cat", 2: "katz the"}


def test_ngrams_linear(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],), (["a"],)], "t array<string>")
    r = df.select(to.ngrams("t", 2).alias("g2"), to.ngrams("t", 3).alias("g3")).collect()
    assert r[0].g2 == ["a b", "b c", "c d"] and r[0].g3 == ["a b c", "b c d"]
    assert r[1].g2 == [] and r[1].g3 == []


def test_dictionary_dense_ids(spark):
    df = spark.createDataFrame([(["b", "a", "c", "a"],), (["d", "b"],)], "t array<string>")
    got = sorted((r.term, r.id) for r in to.dictionary(df, "t").collect())
    assert got == [("a", 0), ("b", 1), ("c", 2), ("d", 3)]


def test_text_chain_queries_take_unlabelled_documents(spark):
    texts = views.documents(spark, SF_SMALL).where(tx.clean_text("text") != "").select("doc_id")
    want = {r.doc_id for r in texts.collect()}
    labelled = {r.doc_id for r in views.table(spark, SF_SMALL, "labels").collect()}
    assert want - labelled
    for query in (q_text.q_s20, q_text.q_s20b):
        assert {r.doc_id for r in query(spark, SF_SMALL).select("doc_id").collect()} == want
    test = fr.train_test_split(texts, 0.2, 42, "doc_id")[1]
    assert {r.doc_id for r in q_text.q_fe8b(spark, SF_SMALL).select("doc_id").collect()} == {
        r.doc_id for r in test.collect()}
