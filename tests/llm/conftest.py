import pytest
from corpus_helpers import sentence
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use for their own columns
    T.StructField("n_words", T.StringType()), T.StructField("key", T.IntegerType()),
    T.StructField("score", T.StringType()), T.StructField("kept", T.StringType()),
    T.StructField("pos", T.IntegerType()), T.StructField("label", T.IntegerType())])

@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows of (doc_id, text[, lang, source]) as a table with extra, clashing columns."""
    def make(rows):
        full = []
        for r in rows:
            i, text, lang, source = (*r, "en", "s")[:4] if len(r) == 2 else (*r, "s")[:4]
            full.append((i, text, lang, source, None if text is None else len(text),
                         "x", 7, "y", "z", 3, 9))
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Null and empty texts, white space only, one word, a long text, repeats, a null id."""
    long_text = "\n".join(sentence(k, 60) for k in range(300))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, long_text), (6, sentence(1, 40)),
            (6, sentence(1, 40)), (7, sentence(1, 40)), (None, sentence(2, 30)), (8, "…!? 12 ½"),
            (9, sentence(1, 39) + " other"), (10, "ÀÉ Straße İstanbul ﻿ x\r\ny")]
