"""A corpus pipeline: five operators in a row over the table ``documents``.

Every stage takes what its predecessor kept, as a Parquet table, and its
decisions take effect. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, filters, language_id, line_chunks, near_dups
from tidewater.llm import sentence_pieces
from tidewater.llm.common import table, written
from tidewater.llm.queries import PIECES, language_model

#: A text stays if its language has at least this posterior.
MIN_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; null texts, empty ones and those without a letter go.

    Rows are judged by their texts alone: null and repeated ids play no part.
    """
    hidden, names = filters.masked(docs)
    found = language_id.identify(hidden, language_model(docs), text=names["text"],
                                 keep=tuple(hidden.columns))
    return found.where((F.col("lang_pred") != language_id.UNDETERMINED)
                       & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(
        *[F.col(names[c]).alias(c) for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines; documents left without a word go.

    Null and empty texts stay as they are. A null id comes after all others as a first
    place; rows that repeat an id and a text lose the same chunks. ``n_chars``, where
    there is such a column, follows the text.
    """
    hidden, names = filters.masked(docs, "doc_id", "text")
    shorter = line_chunks.dedup_lines(hidden)
    kept = shorter.where((F.col("n_removed_lines") == 0) | F.col("text").rlike(r"\S"))
    if "n_chars" in names:
        n_chars = F.when(F.col("n_removed_lines") == 0, F.col(names["n_chars"])).otherwise(
            F.char_length("text"))
        kept = kept.withColumn(names["n_chars"], n_chars.cast(docs.schema["n_chars"].dataType))
    return kept.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates.

    Texts that share an id are judged apart; of rows that repeat both, one stays. Rows
    with a null id stay, as they are linked with nothing, and so do null and empty texts.
    """
    key = F.when(F.col("doc_id").isNotNull(),
                 F.struct("doc_id", filters.text_hash().alias("th")))
    judged = near_dups.groups(docs.select(key.alias("doc_id"), "text"))
    gone = judged.where(~F.col("kept")).select("doc_id.doc_id", "doc_id.th")
    return filters.one_row_per_text(filters.drop_texts(docs, gone, "near-dropped"), "near-twice")


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Decisions are by id and text, null ids included; null and empty texts stay.
    """
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return filters.drop_texts(docs, found.where("n_hit > 0").select("doc_id", "th"),
                              "leaks-dropped")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with digests of the ids and of the text they decode to.

    One row for every row; null and empty texts have the end id alone.
    """
    return sentence_pieces.encode_texts(docs, PIECES, keep=("doc_id", "lang", "source"),
                                        with_text=False, check_with_library=True)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", decontaminate_documents),
    ("sentence_pieces", encode),
]

#: Learned models and MinHash cannot be written in SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
