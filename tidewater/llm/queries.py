"""Registered queries of the corpus operators, with their oracle SQL.

Each query applies one operator with its production parameters to the whole
table and derives the columns of its contract. ``None`` instead of SQL:
SQL cannot express the operator, and ``tests/llm`` holds it against a
brute-force version, a round trip or held-out labels.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import (
    centroids,
    collocations,
    decontaminate,
    language_id,
    licences,
    line_chunks,
    near_dups,
    quality_rules,
    quality_trees,
    sentence_pieces,
    sharding,
    toxicity,
    warc,
)
from .common import crc_mod, table

#: Vocabulary file of the piece-based operators; every worker has the package.
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = licences.scan(docs, licences.fit(docs)).withColumn(
        "sure", F.filter("findings", lambda x: x["confirmed"]))
    return found.select(
        "doc_id", "n_paragraphs", F.size("sure").cast("long").alias("n_licence_paragraphs"),
        (F.size("findings") - F.size("sure")).cast("long").alias("n_unconfirmed"),
        F.array_join(F.array_sort(F.array_distinct("sure.family")), ",").alias("families"),
        F.array_max("sure.probability").alias("probability"),
        F.array_max("sure.similarity").alias("similarity"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def language_model(docs: DataFrame) -> language_id.LanguageModel:
    """Fitted on the rows outside the held-out third."""
    return language_id.fit(docs.where(crc_mod(F.col("doc_id"), 3) != 1), PIECES)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_model(docs))
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    # two words are this query's contract
    return near_dups.groups(table(spark, sf_dir, "documents"), size=2)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    trees = quality_trees.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality_trees.score(docs, trees).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
    warc.write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    return warc.read_pages(spark, path, with_payload=False).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted",
        F.col("evidence.doc_id").alias("evidence"))


def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode_texts(table(spark, sf_dir, "documents"), PIECES, with_ids=False,
                                        with_text=False, check_with_library=True)


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed_lines", "n_removed_chunks",
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


def op13_interleaved(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleaved(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias(
            "text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def load_all() -> dict[str, tuple[Callable, str | None]]:
    return {
        "op1_licences": (op1_licences, None),
        "op2_decontamination": (op2_decontamination, decontaminate.ORACLE_SQL),
        "op3_language_id": (op3_language_id, None),
        "op4_quality_rules": (op4_quality_rules, quality_rules.ORACLE_SQL),
        "op5_minhash": (op5_minhash, None),
        "op6_quality": (op6_quality, None),
        "op7_warc": (op7_warc, warc.ORACLE_SQL),
        "op8_toxicity": (op8_toxicity, None),
        "op9_sentence_pieces": (op9_sentence_pieces, None),
        "op10_line_chunks": (op10_line_chunks, line_chunks.ORACLE_SQL),
        "op11_collocations": (op11_collocations, collocations.ORACLE_SQL),
        "op12_centroids": (op12_centroids, centroids.ORACLE_SQL),
        "op13_interleaved": (op13_interleaved, sharding.ORACLE_SQL),
    }
