"""Applying an operator's decisions to the documents themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, small, written

#: Bytes of an id and a hash, about.
ID_BYTES = 40


def masked(docs: DataFrame, *apart: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with neutral names for all columns but ``apart``, and these names by column.

    An operator that adds columns then meets none of its own names.
    """
    names = {c: f"_column_{k}" for k, c in enumerate(docs.columns) if c not in apart}
    return docs.withColumnsRenamed(names), names


def text_hash(text: str = "text") -> Column:
    """Tells rows that carry one id apart."""
    return F.xxhash64(text)


def drop_texts(docs: DataFrame, gone: DataFrame, tag: str) -> DataFrame:
    """``docs`` without the texts named in ``gone`` (``doc_id``, ``th``: their hash).

    A null id is an id like others.
    """
    an_id, th = fresh(docs, "_gone", "_gone_th")
    gone = written(gone.select(F.col("doc_id").alias(an_id), F.col("th").alias(th))
                   .distinct(), tag)
    return docs.join(small(gone, ID_BYTES), F.col("doc_id").eqNullSafe(F.col(an_id))
                     & (text_hash() == F.col(th)), "left_anti")


def one_row_per_text(docs: DataFrame, tag: str) -> DataFrame:
    """``docs`` with one row for every id and text that several rows carry.

    Only those rows are shuffled. Rows with a null id all stay.
    """
    an_id, th = fresh(docs, "_twice", "_twice_th")
    twice = written(docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias(an_id), text_hash().alias(th)).groupBy(an_id, th).count().where(
        "count > 1").select(an_id, th), tag)
    if twice.isEmpty():
        return docs
    same = (F.col("doc_id") == F.col(an_id)) & (text_hash() == F.col(th))
    again = docs.join(twice, same, "left_semi")
    return docs.join(twice, same, "left_anti").unionByName(
        again.dropDuplicates(["doc_id", "text"]))
