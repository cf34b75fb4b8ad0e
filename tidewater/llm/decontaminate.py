"""Benchmark decontamination by a prefix-filtered join of word shingles.

A benchmark item is cut into windows of consecutive words, a window into
overlapping shingles. A text can hold a window only if it holds all of the
window's shingles, so the join needs a prefix of one shingle: with the
shingles ordered by how rare they are in the corpus, the rarest one. Its
places in the documents give candidate places of the window, which must lie
inside the document (length and position bounds) and are verified exactly:
the window's words are tiled by shingles, and the document must have each
tile at its place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, lower_ascii, written

#: Everything but digits, letters and characters outside ASCII, after lower-casing.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word before lower-casing, for counting.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 10, 5
#: Benchmark tables up to so many rows are broadcast; larger ones are joined by shuffles.
BROADCAST_ROWS = 300_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), NO_WORD), "")


def shingle_texts(w: Column, size) -> Column:
    """All runs of ``size`` words, each joined by spaces; null for fewer words."""
    return F.when(F.size(w) >= size, F.transform(
        F.sequence(F.lit(1), F.size(w) - size + 1),
        lambda i: F.array_join(F.slice(w, i, size), " ")))


def small(df: DataFrame) -> DataFrame:
    """Broadcast a written table if its counted size allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """Distinct ``item_id, win, n`` (window text and words) and its shingle size ``size``."""
    w = items.where(F.col("item_id").isNotNull()).select(
        "item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("n", F.least(F.lit(window), F.size("w")))
    return w.select("item_id", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("n") + 1),
        lambda i: F.array_join(F.slice("w", i, F.col("n")), " "))).alias("win")).distinct() \
        .withColumn("size", F.least(F.lit(shingle), F.col("n")))


def contamination(docs: DataFrame, items: DataFrame, *, window: int = WINDOW,
                  shingle: int = SHINGLE) -> DataFrame:
    """Where windows of ``items`` (``item_id, text``) occur in ``docs`` (``doc_id, text``).

    One row per row of ``docs``: ``doc_id``, ``th`` (text hash), ``n_words``, ``n_hit`` (words
    inside any occurrence of a window), ``spans`` (start and end of every
    occurrence, in words, sorted), ``item_ids`` (items with occurring
    windows, as strings, sorted). A window is ``window`` consecutive words of
    an item; an item of fewer words, but not none, is one window.

    Null and empty texts have no words; items with a null id, or without a
    word, are left out; repeated items count once. Rows of ``docs`` that
    repeat an id are told apart by their text, equal ones all get the same
    result, and a null id is allowed. Only these two columns are read.
    """
    spark = docs.sparkSession
    wins = written(item_windows(items, window, shingle), "decontaminate-windows")
    sizes = [r["size"] for r in wins.select("size").distinct().collect()]  # 1 to ``shingle``
    keyed = docs.select("doc_id", F.xxhash64("text").alias("th"), "text")

    # shingles and tiles of every distinct window
    texts = wins.select("win", "n", "size").distinct()
    parts = texts.withColumn("w", F.split("win", " ")).withColumn(
        "shingles", F.transform(F.sequence(F.lit(0), F.col("n") - F.col("size")),
                                lambda o: F.struct(
                                    o.alias("offset"),
                                    F.array_join(F.slice("w", o + 1, F.col("size")), " ")
                                    .alias("shingle")))).drop("w")
    parts = written(parts, "decontaminate-shingles")
    by_shingle = parts.select("win", "n", "size", F.inline("shingles"))
    known = small(written(by_shingle.select("shingle").distinct(), "decontaminate-known"))

    def places(size: int) -> DataFrame:
        cut = keyed.select("doc_id", "th", words(F.col("text")).alias("w"))
        return cut.select("doc_id", "th", F.size("w").alias("n_words"), F.posexplode(
            let(F.col("w"), lambda w: shingle_texts(w, size))).alias("pos", "shingle")).join(
            known, "shingle")

    if sizes:
        found = written(reduce(DataFrame.unionByName, map(places, sizes)), "decontaminate-places")
        hits = _occurrences(found, parts, by_shingle, wins)
    else:
        hits = spark.createDataFrame([], docs.select("doc_id").schema).selectExpr(
            "doc_id AS _doc_id", "0L AS _th", "array(struct(0 AS start, 0 AS end)) AS spans",
            "array('') AS item_ids")
    counted = keyed.select("doc_id", "th", F.coalesce(F.regexp_count(
        "text", F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long").alias("n_words"))
    joined = counted.join(hits, F.col("doc_id").eqNullSafe(F.col("_doc_id"))
                          & F.col("th").eqNullSafe(F.col("_th")), "left")
    reach = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["reach"], s["start"]))).alias("n"),
            F.greatest(a["reach"], s["end"]).alias("reach")))
    return joined.select(
        "doc_id", "th", "n_words", F.coalesce(reach["n"], F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def _occurrences(found: DataFrame, parts: DataFrame, by_shingle: DataFrame,
                 wins: DataFrame) -> DataFrame:
    """Per document key: spans of occurring windows and their items."""
    frequency = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("freq"))
    # a window with a shingle that occurs nowhere occurs nowhere; else its rarest shingle
    prefix = by_shingle.join(frequency, "shingle", "left").groupBy("win", "n", "size").agg(
        F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "shingle", "offset")).alias("rare")
    ).where(F.col("rare.freq") > 0).select(
        "win", "n", "size", "rare.shingle", "rare.offset")
    prefix = small(written(prefix, "decontaminate-prefix"))
    start = F.col("pos") - F.col("offset")
    candidates = found.join(prefix, "shingle").where(
        (start >= 0) & (start + F.col("n") <= F.col("n_words"))).select(
        "doc_id", "th", "win", "n", "size", start.alias("start"))
    # tiles at 0, size, 2 size ... and at the window's end cover all its words
    tiles = parts.select("win", F.filter("shingles", lambda s: (
        (s["offset"] % F.col("size") == 0) | (s["offset"] == F.col("n") - F.col("size"))
    )).alias("tiles"))
    tiles = small(written(tiles, "decontaminate-tiles"))
    needed = candidates.join(tiles, "win").select(
        "doc_id", "th", "win", "n", "start", F.size("tiles").alias("n_tiles"),
        F.posexplode("tiles").alias("tile", "t")).select(
        "doc_id", "th", "win", "n", "start", "n_tiles", "tile",
        (F.col("start") + F.col("t.offset")).alias("pos"), F.col("t.shingle").alias("shingle"))
    there = found.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"),
                         F.col("pos").alias("_p"), F.col("shingle").alias("_s"))
    same = (F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("th").eqNullSafe(F.col("_t"))
            & (F.col("pos") == F.col("_p")) & (F.col("shingle") == F.col("_s")))
    whole = needed.join(there, same, "left_semi").groupBy(
        "doc_id", "th", "win", "n", "start", "n_tiles").agg(
        F.bit_or(F.expr("shiftleft(1L, tile)")).alias("seen")).where(
        F.bit_count("seen") == F.col("n_tiles"))
    whole = written(whole.select("doc_id", "th", "win", "start", (F.col("start") + F.col("n"))
                                 .alias("end")), "decontaminate-occurrences")
    spans = whole.groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    ids = small(written(wins.select("win", F.col("item_id").cast("string").alias("item")),
                        "decontaminate-items"))
    named = whole.select("doc_id", "th", "win").distinct().join(ids, "win").groupBy(
        "doc_id", "th").agg(F.sort_array(F.collect_set("item")).alias("item_ids")).select(
        F.col("doc_id").alias("_doc_id"), F.col("th").alias("_th"), "item_ids")
    return spans.join(named, F.col("doc_id").eqNullSafe(F.col("_doc_id"))
                      & F.col("th").eqNullSafe(F.col("_th"))).select(
        "_doc_id", "_th", "spans", "item_ids")


#: Every window is compared with every window of the documents, as text.
ORACLE_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
items AS (
  SELECT item_id, least(10, len(w)) AS n, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
  FROM iw WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
         FROM items),
sizes AS (SELECT DISTINCT n FROM wins),
places AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes
        WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, item_id, i, places.n FROM places JOIN wins USING (win, n)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
