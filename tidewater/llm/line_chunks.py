"""Line deduplication by content-defined chunks of lines.

A rolling hash runs over the hashes of SPAN neighbouring lines, at every line. Where
the lines under it have stood together before, anywhere in the corpus, it is a
repeat, after their bytes have been compared with those of the first place. A chunk
begins where repeats begin and ends where they end: its boundaries are set by the
content alone, so a passage is found wherever it stands and whatever surrounds it,
from SPAN lines on. Chunks are removed everywhere but at their first place. A single
line of LONG_WORDS words or more is a repeat by itself.

Boundaries at chosen values of the rolling hash alone, with whole chunks compared,
would miss most short passages inside other text: the chunk that a passage begins or
ends in reaches into its surroundings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, let, small, written

#: Lines under the rolling hash.
SPAN = 2
#: Chunks of fewer words stay; a line of so many counts without a neighbour.
MIN_WORDS, LONG_WORDS = 8, 50
#: Bytes of a row of repeats and of a removed chunk, about: tables of them are broadcast
#: while they are small, so that no text is shuffled.
REPEAT_BYTES, CHUNK_BYTES = 80, 64


def line_hash(line: Column) -> Column:
    """First 60 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 15), 16, 10).cast("long")


def n_words(text: Column | str) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def windows(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``th`` (text hash) and one row per place of the rolling hash.

    ``at`` is the first line (from 0), ``n`` the number of lines, ``h`` the hash,
    ``body`` the lines. Lines without a word make no window by themselves.
    """
    cut = docs.where(F.col(text).isNotNull()).select(
        "doc_id", F.xxhash64(text).alias("th"), F.split(text, "\n", -1).alias("lines"))
    hashed = cut.withColumn("hs", F.transform("lines", line_hash))
    # one pass over the lines; the window of a line reaches to the next one
    rows = hashed.select("doc_id", "th", F.posexplode(F.arrays_zip(
        F.col("lines").alias("one"), F.col("hs").alias("h1"),
        F.concat(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0))),
                 F.array(F.lit(None).cast("string"))).alias("two"),
        F.concat(F.slice("hs", 2, F.greatest(F.size("hs") - 1, F.lit(0))),
                 F.array(F.lit(None).cast("long"))).alias("h2"))).alias("at", "w"))
    pair = F.when(F.col("w.two").isNotNull(), F.concat_ws("\n", "w.one", "w.two"))
    found = F.array(
        F.struct(F.lit(SPAN).alias("n"), F.xxhash64("w.h1", "w.h2").alias("h"),
                 F.when(pair.rlike(r"\S"), pair).alias("body")),
        F.struct(F.lit(1).alias("n"), F.xxhash64("w.h1").alias("h"),
                 F.when(n_words("w.one") >= LONG_WORDS, F.col("w.one")).alias("body")))
    return rows.select("doc_id", "th", "at", F.inline(F.filter(
        found, lambda w: w["body"].isNotNull())))


def repeated(docs: DataFrame, text: str = "text") -> DataFrame:
    """The windows that repeat: ``doc_id, th, at, n``, all but each one's first place.

    Windows are grouped by hash; the first place (smallest id, then text hash, then
    line) of each group stays, and the others repeat it if their bytes equal its.
    """
    # a null id sorts after all others
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "at")
    copies = written(windows(docs, text).groupBy("h").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1"),
        "line-copies")
    again = windows(docs, text).join(small(copies.select("h", "first"), REPEAT_BYTES), "h")
    again = written(again.select("h", "doc_id", "th", "at", "n", "body",
                                 order.eqNullSafe(F.col("first")).alias("is_first")),
                    "line-repeats")
    bodies = again.where("is_first").groupBy("h").agg(F.first("body").alias("first_body"))
    same = again.where("NOT is_first").join(bodies, "h").where("body = first_body")
    return same.select("doc_id", "th", "at", "n").distinct()


def chunks(found: DataFrame) -> DataFrame:
    """Runs of neighbouring lines under the windows: ``doc_id, th, at, n``."""
    w = Window.partitionBy("doc_id", "th").orderBy("at", "n")
    reach = F.max(F.col("at") + F.col("n")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = found.withColumn("opens", F.coalesce(F.col("at") > reach, F.lit(True)).cast("int"))
    runs = opened.withColumn("run", F.sum("opens").over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("doc_id", "th", "run").agg(
        F.min("at").alias("at"), F.max(F.col("at") + F.col("n")).alias("to")).select(
        "doc_id", "th", "at", (F.col("to") - F.col("at")).alias("n"))


def dedup_lines(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with globally repeated chunks of lines taken out of ``text``.

    All columns come back, and ``n_lines``, ``n_removed_lines``,
    ``n_removed_chunks``. A text whose every line goes is empty; the other
    lines keep their order. Null texts stay null with no lines; rows that
    repeat an id with another text are told apart by the text, and rows that
    repeat both lose the same chunks. Columns of ``docs`` named like the new
    ones are replaced.
    """
    gone, gone_id, gone_th = fresh(docs, "_gone", "_gone_id", "_gone_th")
    spans = chunks(repeated(docs, text)).groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_list(F.struct("at", "n"))).alias(gone)).select(
        F.col("doc_id").alias(gone_id), F.col("th").alias(gone_th), gone)
    spans = written(spans, "line-removals")
    n_chunks = spans.agg(F.coalesce(F.sum(F.size(gone)), F.lit(0))).first()[0]
    joined = docs.join(small(spans, CHUNK_BYTES, n_chunks), F.col("doc_id").eqNullSafe(
        F.col(gone_id)) & F.xxhash64(text).eqNullSafe(F.col(gone_th)), "left")
    lines = F.split(text, "\n", -1)
    # a chunk needs enough words
    joined = joined.withColumn(gone, F.when(F.col(gone).isNotNull(), let(lines, lambda ls: F.filter(
        F.col(gone), lambda s: n_words(F.array_join(F.slice(ls, s["at"] + 1, s["n"]), "\n"))
        >= MIN_WORDS))))

    # lines between the removed chunks, in order
    def rest(all_lines, spans):
        last = F.size(spans)
        begins = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["at"] + s["n"]))
        return F.flatten(F.transform(begins, lambda b, i: F.slice(
            all_lines, b + 1, F.when(i < last, F.get(spans, i)["at"]).otherwise(
                F.size(all_lines)) - b)))

    kept = let(lines, lambda ls: let(F.col(gone), lambda g: rest(ls, g)))
    whole = F.col(gone).isNull() | (F.size(gone) == 0)
    shorter = F.when(whole, F.col(text)).otherwise(F.array_join(kept, "\n"))
    n_lines = F.coalesce(F.size(F.split(text, "\n", -1)), F.lit(0))
    sizes = {
        "n_lines": F.when(F.col(text).isNull(), F.lit(0)).otherwise(n_lines).cast("long"),
        "n_removed_lines": F.coalesce(F.aggregate(
            gone, F.lit(0), lambda a, s: a + s["n"]), F.lit(0)).cast("long"),
        "n_removed_chunks": F.coalesce(F.when(F.col(gone).isNotNull(), F.size(gone)),
                                       F.lit(0)).cast("long")}
    others = [c for c in docs.columns if c not in sizes]
    return joined.select(*[shorter.alias(text) if c == text else F.col(c) for c in others],
                         *[v.alias(k) for k, v in sizes.items()])


#: DuckDB views that give every repeated window (``doc_id, bgn, n``) and the removed chunks,
#: for unique ids; ``{docs}`` names a relation with ``doc_id`` and ``text``.
SQL_VIEWS = rf"""
lc_lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM {{docs}} WHERE text IS NOT NULL),
lc_flat AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i,
         unnest(ls[2:] || [NULL]) AS following FROM lc_lines),
lc_words AS (
  SELECT *, len(regexp_extract_all(line, '[^	-
 ]+')) AS words FROM lc_flat),
lc_windows AS (
  SELECT doc_id, i AS bgn, 2 AS n, line || chr(10) || following AS body FROM lc_words
  WHERE following IS NOT NULL AND regexp_matches(line || following, '[^	-
 ]')
  UNION ALL
  SELECT doc_id, i, 1, line FROM lc_words WHERE words >= {LONG_WORDS}),
lc_again AS (
  SELECT doc_id, bgn, n FROM lc_windows
  QUALIFY row_number() OVER (PARTITION BY n, body ORDER BY doc_id, bgn) > 1),
lc_marked AS (SELECT DISTINCT doc_id, unnest(range(bgn, bgn + n)) AS i FROM lc_again),
lc_runs AS (
  SELECT doc_id, i, words, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM lc_marked JOIN lc_words USING (doc_id, i)),
lc_gone AS (
  SELECT doc_id, run, min(i) AS bgn, count(*) AS n FROM lc_runs
  GROUP BY doc_id, run HAVING sum(words) >= {MIN_WORDS}),
lc_gone_lines AS (SELECT doc_id, unnest(range(bgn, bgn + n)) AS i FROM lc_gone),
lc_kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n
  FROM lc_flat ANTI JOIN lc_gone_lines USING (doc_id, i) GROUP BY doc_id),
lc_result AS (
  SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
         coalesce(len(l.ls), 0)::BIGINT AS n_lines,
         coalesce(len(l.ls) - coalesce(k.n, 0), 0)::BIGINT AS n_removed_lines,
         (SELECT count(*) FROM lc_gone g WHERE g.doc_id = d.doc_id)::BIGINT AS n_removed_chunks
  FROM {{docs}} d LEFT JOIN lc_lines l USING (doc_id) LEFT JOIN lc_kept k USING (doc_id))
"""

ORACLE_SQL = "WITH " + SQL_VIEWS.format(docs="documents") + """
SELECT doc_id, n_lines, n_removed_lines, n_removed_chunks, sha256(text) AS text_sha256
FROM lc_result
"""
