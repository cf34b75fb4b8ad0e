"""Quality rules whose thresholds come from the data.

Every document is measured with SQL functions. For each language and source
a KLL quantile sketch of each measure is built; sketches merge, so a source
with few documents takes the sketch of its language, and a language with
few documents that of all. A measure's threshold is the upper quartile plus
a multiple of the quartile range (below: the lower quartile minus it).
Thresholds are joined to the documents, which are judged against them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, written

SPACES = r"\x20\x09-\x0D"
WINDOW = 5
#: Size parameter of the sketches: rank error about 0.1 %, exact up to so many values.
SKETCH_K = 2048
#: A group needs so many documents for thresholds of its own.
MIN_DOCS = 50
#: Distance from the quartile, in quartile ranges.
FENCE = 3.0
#: Judged measures: (least distance from the quartile, has a lower threshold).
MEASURES = {"symbols_per_word": (0.25, False), "dup_line_share": (0.35, False),
            "repeat_share": (0.15, False), "word_length": (2.0, True)}
#: Threshold tables up to so many rows are broadcast; larger ones are joined by salted keys.
BROADCAST_GROUPS, SALTS = 100_000, 32


def window_hashes(words: Column) -> Column:
    """Hashes of all runs of WINDOW words, in order; null for fewer words."""
    return let(words, lambda w: F.when(F.size(w) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice(w, i, WINDOW)))))


def repeated_starts(hashes: Column) -> Column:
    """Starts, in order, of the windows whose hash occurs twice or more."""
    pairs = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    # a window is repeated if a neighbour in the sorted list has its hash
    flagged = let(pairs, lambda ps: F.transform(ps, lambda p, k: F.when(
        (p["x"] == F.get(ps, k + 1)["x"]) | (p["x"] == F.get(ps, k - 1)["x"]), p["i"])))
    return F.sort_array(F.array_compact(flagged))


def covered(starts: Column) -> Column:
    """Words covered by windows at rising ``starts``."""
    steps = let(starts, lambda s: F.transform(s, lambda p, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - p, F.lit(WINDOW)))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def measure(docs: DataFrame, *, text: str = "text",
            keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` and the measures of every row's whole text, from SQL functions only.

    Words are runs of characters other than space and U+0009 to U+000D; null
    has none. ``n_words``, ``word_chars`` (code points in words),
    ``n_symbols`` (of ``#*$%&|<>``), ``n_lines`` and ``n_dup_lines`` (lines
    with a word, and those equal to an earlier one), ``n_repeat_words``
    (words in windows of five that occur twice or more; windows are compared
    by 64-bit hashes within one text).
    """
    t = F.coalesce(F.col("_text"), F.lit(""))
    words = F.array_remove(F.split(t, f"[{SPACES}]+"), "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(f"[^{SPACES}]"))
    parts = docs.select(*[F.col(c).alias(f"_k{k}") for k, c in enumerate(keep)],
                        F.col(text).alias("_text")).select(
        "*", words.alias("_words"), lines.alias("_lines"))
    ids = [F.col(f"_k{k}") for k in range(len(keep))]
    hashed = parts.select(
        *ids, F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace(t, f"[{SPACES}]+", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        window_hashes(F.col("_words")).alias("_h"))
    marked = hashed.withColumn("_s", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"), repeated_starts(F.col("_h")))).drop("_h")
    return marked.select(
        *[i.alias(c) for i, c in zip(ids, keep)], "n_words", "word_chars", "n_symbols", "n_lines",
        "n_dup_lines", F.coalesce(covered(F.col("_s")), F.lit(0).cast("long")).alias(
            "n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def shares() -> dict[str, Column]:
    """The MEASURES; null for texts without a word."""
    return {"symbols_per_word": F.try_divide("n_symbols", "n_words"),
            "dup_line_share": F.try_divide("n_dup_lines", "n_lines"),
            "repeat_share": F.try_divide("n_repeat_words", "n_words"),
            "word_length": F.try_divide("word_chars", "n_words")}


def thresholds(judged: DataFrame, *, min_docs: int = MIN_DOCS, fence: float = FENCE) -> DataFrame:
    """Per ``lang`` and ``source``: ``<measure>_low`` and ``<measure>_high``.

    ``judged`` has the MEASURES as columns. Nulls in ``lang`` and ``source``
    are groups like any other.
    """
    own = judged.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), *[
        F.kll_sketch_agg_double(m, SKETCH_K).alias(m) for m in MEASURES])
    own = written(own, "quality-sketches")

    def merged(keys, suffix):
        total = own.groupBy(*keys).agg(F.sum("n").alias("n" + suffix), *[
            F.kll_merge_agg_double(m, SKETCH_K).alias(m + suffix) for m in MEASURES])
        return total.select([F.col(k).alias(k + suffix) for k in keys] + [
            c for c in total.columns if c not in keys])

    by_lang, of_all = merged(["lang"], "_1"), merged([], "_2")
    all_row = F.struct(*of_all.columns)
    wide = own.join(by_lang, F.col("lang").eqNullSafe(F.col("lang_1")), "left").withColumn(
        "_all", of_all.select(all_row).scalar())

    def chosen(m):
        return F.when(F.col("n") >= min_docs, F.col(m)).when(
            F.col("n_1") >= min_docs, F.col(m + "_1")).otherwise(F.col("_all")[m + "_2"])

    cols = []
    for m, (least, has_low) in MEASURES.items():
        q1, q3 = (F.kll_sketch_get_quantile_double(chosen(m), F.lit(q)) for q in (0.25, 0.75))
        reach = F.greatest(F.lit(fence) * (q3 - q1), F.lit(least))
        cols.append((q3 + reach).alias(m + "_high"))
        if has_low:
            cols.append((q1 - reach).alias(m + "_low"))
    return wide.select("lang", "source", *cols)


def judge(docs: DataFrame, *, text: str = "text", min_docs: int = MIN_DOCS,
          fence: float = FENCE) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text, lang, source``), without the text.

    The measures, the document's thresholds, ``base_failed`` (fewer than ten
    words, or more than a fifth of them repeated) and ``kept``: not
    base-failed and every measure within its thresholds. Thresholds are
    learned from the rows that are not base-failed. Null and empty texts are
    base-failed; null language, source or id is allowed, and repeated rows
    each get their verdict. An empty table gives an empty result.
    """
    measured = written(measure(docs, text=text).withColumn("base_failed", base_failed()),
                       "quality-measures")
    judged = measured.where(~F.col("base_failed")).withColumns(shares())
    limits = written(thresholds(judged, min_docs=min_docs, fence=fence), "quality-thresholds")
    n = limits.count()
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    rows = measured.withColumns(shares())
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    if n <= BROADCAST_GROUPS:
        both = rows.join(F.broadcast(limits), same, "left").drop("_lang", "_source")
    else:
        salted = limits.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = rows.withColumn("_own", F.pmod(F.hash("doc_id"), F.lit(SALTS))).join(
            salted, same & (F.col("_own") == F.col("_salt")), "left").drop(
            "_lang", "_source", "_own", "_salt")
    fine = ~F.col("base_failed")
    for m, (_, has_low) in MEASURES.items():
        fine &= F.coalesce(F.col(m) <= F.col(m + "_high"), F.lit(True))
        if has_low:
            fine &= F.coalesce(F.col(m) >= F.col(m + "_low"), F.lit(True))
    return both.withColumn("kept", fine)


#: The same rules with exact quantiles, which the sketches give up to SKETCH_K values a group.
ORACLE_SQL = rf"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win)
  WHERE c > 1),
cov AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, lang, source, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov USING (doc_id)),
b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_symbols::DOUBLE / n_words AS v1, n_dup_lines::DOUBLE / n_lines AS v2,
         n_repeat_words::DOUBLE / n_words AS v3, word_chars::DOUBLE / n_words AS v4 FROM m),
long AS (
  SELECT lang, source, k, v FROM b, LATERAL (VALUES (1, v1), (2, v2), (3, v3), (4, v4)) x(k, v)
  WHERE NOT base_failed),
own AS (SELECT lang, source, k, count(*) AS n, quantile_disc(v, 0.25) AS q1,
               quantile_disc(v, 0.75) AS q3 FROM long GROUP BY ALL),
bylang AS (SELECT lang, k, count(*) AS n, quantile_disc(v, 0.25) AS q1,
                  quantile_disc(v, 0.75) AS q3 FROM long GROUP BY ALL),
total AS (SELECT k, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3
          FROM long GROUP BY ALL),
q AS (
  SELECT o.lang, o.source, o.k,
         CASE WHEN o.n >= {MIN_DOCS} THEN o.q1 WHEN l.n >= {MIN_DOCS} THEN l.q1 ELSE t.q1 END AS q1,
         CASE WHEN o.n >= {MIN_DOCS} THEN o.q3 WHEN l.n >= {MIN_DOCS} THEN l.q3 ELSE t.q3 END AS q3
  FROM own o JOIN bylang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.k = l.k
  JOIN total t ON o.k = t.k),
lim AS (
  SELECT lang, source, k, q1 - greatest({FENCE} * (q3 - q1), least_) AS low,
         q3 + greatest({FENCE} * (q3 - q1), least_) AS high
  FROM q JOIN (VALUES (1, 0.25), (2, 0.35), (3, 0.15), (4, 2.0)) s(k, least_) USING (k)),
bad AS (
  SELECT DISTINCT doc_id FROM (
    SELECT doc_id, lang, source, k, v
    FROM b, LATERAL (VALUES (1, v1), (2, v2), (3, v3), (4, v4)) x(k, v)) d
  JOIN lim ON d.lang IS NOT DISTINCT FROM lim.lang AND d.source IS NOT DISTINCT FROM lim.source
       AND d.k = lim.k
  WHERE d.v > high OR (d.k = 4 AND d.v < low))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept
FROM b
"""
