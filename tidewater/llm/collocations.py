"""Phrases whose words stand together far more often than apart.

Counting rests on prefix-free parsing. Every piece of text (a run of words between
stop characters) is cut into chunks where its content says so: at a pair of words
whose hash is 0 modulo TRIGGER. Two neighbouring chunks share that pair, so every
phrase of up to three words lies whole inside a chunk, and equal passages give equal
chunks wherever they stand. Equal chunks are counted once, as a dictionary with
frequencies; phrases are then counted inside the distinct chunks, weighted by those
frequencies. A chunk that another one follows leaves the phrases that begin in the
shared pair to its follower, so each occurrence counts once.

Only phrases with ``min_count`` occurrences matter, and they are found in two steps.
Counts of 64-bit hashes of the phrases (triples only where both pairs are frequent)
give a superset, as equal hashes can only add to a count. Its members, told by a
Bloom filter of at most BLOOM_BITS bits, are then counted by their words. A wrong
yes of either step costs a row that the final count drops and there is no wrong no,
so the counts are exact at any size of the vocabulary.

Defined results:

- a null text has no words, a null language is ``und``;
- ids play no part; repeated rows and repeated ids count as often as they stand;
- a piece without a trigger, however long, is one chunk;
- a language without a phrase of ``min_count`` occurrences gives no row, and an
  empty table gives none at all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, lower_ascii, written

#: Words that neighbouring chunks share; phrases have one word more at most.
OVERLAP = 2
MAX_WORDS = OVERLAP + 1
#: A pair of words in so many, on average, ends a chunk.
TRIGGER = 31
#: Bytes of chunks that a worker counts together.
TOGETHER = 4 << 20
#: Bits of a Bloom filter: BITS_EACH for every member up to BLOOM_BITS (16 MB).
BLOOM_BITS = 1 << 27
BITS_EACH = 12
#: The probes are the hash shifted by so many bits, modulo the size (a power of two).
SHIFTS = (0, 13, 25, 37)
#: Copies of a count that the cuts of phrases are dealt to: a common word is in many.
SALTS = 16
#: Parts of a language whose best phrases are found apart.
PARTS = 4

STOPS = r"[.,;:!?\x0A-\x0D]"


# --- parse ------------------------------------------------------------------

def hashed(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()),
                       np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (one to one)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one range after the other."""
    sizes = ends - starts
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def cut(lang: pa.Array, text: pa.Array, trigger: int = TRIGGER) -> pa.Table:
    """Distinct chunks of the texts (``lang``, ``chunk``, ``ends``, ``freq``)."""
    pieces = pc.split_pattern_regex(text, STOPS)
    doc = np.repeat(np.arange(len(text)), pc.list_value_length(pieces).to_numpy())
    split = pc.split_pattern(pc.replace_substring(pieces.flatten(), "\t", " "), " ")
    piece = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy())
    words = split.flatten()
    filled = pc.greater(pc.binary_length(words), 0)
    words, piece = words.filter(filled), piece[filled.to_numpy(zero_copy_only=False)]
    coded = words.dictionary_encode()
    h = hashed(coded.dictionary)[coded.indices.to_numpy()]
    size = np.bincount(piece, minlength=len(split))
    at = np.arange(len(piece)) - (np.cumsum(size) - size)[piece]
    pair = h + np.uint64(31) * np.append(h[1:], np.uint64(0))
    opens = (at == 0) | (at > 0) & (at + OVERLAP < size[piece]) & (
        mix(pair) % np.uint64(trigger) == 0)
    starts = np.flatnonzero(opens)
    after = np.append(starts[1:], len(piece))
    ends = np.append(at[after[:-1]] == 0, True) if len(starts) else np.empty(0, bool)
    stops = np.where(ends, after, after + OVERLAP)
    lists = pa.ListArray.from_arrays(
        pa.array(np.append(0, np.cumsum(stops - starts)), pa.int32()),
        words.take(pa.array(ranges(starts, stops))))
    made = pa.table({"lang": lang.take(pa.array(doc[piece[starts]])),
                     "chunk": pc.binary_join(lists, " "), "ends": pa.array(ends)})
    found = made.group_by(["lang", "chunk", "ends"], use_threads=False).aggregate([([], "count_all")])
    return found.rename_columns(["lang", "chunk", "ends", "freq"])


def parse(docs: DataFrame, text: str = "text", lang: str = "lang",
          trigger: int = TRIGGER) -> DataFrame:
    """The dictionary of distinct chunks (``lang``, ``chunk``, ``ends``, ``freq``).

    A chunk is its words joined by spaces; ``ends`` tells that it ends its piece.
    """
    bounded_batches(docs.sparkSession)

    def cut_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from cut(batch.column(0), batch.column(1), trigger).to_batches()

    plain = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                        lower_ascii(F.col(text)).alias("text")).where(F.col("text").isNotNull())
    return plain.mapInArrow(cut_all, "lang string, chunk string, ends boolean, freq long") \
        .groupBy("lang", "chunk", "ends").agg(F.sum("freq").alias("freq"))


def owned(chunk: Column, ends: Column) -> Column:
    """Words of a chunk that no follower counts."""
    n = F.length(chunk) - F.length(F.translate(chunk, " ", "")) + 1
    return n - F.when(ends, 0).otherwise(OVERLAP)


# --- counts -------------------------------------------------------------------

class Members:
    """A Bloom filter of 64-bit hashes."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits  # bytes

    @staticmethod
    def of(hashes: DataFrame) -> Members:
        """Of the column ``hash`` of a written table; 64 bits at a time are set in Spark."""
        n, size = hashes.count(), 1 << 10
        while size < min(BLOOM_BITS, BITS_EACH * n):
            size *= 2
        probes = F.array(*[F.shiftrightunsigned("hash", k).bitwiseAND(
            F.lit(size - 1).cast("long")) for k in SHIFTS])
        found = hashes.select(F.explode(probes).alias("at")).groupBy(
            F.shiftright("at", 6).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")).toArrow()
        words = np.zeros(size // 64, "<i8")
        words[found.column("word").to_numpy()] = found.column("bits").to_numpy()
        return Members(words.view(np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.bits) * 8 - 1)
        yes = np.ones(len(hashes), bool)
        for k in SHIFTS:
            at = (hashes >> np.uint64(k)) & mask
            yes &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1) > 0
        return yes


class Phrases:
    """The phrases of a table of chunks: where they start, their weights and hashes."""

    def __init__(self, chunks: pa.Table):
        chunks = chunks.combine_chunks()
        lists = pc.split_pattern(chunks["chunk"].chunk(0), " ")
        size = pc.list_value_length(lists).to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        self.words, self.code = coded.dictionary, coded.indices.to_numpy()
        langs = chunks["lang"].chunk(0).dictionary_encode()
        self.langs = langs.dictionary
        row = np.repeat(np.arange(len(size)), size)
        self.lang = langs.indices.to_numpy()[row]
        self.freq = chunks["freq"].to_numpy()[row]
        at = np.arange(len(row)) - (np.cumsum(size) - size)[row]
        ends = chunks["ends"].chunk(0).to_numpy(zero_copy_only=False)
        self.own = at < (size - np.where(ends, 0, OVERLAP))[row]
        self.left = size[row] - at  # words from here to the chunk's end
        h = hashed(self.words)[self.code]
        self.hash = {1: mix(hashed(self.langs)[self.lang] + h)}
        for n in range(2, MAX_WORDS + 1):
            ahead = np.append(h[n - 1:], np.zeros(min(n - 1, len(h)), np.uint64))
            self.hash[n] = mix(self.hash[n - 1] * np.uint64(3) + ahead)

    def starts(self, n: int) -> np.ndarray:
        """True where a phrase of ``n`` words starts that this chunk counts."""
        return self.own & (self.left >= n)

    def hash_counts(self, n: int, where: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(where)
        found = pa.table({"hash": self.hash[n][at].view(np.int64), "n": self.freq[at]}).group_by(
            "hash", use_threads=False).aggregate([("n", "sum")])
        return _one(found.rename_columns(["hash", "n"]))

    def word_counts(self, n: int, where: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(where)
        keys = {"lang": self.lang[at]} | {f"w{k}": self.code[at + k] for k in range(n)}
        found = pa.table(keys | {"n": self.freq[at]}).group_by(
            list(keys), use_threads=False).aggregate([("n", "sum")]).combine_chunks()
        parts = [self.words.take(found[f"w{k}"]) for k in range(n)]
        phrase = parts[0] if n == 1 else pc.binary_join_element_wise(*parts, " ")
        return _one(pa.table({"lang": self.langs.take(found["lang"]), "phrase": phrase,
                              "size": pa.array(np.full(len(found), n), pa.int32()),
                              "n": found["n_sum"]}))


def _one(found: pa.Table) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c.combine_chunks() for c in found.columns],
                                      names=found.column_names)


def _together(batches: Iterator[pa.RecordBatch], enough: int) -> Iterator[Phrases]:
    """The phrases of about so many bytes of chunks at a time."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= enough:
            yield Phrases(pa.Table.from_batches(held))
            held, size = [], 0
    if sum(b.num_rows for b in held):
        yield Phrases(pa.Table.from_batches(held))


def _frequent_hashes(chunks: DataFrame, count, min_count: int, tag: str) -> DataFrame:
    found = chunks.mapInArrow(count, "hash long, n long").groupBy("hash").agg(
        F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return written(found.select("hash"), tag)


def frequent(chunks: DataFrame, min_count: int, together: int = TOGETHER) -> DataFrame:
    """Phrases with ``min_count`` occurrences (``lang``, ``phrase``, ``size``, ``f``), exactly."""
    context = chunks.sparkSession.sparkContext

    def short(batches):
        for p in _together(batches, together):
            for n in range(1, MAX_WORDS):
                yield p.hash_counts(n, p.starts(n))

    some = _frequent_hashes(chunks, short, min_count, "phrase-hashes")
    inner = context.broadcast(Members.of(some))

    def long(batches):
        for p in _together(batches, together):
            known = inner.value.has(p.hash[MAX_WORDS - 1])
            both = known & np.append(known[1:], False)
            yield p.hash_counts(MAX_WORDS, p.starts(MAX_WORDS) & both)

    some = some.union(_frequent_hashes(chunks, long, min_count, "phrase-hashes-long"))
    members = context.broadcast(Members.of(some))

    def spelled(batches):
        for p in _together(batches, together):
            for n in range(1, MAX_WORDS + 1):
                yield p.word_counts(n, p.starts(n) & members.value.has(p.hash[n]))

    found = chunks.mapInArrow(spelled, "lang string, phrase string, size int, n long").groupBy(
        "lang", "phrase", "size").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
    out = written(found, "phrases")
    inner.destroy()
    members.destroy()
    return out


# --- scores -----------------------------------------------------------------------

def _cuts(phrases: DataFrame, words: int) -> DataFrame:
    """Both parts of every cut of the phrases (``lang``, ``phrase``, ``a``, ``part``, ``side``)."""
    w = F.split("phrase", " ", -1)
    sides = []
    for k in range(1, words):
        for side, start, size in (("l", 1, k), ("r", k + 1, words - k)):
            sides.append(F.struct(F.lit(f"{side}{k}").alias("side"),
                                  F.array_join(F.slice(w, start, size), " ").alias("part")))
    return phrases.select("lang", "phrase", F.col("f").alias("a"),
                          F.explode(F.array(*sides)).alias("s")).select(
        "lang", "phrase", "a", "s.side", "s.part")


def scored(counts: dict[int, DataFrame]) -> DataFrame:
    """Candidates with the parts ``l`` and ``r`` of their lowest-scoring cut and its score."""
    cuts = _cuts(counts[2], 2)
    for n in range(3, MAX_WORDS + 1):
        cuts = cuts.unionByName(_cuts(counts[n], n))
    known = counts[1]
    for n in range(2, MAX_WORDS):
        known = known.unionByName(counts[n])
    known = known.select("lang", F.col("phrase").alias("part"), "f",
                         F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    cuts = cuts.withColumn("salt", F.pmod(F.hash("phrase"), F.lit(SALTS)))
    met = cuts.join(known, ["lang", "part", "salt"])
    sides = [f"{s}{k}" for k in range(1, MAX_WORDS) for s in "lr"]
    wide = met.groupBy("lang", "phrase", "a").agg(
        *[F.max(F.when(F.col("side") == s, F.col("f"))).alias(s) for s in sides])

    def score(k: int) -> Column:
        # a * a * 1000000 passes 64 bits
        a, l, r = (F.col(c).cast("decimal(38,0)") for c in ("a", f"l{k}", f"r{k}"))
        return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(38,0)"), l * r)

    best = F.array_min(F.filter(F.array(*[
        F.when(F.col(f"l{k}").isNotNull(), F.struct(
            score(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"),
            F.col(f"r{k}").alias("r"))) for k in range(1, MAX_WORDS)]), lambda x: x.isNotNull()))
    return wide.withColumn("best", best).select("lang", "phrase", "a", "best.l", "best.r",
                                                "best.score")


def contained(counts: dict[int, DataFrame], share: int) -> DataFrame:
    """Phrases (``lang``, ``phrase``, ``inside``) that stand in longer candidates, with the
    largest count of one; ``share`` percent of a phrase's own count drop it."""
    found = None
    for n in range(3, MAX_WORDS + 1):
        w = F.split("phrase", " ", -1)
        parts = F.array(*[F.array_join(F.slice(w, i, size), " ")
                          for size in range(2, n) for i in range(1, n - size + 2)])
        rows = counts[n].select("lang", F.explode(parts).alias("phrase"), F.col("f"))
        found = rows if found is None else found.unionByName(rows)
    return found.groupBy("lang", "phrase").agg(F.max(F.col("f") * 100).alias("inside"))


def mine(docs: DataFrame, min_count: int = 10, share: int = 50, top: int = 2000,
         text: str = "text", lang: str = "lang", trigger: int = TRIGGER,
         together: int = TOGETHER) -> DataFrame:
    """The ``top`` phrases of every language (``lang``, ``rank``, ``phrase``, ``a``, ``l``,
    ``r``, ``n``, ``score``).

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its lowest-scoring cut,
    ``n`` all words of the language; the score is floor(1000000 a a / (l r)). A phrase
    goes if a longer candidate around it has ``share`` percent of its count.
    """
    chunks = written(parse(docs, text, lang, trigger), "phrase-chunks")
    phrases = frequent(chunks, min_count, together)
    counts = {n: phrases.where(F.col("size") == n) for n in range(1, MAX_WORDS + 1)}
    words = chunks.groupBy("lang").agg(
        F.sum(F.col("freq") * owned(F.col("chunk"), F.col("ends"))).alias("n"))
    kept = scored(counts).join(contained(counts, share), ["lang", "phrase"], "left").where(
        F.coalesce(F.col("inside") < share * F.col("a"), F.lit(True)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # a language's best are among the best of its parts
    part = Window.partitionBy("lang", F.pmod(F.hash("phrase"), F.lit(PARTS))).orderBy(*order)
    best = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    ranked = best.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
    return ranked.join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The query op11_collocations in DuckDB.
ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents),
f AS (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, 1 AS size, unnest(w) AS phrase FROM pieces
    UNION ALL
    SELECT lang, 2, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) FROM pieces
    UNION ALL
    SELECT lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]
                            for i in range(1, len(w) - 1)]) FROM pieces)
  GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f
         WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT c.*, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:size], ' ') AS rp
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand) c),
scores AS (
  SELECT c.lang, c.phrase, c.size, a, k, fl.f AS l, fr.f AS r,
    CAST((1000000::HUGEINT * a * a) // (fl.f::HUGEINT * fr.f) AS BIGINT) AS score
  FROM cuts c JOIN f fl ON fl.lang = c.lang AND fl.phrase = lp
              JOIN f fr ON fr.lang = c.lang AND fr.phrase = rp),
best AS (
  SELECT * FROM scores
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_pairs AS (
  SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a
  FROM cand WHERE size = 3),
longest AS (SELECT lang, phrase, max(a) AS inside FROM inner_pairs GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longest i USING (lang, phrase)
  WHERE b.size = 3 OR i.inside IS NULL OR 100 * i.inside < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n.n, score
FROM kept JOIN n USING (lang)
QUALIFY rank <= 2000
"""
