"""Near-duplicate groups by circulant MinHash with exact verification.

Circulant MinHash needs two permutations of a universe of D places: the
first one scatters a document's shingles, and coordinate k of the signature
is the least value of the second one, circularly shifted by k, over those
places. ROWS coordinates make a band; documents that agree on a band are
candidates, and a link is confirmed on the full shingle sets of the texts.

Only the groups that links connect are wanted, so candidates are not
expanded into all pairs. Texts of equal words are one class, seen through
its smallest id. In every bucket the members are first compared with one of
them, the pivot: the one that shares most buckets with others, as the
original of many near copies does. The links found give components; buckets
that still hold several get a second pivot, and in the end members of one
bucket that are in different components are compared with one another,
unless bounds on what they can share rule a link out. Members of such a
bucket differ from its pivot by few shingles. Of two that are linked, one at
least is not linked with the pivot, so both differ from it by many of the
same shingles, and they are met through the rarer ones of these.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, release, small, written
from .sentence_pieces import forget

#: Places of the universe, and the seed of the two permutations.
PLACES, SEED = 1 << 20, 20
#: 40 bands of 6: of pairs with similarity 0.8 all but 6 in a million share a band.
BANDS, ROWS = 40, 6
#: Words of a shingle, unless a query's contract names another number.
WORDS = 5
#: Percent of the union that the intersection must reach.
PERCENT = 80
#: Shingles handled at once by the numpy passes of a task.
CHUNK = 200_000
#: Word hashes a worker remembers, and the bytes of their longest words.
REMEMBERED, LONGEST_WORD = 200_000, 64
#: A shingle is rare among the texts left over if so many of them have it at most.
RARE = 20
#: Bytes of an id, about.
ID_BYTES = 24


class WordHashes(dict):
    def __missing__(self, word):
        value = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED and len(word) <= LONGEST_WORD:
            self[word] = value
        return value


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than space and U+0009 to U+000D, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], size: int = WORDS) -> set:
    """Distinct shingles; fewer words than ``size`` are one shingle, no words none."""
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size))))


def permutations(places: int = PLACES, shifts: int = BANDS * ROWS):
    """The two permutations; the second is continued past its end by ``shifts``."""
    random = np.random.default_rng(SEED)
    first = random.permutation(places).astype(np.int32)
    second = random.permutation(places).astype(np.int32)
    return first, np.concatenate([second, second[:shifts]])


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (one to one)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Signer:
    """Shingle counts and band keys of texts."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, size: int = WORDS):
        self.bands, self.rows, self.size = bands, rows, size
        self.first, self.second = permutations(shifts=bands * rows)
        self.hashes = WordHashes()

    def shingles(self, words: list[bytes]) -> np.ndarray:
        """64-bit hashes of the distinct shingles."""
        h = np.array(list(map(self.hashes.__getitem__, words)), np.uint64)
        n = max(1, len(h) - self.size + 1)
        value = np.zeros(n, np.uint64)
        for k in range(min(self.size, len(h))):
            value = mix(value + h[k:k + n])
        return np.unique(value)

    def signature(self, sets: list[np.ndarray]) -> np.ndarray:
        """Coordinates per set (none of them empty)."""
        places = self.first[(np.concatenate(sets) % np.uint64(PLACES)).astype(np.int64)]
        starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
        return np.stack([np.minimum.reduceat(self.second[k:k + PLACES][places], starts)
                         for k in range(self.bands * self.rows)], 1)

    def keys(self, sets: list[np.ndarray]) -> np.ndarray:
        """One 64-bit key per set and band."""
        sign = self.signature(sets).astype(np.uint64).reshape(len(sets), self.bands, self.rows)
        key = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64),
                              (len(sets), self.bands))
        for r in range(self.rows):
            key = mix(key * np.uint64(0xD1342543DE82EF95) + sign[:, :, r])
        return key.view(np.int64)


def signatures(docs: DataFrame, *, text: str = "text", bands: int = BANDS, rows: int = ROWS,
               size: int = WORDS) -> DataFrame:
    """``doc_id``, ``fp`` (hash of the words), ``n_shingles`` and ``keys`` (one per band).

    Texts without a word have no fingerprint and no keys.
    """
    bounded_batches(docs.sparkSession)
    schema = T.StructType([docs.schema["doc_id"]] + T.StructType.fromDDL(
        "fp binary, n_shingles long, keys array<long>").fields)

    def batches(it):
        forget()
        signer = Signer(bands, rows, size)
        for b in it:
            fps, counts, keys, waiting, at, total = [], [], [], [], [], 0

            def flush():
                if waiting:
                    for k, row in zip(at, signer.keys(waiting).tolist()):
                        keys[k] = row
                    waiting.clear()
                    at.clear()

            for t in b.column(1).to_pylist():
                words = words_of(t)
                keys.append(None)
                if not words:
                    fps.append(None)
                    counts.append(0)
                    continue
                fps.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                found = signer.shingles(words)
                counts.append(len(found))
                waiting.append(found)
                at.append(len(keys) - 1)
                total += len(found)
                if total > CHUNK:
                    flush()
                    total = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(fps, pa.binary()), pa.array(counts, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "fp", "n_shingles", "keys"])

    return docs.select("doc_id", text).mapInArrow(batches, schema)


def texts_of(docs: DataFrame, ids: DataFrame, text: str) -> DataFrame:
    """``doc_id, t`` of the documents named in ``ids``, as a table."""
    ids = written(ids, "near-ids")
    return written(docs.select("doc_id", F.col(text).alias("t")).join(small(ids, ID_BYTES), "doc_id"),
                   "near-texts")


def shingle_sets(texts: DataFrame, size: int = WORDS) -> DataFrame:
    """``doc_id, hs``: the distinct shingles (64-bit hashes) of each text with a word."""
    schema = T.StructType([texts.schema["doc_id"]] + T.StructType.fromDDL("hs array<long>").fields)

    def batches(it):
        signer = Signer(1, 1, size)
        for b in it:
            for k, t in enumerate(b.column(1).to_pylist()):
                if words := words_of(t):
                    h = signer.shingles(words).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(k, 1), pa.ListArray.from_arrays([0, len(h)], pa.array(h))],
                        names=["doc_id", "hs"])

    return texts.select("doc_id", "t").mapInArrow(batches, schema)


def verified(pairs: DataFrame, docs: DataFrame, *, text: str = "text", size: int = WORDS,
             percent: int = PERCENT) -> DataFrame:
    """The pairs (``a, b``) with their shingle counts' ``inter`` and ``uni`` and ``linked``.

    Sets are built from the whole texts. Only texts of ids in ``pairs`` are moved.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = texts_of(docs, ids, text)
    both = pairs.join(texts.withColumnsRenamed({"doc_id": "a", "t": "ta"}), "a").join(
        texts.withColumnsRenamed({"doc_id": "b", "t": "tb"}), "b")
    schema = T.StructType([T.StructField(c, pairs.schema[c].dataType) for c in ("a", "b")]
                          + T.StructType.fromDDL(
                              "inter long, uni long, linked boolean").fields)

    def batches(it):
        last = None, None
        for batch in it:
            rows = batch.to_pydict()
            inter, uni = [], []
            for a, b in zip(rows["ta"], rows["tb"]):
                if last[0] != b:
                    last = b, shingle_set(words_of(b), size)
                one = shingle_set(words_of(a), size)
                common = len(one & last[1])
                inter.append(common)
                uni.append(len(one) + len(last[1]) - common)
            linked = [i > 0 and 100 * i >= percent * u for i, u in zip(inter, uni)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(inter, pa.int64()),
                 pa.array(uni, pa.int64()), pa.array(linked, pa.bool_())],
                names=["a", "b", "inter", "uni", "linked"])

    return both.select("a", "b", "ta", "tb").mapInArrow(batches, schema)


def components(edges: DataFrame) -> DataFrame:
    """``id, comp``: the smallest id that the links (``a, b``) reach, for every linked id.

    Alternates two steps until links are stars: every id hooks its larger
    neighbours, then its smaller ones, to the smallest of them. Each round is
    a written table; the number of rounds grows with the logarithm of the
    longest chain.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(
        F.col("u") != F.col("v")).distinct()
    links = written(links, "near-links")
    while not _stars(links):
        around = links.union(links.select(F.col("v"), F.col("u")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # larger neighbours of u hang on the smallest id around u
        large = around.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        large = written(large, "near-large")
        # u and its smaller neighbours hang on the smallest of these
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        links = written(large.join(low, "u").where("v != m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))).distinct(), "near-links")
    return links.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(
        links.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())


def _stars(links: DataFrame) -> bool:
    """Whether every ``u`` has one ``v``, which is no ``u``: it is the smallest id around."""
    ends = links.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(
        "up > 1 or up = 1 and down = 1").isEmpty()


def groups(docs: DataFrame, *, text: str = "text", bands: int = BANDS, rows: int = ROWS,
           size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Two texts are linked if their sets of ``size``-word shingles share at
    least ``percent`` of the union. ``component_id`` is the smallest id that
    links reach, ``kept`` marks that document. Null and empty texts, texts
    without a word, and rows with a null id are linked with nothing: they are
    kept, with their own id as component. Rows that repeat an id are told
    apart by their text; equal ones get the same result. Shingles are counted
    by 64-bit hashes, classes of equal words by 128-bit hashes, and links by
    the texts themselves. Only these columns are read.
    """
    found = written(signatures(docs, text=text, bands=bands, rows=rows, size=size),
                    "near-signatures")
    usable = found.where(F.col("fp").isNotNull() & F.col("doc_id").isNotNull())
    classes = written(usable.groupBy("fp").agg(F.min(F.struct(
        "doc_id", "n_shingles", "keys")).alias("c")).select(
        "fp", F.col("c.doc_id").alias("rep"), F.col("c.n_shingles").alias("n"),
        F.col("c.keys").alias("keys")), "near-classes")
    comps = _linked(docs.where(F.col("doc_id").isNotNull()), classes, text, size, percent)
    named = classes.select("fp", "rep").join(comps, F.col("rep") == F.col("id"), "left").select(
        F.col("fp").alias("_fp"), F.coalesce("comp", "rep").alias("comp"))
    plain = found.select("doc_id", "fp", "n_shingles")
    joined = plain.join(named, (F.col("fp") == F.col("_fp")) & F.col("doc_id").isNotNull(), "left")
    own = F.coalesce("comp", "doc_id")
    return joined.select("doc_id", "n_shingles", own.alias("component_id"),
                         F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def _linked(docs: DataFrame, classes: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """Components of the class representatives that have links."""
    members = classes.select("rep", "n", F.explode("keys").alias("key"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = written(members.join(sizes, "key"), "near-shared")
    # a text that others were derived from meets more texts than these meet one another
    weights = shared.groupBy("rep").agg(F.sum("size").alias("weight"))
    shared = written(shared.join(weights, "rep"), "near-buckets")
    comps = done = None

    def mixed(rows: DataFrame) -> DataFrame:
        """Rows of the buckets that hold more than one component, with their ``comp``."""
        rows = rows.join(comps.withColumnRenamed("id", "rep"), "rep", "left").withColumn(
            "comp", F.coalesce("comp", "rep"))
        several = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        return rows.join(several.where("lo != hi").select("key"), "key", "left_semi")

    def pivots(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.max(F.struct("weight", "rep", "n")).alias("p")).select(
            "key", F.col("p.rep").alias("pivot"), F.col("p.n").alias("pn"),
            F.col("p.weight").alias("pw"))

    def with_pivot(rows: DataFrame, chosen: DataFrame) -> DataFrame:
        return rows.join(chosen, "key").where((F.col("rep") != F.col("pivot")) & (
            100 * F.least("n", "pn") >= percent * F.greatest("n", "pn"))).select(
            F.col("rep").alias("a"), F.col("pivot").alias("b"), "pw").groupBy("a", "b").agg(
            F.max("pw").alias("pw"))

    def compare(pairs: DataFrame) -> None:
        """Verify pairs that were not compared yet and lie in different components."""
        nonlocal comps, done
        if done is not None:
            ends = F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")
            pairs = pairs.select("a", "b", *ends).join(done.select(*ends), ["lo", "hi"],
                                                       "left_anti")
            for c in ("a", "b"):
                pairs = pairs.join(comps.select(F.col("id").alias(c), F.col("comp").alias("c" + c)),
                                   c, "left")
            pairs = pairs.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
        pairs = written(pairs, "near-pairs")
        if done is not None and pairs.isEmpty():
            return
        new = written(verified(pairs, docs, text=text, size=size, percent=percent),
                      "near-verified")
        edges = new.where("linked").select("a", "b")
        first_time, done = done is None, new if done is None else done.unionByName(new)
        if not first_time:
            if edges.isEmpty():
                return
            edges = edges.union(comps.select("id", "comp"))
        comps = written(components(edges), "near-components")
        release(docs.sparkSession)

    first = written(pivots(shared), "near-pivots")
    to_first = written(with_pivot(shared, first), "near-pivot-pairs")
    # each member with its heaviest pivot, then with its other pivots
    compare(to_first.groupBy("a").agg(F.max_by("b", F.struct("pw", "b")).alias("b")))
    compare(to_first.select("a", "b"))
    # buckets that are still mixed: members with the heaviest one outside the pivot's component
    at = comps.select(F.col("id").alias("pivot"), F.col("comp").alias("pc"))
    rows = written(mixed(shared), "near-mixed")
    outside = rows.join(first.select("key", "pivot"), "key").join(at, "pivot", "left").where(
        F.col("comp") != F.coalesce("pc", "pivot"))
    second = written(pivots(outside), "near-second-pivots")
    compare(with_pivot(rows, second).select("a", "b"))

    # what is left: members of one bucket in different components, neither of them a pivot
    rest = mixed(rows.drop("comp")).join(
        first.select("key", "pivot").unionByName(second.select("key", "pivot"))
        .withColumnRenamed("pivot", "rep"), ["key", "rep"], "left_anti")
    at = comps.select(F.col("id").alias("pivot"), F.col("comp").alias("pc"))
    rest = written(rest.join(first, "key").join(at, "pivot", "left").select(
        "rep", "n", "comp", "pivot", "pn",
        (F.col("comp") != F.coalesce("pc", "pivot")).alias("apart")).distinct(), "near-open")
    if rest.isEmpty():
        return comps
    for pairs in _left_over(rest, docs, text, size, percent):
        compare(pairs)
    return comps


def _left_over(rest: DataFrame, docs: DataFrame, text: str, size: int,
               percent: int) -> list[DataFrame]:
    """Pairs (``a, b``) of ``rest`` that may be linked, by bounds that no link breaks.

    ``rest`` has the texts of each pivot's buckets, ``apart`` those outside its
    component. Shingles that few of these texts have are joined on themselves:
    they give the pairs that share any, and how many. All other pairs can only
    share common shingles, so texts without enough of these are left out of
    the second set of pairs (see ``_differing_alike``).
    """
    reps = rest.select(F.col("rep").alias("doc_id")).distinct()
    texts = texts_of(docs, reps.union(rest.select("pivot")).distinct(), text)
    sets = written(shingle_sets(texts, size).distinct(), "near-sets")
    rows = written(sets.join(reps, "doc_id", "left_semi").select(
        "doc_id", F.explode("hs").alias("h")).distinct(), "near-shingles")
    often = rows.groupBy("h").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    met = written(rows.join(often, "h"), "near-met-shingles")
    common = met.where(F.col("f") > RARE).groupBy("doc_id").agg(F.count(F.lit(1)).alias("c"))
    facts = rest.groupBy("rep").agg(F.min("n").alias("n"), F.first("comp").alias("comp")).join(
        common.withColumnRenamed("doc_id", "rep"), "rep", "left").select(
        "rep", "n", "comp", F.coalesce("c", F.lit(0)).alias("c"))
    facts = written(facts, "near-facts")

    def named(df, x, *names):
        return df.withColumnsRenamed({c: c + x for c in ("rep", *names)})

    rare = met.where(F.col("f") <= RARE).select("h", F.col("doc_id").alias("rep"))
    sharing = named(rare, "_a").join(named(rare, "_b"), "h").where(
        F.col("rep_a") > F.col("rep_b")).groupBy("rep_a", "rep_b").agg(
        F.count(F.lit(1)).alias("t"))
    inter = F.col("t") + F.least("c_a", "c_b")
    by_rare = sharing.join(named(facts, "_a", "n", "comp", "c"), "rep_a").join(
        named(facts, "_b", "n", "comp", "c"), "rep_b").where(
        (F.col("comp_a") != F.col("comp_b"))
        & (100 * inter >= percent * (F.col("n_a") + F.col("n_b") - inter)))

    # texts whose common shingles alone could reach the share
    able = rest.join(facts.where(100 * F.col("c") >= percent * F.col("n")).select("rep"), "rep",
                     "left_semi")
    return [by_rare.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")),
            _differing_alike(able, sets, percent)]


def _differing_alike(able: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a, b``) of one pivot and different components that may be linked.

    Let x' be the shingles that only one of a text x and the pivot P has. If a
    and b are linked, and b is not linked with P, then with k = (100 - percent)
    / (100 + percent):

    - a and b differ by at most k (n_a + n_b) shingles, so a' and b' share at
      least o = (|a'| + |b'| - k (n_a + n_b)) / 2;
    - b and P differ by more than k (n_b + n_P), so o > (|a'| + k (n_P - n_a)) / 2;
    - |a'| >= |n_a - n_P|, so o >= (|b'| - k (n_b + n_P)) / 2.

    Differences are ordered from the rarest shingle of the pivot's texts to the
    most frequent one. At the first that two of them share, the rest of either
    is long enough for o; so only the beginnings of differences are joined.
    """
    several = able.groupBy("pivot").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where(
        "lo != hi").select("pivot")
    able = able.join(several, "pivot", "left_semi")
    # ids may repeat with other texts; those of the pivot's and the member's length were compared
    at_pivot = able.select("pivot", "pn").distinct().join(
        sets.select(F.col("doc_id").alias("pivot"), F.col("hs").alias("ps")), "pivot").where(
        F.size("ps") == F.col("pn")).groupBy("pivot", "pn").agg(F.min("ps").alias("ps"))
    near, far = 100 + percent, 100 - percent
    texts = able.join(sets.select(F.col("doc_id").alias("rep"), "hs"), "rep").where(
        F.size("hs") == F.col("n")).join(at_pivot, ["pivot", "pn"]).select(
        "pivot", "pn", "rep", "comp", "apart", "n", F.xxhash64("hs").alias("x"),
        F.concat(F.array_except("hs", "ps"), F.array_except("ps", "hs")).alias("diff"))
    texts = texts.withColumn("m", F.size("diff").cast("long")).withColumn(
        "strong", F.expr(f"m - ({near} * m + {far} * (pn - n)) div {2 * near}")).withColumn(
        "weak", F.expr(f"m - greatest(1, ({near} * m - {far} * (n + pn) + {2 * near - 1}) "
                       f"div {2 * near}) + 1"))
    texts = texts.withColumn("upto", F.when(F.col("apart"), F.greatest("strong", "weak"))
                             .otherwise(F.col("strong")))
    met = texts.select("pivot", "pn", "rep", "comp", "apart", "n", "x", "m", "strong", "upto",
                       F.explode("diff").alias("h")).withColumn(
        "f", F.count(F.lit(1)).over(Window.partitionBy("pivot", "pn", "h")))
    met = written(met.withColumn("q", F.row_number().over(
        Window.partitionBy("pivot", "pn", "rep", "x").orderBy("f", "h"))).where(
        "f > 1 and q <= upto").drop("f"), "near-differences")

    def named(df, x):
        return df.select("pivot", "pn", "h", *(F.col(c).alias(c + x) for c in (
            "rep", "comp", "apart", "n", "m", "q")))

    return named(met.where("q <= strong"), "_a").join(
        named(met.where("apart"), "_b"), ["pivot", "pn", "h"]).where(
        (F.col("comp_a") != F.col("comp_b"))
        & (~F.col("apart_a") | (F.col("rep_a") > F.col("rep_b")))
        & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        & (2 * near * (1 + F.least(F.col("m_a") - F.col("q_a"), F.col("m_b") - F.col("q_b")))
           >= near * (F.col("m_a") + F.col("m_b")) - far * (F.col("n_a") + F.col("n_b")))).select(
        F.greatest("rep_a", "rep_b").alias("a"), F.least("rep_a", "rep_b").alias("b")).distinct()
