import hashlib
import uuid

from corpus_helpers import sentence

from tidewater.llm import sharding
from tidewater.session import shared_dir


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def brute(rows, shards, seed=13):
    """(doc_id, text, source) by shard and slot."""
    def plain(v):
        return "" if v is None else f"={v}"

    keyed = [(plain(src), md5(f"{seed}:{plain(i)}:{plain(src)}:"
                              f"{plain(None if t is None else md5(t))}"), i, t, src)
             for i, t, src in rows]
    placed = []
    for s in {k[0] for k in keyed}:
        mine = sorted((k for k in keyed if k[0] == s), key=lambda k: k[1])
        phase = (int(md5(f"{seed}:{s}")[:8], 16) + 0.5) / 2 ** 32
        first = {}
        for r, k in enumerate(mine):
            r = first.setdefault(k[1], r)
            placed.append(((r + phase) / len(mine), s, k[1], *k[2:]))
    placed.sort(key=lambda p: p[:3])
    out, n = {}, len(placed)
    for p, row in enumerate(placed):
        shard = p * shards // n
        out.setdefault(shard, []).append(row[3:])
    return out


def by_shard(df):
    out = {}
    for r in df.select("shard", "slot", "doc_id", "text", "source").orderBy("shard", "slot") \
            .collect():
        assert r["slot"] == len(out.setdefault(r["shard"], []))
        out[r["shard"]].append((r["doc_id"], r["text"], r["source"]))
    return out


ROWS = [(i, sentence(i, 5), "en", f"s{i % 7 if i % 3 else 0}") for i in range(500)]


def test_matches_brute_force_and_mixture(make_docs, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 40)
    found = by_shard(sharding.interleaved(make_docs(ROWS).repartition(5), shards=7))
    assert found == brute([(i, t, s) for i, t, _, s in ROWS], 7)
    sizes = [len(v) for v in found.values()]
    assert max(sizes) - min(sizes) <= 1
    for s in {r[3] for r in ROWS}:
        share = sum(r[3] == s for r in ROWS) / len(ROWS)
        for v in found.values():
            assert abs(sum(r[2] == s for r in v) - share * len(v)) <= 2


def test_same_result_whatever_the_buckets_and_partitions(make_docs, monkeypatch):
    docs = make_docs(ROWS)
    once = by_shard(sharding.interleaved(docs.repartition(2), shards=6))
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 11)
    assert by_shard(sharding.interleaved(docs.repartition(9), shards=6)) == once


def test_single_rows_of_many_sources_spread(make_docs):
    rows = [(i, "t", "en", f"one-{i}") for i in range(400)]
    found = by_shard(sharding.interleaved(make_docs(rows), shards=4))
    assert sorted(len(v) for v in found.values()) == [100] * 4


def test_edges_repeats_and_null_columns(make_docs, edge_rows):
    rows = [(*r, "en", None if k % 3 else "s") for k, r in enumerate(edge_rows)]
    rows += [(6, sentence(1, 40), "en", "s")] * 5 + [(None, None, None, None)] * 3
    found = sharding.interleaved(make_docs(rows), shards=3)
    assert by_shard(found) == brute([(i, t, s) for i, t, _, s in rows], 3)
    assert [c for c in found.columns if c in ("n_words", "key", "score", "kept", "pos", "label")] \
        == ["n_words", "key", "score", "kept", "pos", "label"]
    assert {r["n_words"] for r in found.collect()} == {"x"}


def test_clashing_names_more_shards_than_rows_and_empty(make_docs, spark):
    docs = make_docs(ROWS[:3])
    twice = docs.selectExpr("*", "'x' AS shard", "'y' AS slot", "1 AS _digest", "2 AS _bucket",
                            "3 AS start", "4 AS copy", "5 AS first")
    found = sharding.interleaved(twice, shards=40)
    assert by_shard(found) == brute([(i, t, s) for i, t, _, s in ROWS[:3]], 40)
    assert {tuple(r) for r in found.select("_digest", "_bucket", "start", "copy", "first")
            .collect()} == {(1, 2, 3, 4, 5)}
    assert sharding.interleaved(make_docs([]), shards=4).count() == 0


def test_files_hold_one_shard_in_slot_order(make_docs, spark):
    path = shared_dir(spark, f"shards-test-{uuid.uuid4().hex}")
    docs = make_docs(ROWS)
    sharding.write_shards(docs, path, shards=4)
    files = sharding.read_shards(spark, path, docs).selectExpr(
        "_metadata.file_path AS f", "_metadata.row_index AS i", "shard", "slot")
    seen = {}
    for r in files.orderBy("f", "i").collect():
        assert seen.get(r["f"], (r["shard"], -1)) < (r["shard"], r["slot"])
        seen[r["f"]] = (r["shard"], r["slot"])
