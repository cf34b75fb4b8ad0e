import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus_helpers import WORDS, sentence

from tidewater.llm import collocations


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute(rows, low, share=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for size in (1, 2, 3):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i:i + size])] += 1
    out = []
    for lang in n:
        mine = []
        for (l_, p), a in f.items():
            if l_ != lang or len(p) == 1 or a < low:
                continue
            if len(p) == 2 and any(
                    q_l == lang and len(q) == 3 and b >= low and p in (q[:2], q[1:])
                    and 100 * b >= share * a for (q_l, q), b in f.items()):
                continue
            cuts = [(10 ** 6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k)
                    for k in range(1, len(p))]
            score, k = min(cuts)
            mine.append((-score, -a, " ".join(p).encode(), a, f[lang, p[:k]], f[lang, p[k:]],
                         n[lang], score))
        for rank, m in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, m[2].decode(), *m[3:]))
    return sorted(out)


def mined(docs, **how):
    return sorted(tuple(r) for r in collocations.mine(docs, **how).collect())


TEXTS = [(i, f"{sentence(i, 30)}. {sentence(i % 5, 9)}, A b C! {sentence(i + 1, 3)}",
          ["en", "de", None][i % 3]) for i in range(60)]


@pytest.mark.parametrize("trigger", [1, 3, 10 ** 9])
def test_matches_brute_force_whatever_the_chunks(make_docs, trigger):
    want = brute([(t, lang) for _, t, lang in TEXTS], 5)
    assert mined(make_docs(TEXTS), min_count=5, trigger=trigger) == want and len(want) > 30


def test_small_memories_change_nothing(make_docs, monkeypatch):
    monkeypatch.setattr(collocations, "BLOOM_BITS", 1 << 10)
    assert mined(make_docs(TEXTS), min_count=4, together=100) == brute([(t, la) for _, t, la in TEXTS], 4)


def test_top_and_ties(make_docs):
    rows = [(i, " ".join(f"{w}{i}" for w in ("x", "y")) + ".", "en") for i in range(30)] * 3
    rows = [(i, t, la) for i, t, la in rows]
    found = mined(make_docs(rows), min_count=3, top=7)
    assert found == brute([(t, la) for _, t, la in rows], 3, top=7)
    assert [r[1] for r in found] == list(range(1, 8))


def test_edges(make_docs, edge_rows):
    rows = [(*r, "en") for r in edge_rows] + [(50, "a\tb  c\x0bd a b c\r\na b c. a", None)] * 3
    rows += [(51, "É é é x" + " la" * 5000, "en"), (52, "A \x00 a b", "en")]
    assert mined(make_docs(rows), min_count=3) == brute([(t, la) for _, t, la in rows], 3)
    assert mined(make_docs([]), min_count=3) == []
    assert mined(make_docs([(1, None), (2, "")]), min_count=1) == []


def chunks_of(text, lang="en"):
    found = collocations.cut(pa.array([lang]), pa.array([text]), trigger=3).to_pylist()
    return [(r["chunk"].split(" "), r["ends"]) for r in found]


def test_chunks_share_pairs_and_own_every_word_once():
    words = [f"{w}{i}" for k in range(40) for i, w in enumerate(sentence(k, 5).split())]
    words = [f"{w}-{i}" for i, w in enumerate(words)]
    chunks = sorted(chunks_of(" ".join(words)), key=lambda c: int(c[0][0].split("-")[1]))
    back = []
    for c, ends in chunks:
        back += c if ends else c[:-collocations.OVERLAP]
    assert back == words and len(chunks) > 5
    for (a, _), (b, _) in zip(chunks, chunks[1:]):
        assert a[-2:] == b[:2]


def test_equal_passages_give_equal_chunks():
    body = sentence(7, 60)
    one = {tuple(c) for c, _ in chunks_of(" ".join(WORDS[:4]) + " " + body)}
    two = {tuple(c) for c, _ in chunks_of(body + " " + " ".join(WORDS[4:9]))}
    assert len(one & two) >= len(one) - 3


def test_bloom_filter_has_every_member(spark):
    rnd = np.random.default_rng(3)
    members = rnd.integers(-2 ** 63, 2 ** 63 - 1, 1000)
    found = collocations.Members.of(spark.createDataFrame([(int(h),) for h in members],
                                                          "hash long"))
    assert found.has(members.view(np.uint64)).all()
    assert found.has(rnd.integers(0, 2 ** 63 - 1, 2000).astype(np.uint64)).sum() < 100


def test_exact_beyond_64_bits(spark):
    big = 4 * 10 ** 9
    one = spark.createDataFrame([("en", "a", big), ("en", "b", big + 1)],
                                "lang string, phrase string, f long")
    two = spark.createDataFrame([("en", "a b", big - 1)], one.schema)
    three = spark.createDataFrame([], one.schema)
    row = collocations.scored({1: one, 2: two, 3: three}).first()
    assert row["score"] == 10 ** 6 * (big - 1) ** 2 // (big * (big + 1))
