import numpy as np
import pytest
from corpus_helpers import sentence

from tidewater.llm import common, near_dups


def sets(rows, size=near_dups.WORDS):
    return [near_dups.shingle_set(near_dups.words_of(t), size) for _, t in rows]


def brute(rows, size=near_dups.WORDS):
    """Component by (id, text); rows with a null id or without a word stand alone."""
    s, parent = sets(rows, size), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(s[a] & s[b])
            if rows[a][0] is not None and rows[b][0] is not None and common and \
                    100 * common >= 80 * (len(s[a]) + len(s[b]) - common):
                parent[find(a)] = find(b)
    comp = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            comp[find(k)] = min(comp.get(find(k), i), i)
    return sorted(((i, len(s[k]), comp.get(find(k)) if i is not None else None,
                    i is None or comp[find(k)] == i) for k, (i, _) in enumerate(rows)), key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=repr)


def variants(base, n, start, edits):
    """Copies of a text with words replaced at places that depend on the copy."""
    out = []
    for k in range(n):
        w = base.split()
        for e in range(edits):
            w[(k * 37 + e * 53) % len(w)] = f"new{k}x{e}"
        out.append((start + k, " ".join(w)))
    return out


def test_groups_against_brute_force(make_docs, edge_rows):
    rows = edge_rows + variants(sentence(5, 200), 25, 100, 3) + variants(
        sentence(5, 200), 10, 200, 14) + variants(sentence(9, 120), 12, 300, 8) + [
        (400 + k, sentence(50 + k, 30)) for k in range(20)] + [
        (500, sentence(5, 200).upper()), (501, sentence(5, 200).replace(" ", "\n\t")),
        (502, "one"), (503, "one"), (504, "two words"), (505, "Two  WORDS")]
    assert result(near_dups.groups(make_docs(rows))) == brute(rows)


def test_chain_is_one_group(make_docs):
    # each text is linked with its neighbours only
    words = sentence(3, 400).split()
    words = [f"{w}{k}" for k, w in enumerate(words)]
    rows = [(50 - k, " ".join(words[k * 8:k * 8 + 120])) for k in range(20)]
    found = near_dups.groups(make_docs(rows))
    assert result(found) == brute(rows)
    assert {r.component_id for r in found.collect()} == {31}


def test_same_through_joins_of_ids(make_docs, edge_rows, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    assert result(near_dups.groups(make_docs(edge_rows))) == brute(edge_rows)


def test_empty_table(make_docs, edge_rows):
    assert near_dups.groups(make_docs(edge_rows).limit(0)).count() == 0


def test_permutations_are_permutations():
    first, second = near_dups.permutations()
    n = near_dups.PLACES
    assert np.array_equal(np.sort(first), np.arange(n))
    assert np.array_equal(np.sort(second[:n]), np.arange(n))
    assert np.array_equal(second[n:], second[:near_dups.BANDS * near_dups.ROWS])


def test_signature_is_the_least_shifted_value_and_estimates_similarity():
    signer = near_dups.Signer()
    a = signer.shingles(near_dups.words_of(" ".join(f"w{k}" for k in range(1000))))
    b = signer.shingles(near_dups.words_of(" ".join(f"w{k}" for k in range(100, 1100))))
    sign = signer.signature([a, b])
    for k in (0, 1, 17, 239):
        places = (signer.first[(a % near_dups.PLACES).astype(int)] + k) % near_dups.PLACES
        assert sign[0, k] == signer.second[places].min()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((sign[0] == sign[1]).mean() - true) < 0.1


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8)],
                                   [(k, k + 1) for k in range(1, 64)], [(7, 7)],
                                   [(100, k) for k in range(1, 30)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    parent = {x: x for e in edges for x in e}
    for _ in range(len(parent)):
        for a, b in edges:
            m = min(parent[a], parent[b])
            parent[a] = parent[b] = m
    want = {x: p for x, p in parent.items() if any(x in e and e[0] != e[1] for e in edges)}
    got = {r.id: r.comp for r in near_dups.components(df).collect()}
    assert got == want


def test_far_copies_without_their_original(make_docs):
    # copies of a text that is not there: some pairs reach the share, most come close
    rows = variants(sentence(21, 90), 60, 600, 5)
    rows += [(700 + k, t + f" tail{k % 4}") for k, (_, t) in enumerate(variants(
        sentence(21, 90), 30, 0, 6))]
    assert result(near_dups.groups(make_docs(rows))) == brute(rows)
    from unittest import mock
    with mock.patch.object(near_dups, "RARE", 2):
        assert result(near_dups.groups(make_docs(rows))) == brute(rows)


@pytest.fixture
def tags(monkeypatch):
    """Tags of the tables that are written."""
    found, write = [], near_dups.written
    monkeypatch.setattr(near_dups, "written", lambda df, tag: found.append(tag) or write(df, tag))
    return found


def test_stars_need_no_round(spark, tags):
    df = spark.createDataFrame([(1, 2), (3, 1), (5, 9), (2, 1)], "a long, b long")
    got = {r.id: r.comp for r in near_dups.components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 9: 5}
    assert tags == ["near-links"]


def test_components_are_kept_where_no_link_is_new(make_docs, tags, monkeypatch):
    released = []
    monkeypatch.setattr(near_dups, "release", released.append)
    # pivots find all links; pairs compared afterwards are no links
    rows = variants(sentence(5, 200), 12, 100, 3) + variants(sentence(5, 200), 10, 200, 14)
    assert result(near_dups.groups(make_docs(rows))) == brute(rows)
    assert tags.count("near-verified") > tags.count("near-components")
    assert len(released) == tags.count("near-components")


@pytest.fixture
def compared(monkeypatch):
    """Pairs compared by their texts."""
    found, verify = [], near_dups.verified

    def count(pairs, *args, **kw):
        found.extend((r.a, r.b) for r in pairs.collect())
        return verify(pairs, *args, **kw)
    monkeypatch.setattr(near_dups, "verified", count)
    return found


def edited(base, n, start, edits, seed, drop=False):
    """Copies of a text with words replaced by others of 6, or dropped, at random places."""
    rng, out = np.random.default_rng(seed), []
    for k in range(n):
        w = base.split()
        for p in rng.choice(len(w), edits + k % 3, replace=False):
            w[p] = "" if drop else f"other{rng.integers(6)}"
        out.append((start + k, " ".join(w)))
    return out


def test_far_copies_are_not_compared_in_all_pairs(make_docs, compared, monkeypatch):
    monkeypatch.setattr(near_dups, "RARE", 1)
    base = " ".join(f"w{k % 97}x{k}" for k in range(150))
    far = edited(base, 150, 1000, 10, 1)
    rows = [(1, base)] + edited(base, 30, 100, 4, 2) + far
    assert result(near_dups.groups(make_docs(rows), size=2)) == brute(rows, 2)
    # all pairs of the far copies are 11,175; most of these were compared by their texts once
    assert len(compared) < 25 * len(rows)


@pytest.mark.parametrize("size,edits", [(2, 9), (5, 4)])
def test_links_between_far_copies(make_docs, monkeypatch, size, edits):
    monkeypatch.setattr(near_dups, "RARE", 1)
    base = " ".join(f"w{k}" for k in range(150))
    far = edited(base, 25, 1000, edits, 3) + edited(base, 25, 2000, 2 * edits, 4, drop=True)
    # copies of far copies: linked with these, and few with the base
    rows = [(5000, base)] + far + [(3000 + k, t) for i in range(0, 50, 4) for k, t in edited(
        far[i][1], 2, 10 * i, edits // 2, 5 + i)]
    assert result(near_dups.groups(make_docs(rows), size=size)) == brute(rows, size)
