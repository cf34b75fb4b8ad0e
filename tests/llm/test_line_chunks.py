from collections import defaultdict

import pytest
from corpus_helpers import sentence

from tidewater.llm import common
from tidewater.llm import line_chunks as L


def brute(rows):
    """(id, text, lines, removed lines, removed chunks) of unique ids."""
    places = defaultdict(list)
    for i, text in rows:
        lines = [] if text is None else text.split("\n")
        for k, line in enumerate(lines):
            if k + 1 < len(lines) and (line + lines[k + 1]).split():
                places[line, lines[k + 1]].append((i is None, i or 0, k, i))
            if len(line.split()) >= L.LONG_WORDS:
                places[line,].append((i is None, i or 0, k, i))
    marked = defaultdict(set)
    for window, found in places.items():
        for _, _, k, i in sorted(found)[1:]:
            marked[i].update(range(k, k + len(window)))
    out = []
    for i, text in rows:
        lines = [] if text is None else text.split("\n")
        drop, n_chunks, run = set(), 0, []
        for k in range(len(lines) + 1):
            if k in marked[i]:
                run.append(k)
            elif run:
                if sum(len(lines[j].split()) for j in run) >= L.MIN_WORDS:
                    drop.update(run)
                    n_chunks += 1
                run = []
        left = [x for k, x in enumerate(lines) if k not in drop]
        out.append((str(i), None if text is None else "\n".join(left), len(lines), len(drop),
                    n_chunks))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), r.text, r.n_lines, r.n_removed_lines, r.n_removed_chunks)
                  for r in df.collect())


def block(seed, n):
    return "\n".join(sentence(seed * 1000 + k, 12) for k in range(n))


def test_against_brute_force(make_docs, edge_rows):
    rows = [r for k, r in enumerate(edge_rows) if k != 6]  # unique ids
    shared = block(1, 30)
    rows += [(20 + k, block(100 + k, 3 + k) + "\n" + shared + "\n" + block(200 + k, 4))
             for k in range(6)]
    rows += [(40, shared), (41, shared), (42, shared + "\n" + shared), (43, block(100, 3)),
             (44, "\n" * 50), (45, "\n" * 50 + "x")]
    got = L.dedup_lines(make_docs(rows))
    want = brute(rows)
    assert result(got) == want
    assert sum(w[3] for w in want) > 150  # most of the shared lines were found
    assert got.columns == make_docs(rows).columns + ["n_lines", "n_removed_lines",
                                                     "n_removed_chunks"]


def test_same_through_shuffled_joins(make_docs, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    rows = [(k, block(300 + k, k) + "\n" + block(5, 20) if k else block(5, 20)) for k in range(6)]
    assert result(L.dedup_lines(make_docs(rows))) == brute(rows)


def test_shared_passage_is_cut_alike_wherever_it_stands(make_docs):
    passage = block(5, 40)
    rows = [(k, block(300 + k, k) + "\n" + passage if k else passage) for k in range(1, 12)]
    got = {r.doc_id: r for r in L.dedup_lines(make_docs(rows)).collect()}
    assert got[1].n_removed_lines == 0
    assert all(got[k].n_removed_lines == 40 for k in range(2, 12))


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 7, 8])
def test_short_passages_inside_other_text_go_whole(make_docs, n):
    rows = [(k, block(400 + k, 3) + "\n" + block(9, n) + "\n" + block(700 + k, 4))
            for k in range(1, 10)]
    got = {r.doc_id: r for r in L.dedup_lines(make_docs(rows)).collect()}
    assert got[1].n_removed_lines == 0
    for k in range(2, 10):
        assert (got[k].n_removed_lines, got[k].n_removed_chunks) == (n, 1)
        assert got[k].text == block(400 + k, 3) + "\n" + block(700 + k, 4)


def test_one_line_needs_many_words(make_docs):
    short, long = sentence(5, L.LONG_WORDS - 1), sentence(6, L.LONG_WORDS)
    rows = [(k, f"{block(500 + k, 2)}\n{short}\n{block(520 + k, 2)}\n{long}\n{block(540 + k, 2)}")
            for k in range(1, 5)]
    got = {r.doc_id: r.n_removed_lines for r in L.dedup_lines(make_docs(rows)).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 1}


def test_few_words_stay_and_overlapping_passages_keep_every_line_once(make_docs):
    a, b, c, d = (sentence(60 + k, 9) for k in range(4))
    rows = [(1, f"{a}\n{b}\n{c}"), (2, f"{b}\n{c}\n{d}"), (3, f"{a}\n{b}\n{c}\n{d}"),
            (4, "x\n\n\n\ny"), (5, "x\n\n\n\ny")]
    got = L.dedup_lines(make_docs(rows))
    assert result(got) == brute(rows)
    texts = {r.doc_id: r.text for r in got.collect()}
    assert (texts[2], texts[3], texts[5]) == (d, "", "x\n\n\n\ny")


def test_clashing_names(make_docs):
    rows = [(k, block(300 + k, 2) + "\n" + block(5, 4)) for k in range(3)]
    docs = make_docs(rows)
    more = docs.selectExpr("*", "1 AS _gone", "2 AS _gone_id", "3 AS _gone_th")
    assert result(L.dedup_lines(more)) == result(L.dedup_lines(docs))
    assert L.dedup_lines(more).first()["_gone_id"] == 2


def test_repeated_rows_lose_the_same_and_empty_table(make_docs):
    rows = [(1, block(1, 20)), (2, block(1, 20)), (2, block(1, 20)), (2, "other text")]
    got = result(L.dedup_lines(make_docs(rows)))
    assert got[1] == got[2] or got[2] == got[3]
    assert len(got) == 4
    assert L.dedup_lines(make_docs(rows).limit(0)).count() == 0
