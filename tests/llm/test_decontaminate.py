import re

from corpus_helpers import sentence

from tidewater.llm import decontaminate

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(docs, items, window=10):
    out = []
    for i, text in docs:
        w = SPLIT.findall(lower_ascii(text))
        hit, ids = set(), set()
        for item, t in items:
            v = SPLIT.findall(lower_ascii(t))
            if item is None or not v:
                continue
            n = min(window, len(v))
            wins = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)}
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit.update(range(k, k + n))
                    ids.add(str(item))
        out.append((i, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in df.collect()), key=repr)


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, "c") for i, t in items],
                                 "item_id long, text string, pos int, win string")


def test_against_brute_force(spark, make_docs, edge_rows):
    shared = sentence(77, 25)
    items = [(1, shared), (2, "alpha Beta, GAMMA"), (3, "word"), (4, None), (5, ""), (6, "..."),
             (None, sentence(1, 20)), (7, sentence(1, 10)), (7, sentence(1, 10)),
             (8, "beta beta beta beta beta beta beta"), (9, "Straße İstanbul"), (10, "never here")]
    rows = edge_rows + [
        (20, f"before {shared.upper()} after"), (21, shared[:80]), (22, "beta " * 40),
        (23, shared.replace(" ", "-") + "!"), (24, " ".join(shared.split()[3:13])),
        (25, " ".join(shared.split()[3:12])), (26, shared + " x " + shared),
        (27, "STRASSE straße İstanbul ÀLPHA alpha beta gamma")]
    found = decontaminate.contamination(make_docs(rows), items_frame(spark, items))
    assert result(found) == brute(rows, items)


def test_same_through_shuffled_joins(spark, make_docs, edge_rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    items = [(1, sentence(1, 30)), (2, "alpha beta")]
    found = decontaminate.contamination(make_docs(edge_rows), items_frame(spark, items))
    assert result(found) == brute(edge_rows, items)


def test_empty_tables(spark, make_docs, edge_rows):
    none = items_frame(spark, [(1, "x")]).limit(0)
    found = decontaminate.contamination(make_docs(edge_rows), none)
    assert result(found) == brute(edge_rows, [])
    docs = make_docs(edge_rows).limit(0)
    assert decontaminate.contamination(docs, items_frame(spark, [(1, "x y")])).count() == 0
