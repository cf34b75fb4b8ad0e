"""The pipeline against the operators' brute-force versions, stage by stage."""
import corpus_pipeline as C
from corpus_helpers import SMALL, sentence
from test_decontaminate import brute as leaks
from test_line_chunks import brute as lines
from test_near_dups import brute as near

from tidewater.llm import sentence_pieces
from tidewater.llm.common import written
from tidewater.llm.queries import PIECES, op5_minhash


def test_stages_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [(r.item_id, r.text) for r in
             spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = {r.doc_id: r.text for r in docs.collect()}
    lib = sentence_pieces.library(PIECES)
    for name, stage in C.STAGES:
        out = written(stage(spark, docs, SMALL), f"test-{name}")
        got = out.collect()
        ids = {r.doc_id for r in got}
        if name == "language_id":
            want = {i for i, t in rows.items() if any(c.isalpha() for c in t or "")}
            assert ids == want
        elif name == "line_dedup":
            want = {int(i): t for i, t, _, n, _ in lines(sorted(rows.items())) if not n or t.strip()}
            assert {r.doc_id: r.text for r in got} == want
            assert all(r.n_chars == len(r.text) for r in got)
        elif name == "near_dedup":
            assert ids == {i for i, _, _, kept in near(sorted(rows.items())) if kept}
        elif name == "decontamination":
            assert ids == {i for i, _, hit, _ in leaks(sorted(rows.items()), items) if not hit}
        else:
            assert {r.doc_id: r.ids for r in got} == {
                i: lib.encode(t, add_eos=True) for i, t in rows.items()}
            break
        assert out.columns == docs.columns
        docs, rows = out, {r.doc_id: r.text for r in got}


def test_run_on_edge_rows(spark, make_docs, edge_rows, tmp_path):
    clean = [(100 + k, sentence(900 + k, 60)) for k in range(20)]
    rows = edge_rows + clean + [(200, clean[0][1]), (201, "new words " + clean[1][1])]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, sentence(905, 60))], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    got = [r.doc_id for r in C.run(spark, str(tmp_path)).collect()]
    assert {i for i, _ in clean} - {105} <= set(got)
    assert not {1, 2, 3, 8, 7, 105, 200, 201} & set(got)
    assert got.count(6) == 1 and got.count(None) == 1


def test_near_dedup_compares_five_words(spark, make_docs, tmp_path):
    words = [f"w{k}" for k in range(100)]
    far, close = list(words), list(words)
    for k in (20, 50, 80):  # 93 of 105 pairs of words, 81 of 111 runs of five
        far[k] = f"new{k}"
    close[50] = "other"  # 91 of 101 runs of five
    rows = [(1, " ".join(words)), (2, " ".join(far)), (3, " ".join(close))]

    def runs(text, n):
        w = text.split()
        return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)}

    def kept(n):
        linked = {i for i, t in rows for j, u in rows if j < i
                  and len(runs(t, n) & runs(u, n)) >= .8 * len(runs(t, n) | runs(u, n))}
        return {i for i, _ in rows} - linked

    assert (kept(2), kept(5)) == ({1}, {1, 2})
    docs = make_docs(rows)
    assert {r.doc_id for r in C.dedup_documents(spark, docs, SMALL).collect()} == kept(5)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id for r in op5_minhash(spark, str(tmp_path)).collect() if r.kept} == kept(2)


def test_stages_judge_texts_not_ids(spark, make_docs, tmp_path):
    leak, other, near = sentence(31, 60), sentence(32, 60), sentence(33, 60)
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    docs = make_docs([(None, leak), (None, other), (5, leak), (5, other), (None, None)])
    got = C.decontaminate_documents(spark, docs, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted(
        [("None", other), ("5", other), ("None", "None")])
    docs = make_docs([(1, near), (2, near + " tail"), (2, other), (2, other), (3, leak),
                      (3, sentence(34, 60)), (None, near), (None, near), (4, None), (4, "")])
    got = C.dedup_documents(spark, docs, SMALL).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted(
        [("1", near), ("2", other), ("3", leak), ("3", sentence(34, 60)), ("None", near),
         ("None", near), ("4", "None"), ("4", "")])


def test_run_on_an_empty_table(spark, make_docs, tmp_path):
    make_docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, sentence(905, 60))], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_line_stage_without_a_length_column(spark, make_docs):
    docs = make_docs([(k, sentence(1, 60) + "\n" + sentence(2, 60)) for k in range(3)])
    got = C.dedup_lines(spark, docs.drop("n_chars"), SMALL)
    assert [r.doc_id for r in got.collect()] == [0] and "n_chars" not in got.columns
