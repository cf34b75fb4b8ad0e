import pytest
from corpus_helpers import SMALL

from tidewater.llm import licences as L
from tidewater.llm.licence_templates import TEMPLATES


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_every_template_is_found_and_confirmed(model):
    for family, texts in TEMPLATES.items():
        for t in texts:
            n, found = model.scan("Some line.\n" + t.upper() + "\n")
            assert n == 2 and len(found) == 1, t
            line, got, p, similarity = found[0]
            assert (line, got) == (1, family) and p >= L.ACCEPT and similarity == 1.0


def test_other_paragraphs_are_unknown(model):
    for t in ("The licence of the pub was revoked.", "copyright", "the software of the terms",
              "Permission to enter the building was granted to any person without a badge.", "…", ""):
        assert [f for f in model.scan(t)[1] if f[3] >= L.CONFIRM] == []


def test_notices_in_documents(spark, model):
    sf = SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    marks = {"Apache": "Apache License, Version 2.0", "MIT": "MIT License",
             "GPL": "GNU General Public", "CC-BY-NC": "CC BY-NC 4.0"}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in L.scan(docs, model).collect():
        sure = {f.family for f in r.findings if f.confirmed}
        want = {f for f, m in marks.items() if m in texts[r.doc_id]}
        assert sure - {"proprietary"} == want


def test_probabilities_are_calibrated_and_rows_kept(spark, model, make_docs, edge_rows):
    p = model.probabilities(model.known.features(L.words_of("Released under the MIT License.")))
    assert abs(p.sum() - 1) < 1e-9 and model.temperature > 0
    docs = make_docs(edge_rows + [(70, None), (71, "Released under the MIT License.\n" * 3)])
    got = {r.doc_id: r for r in L.scan(docs, model).collect()}
    assert L.scan(docs, model).count() == len(edge_rows) + 2
    assert got[70].n_paragraphs == 0 and got[70].findings == [] and len(got[71].findings) == 3
    assert L.scan(docs.limit(0), model).count() == 0


def test_training_without_a_corpus(make_docs, edge_rows):
    model = L.fit(make_docs(edge_rows).limit(0))
    assert model.scan("Licensed under CC BY 4.0.")[1][0][1] == "CC-BY"
