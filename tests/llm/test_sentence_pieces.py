import hashlib
import random

import pytest
from corpus_helpers import SMALL

from tidewater.llm import sentence_pieces as S
from tidewater.llm.queries import PIECES


def test_ids_and_texts_equal_the_library_on_random_strings():
    v, lib, rnd = S.vocabulary(PIECES), S.library(PIECES), random.Random(4)
    chars = "ab e  ▁\n\t\r\0éßñ漢字😀'\".,!1239²½_<s></s><0x41>ıİΣσς​﻿́�"
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += [" " * k + "x" + " " * k for k in range(40)] + ["a" * 3000, "=" * 3000, "漢字" * 500]
    for t in texts:
        ids = lib.encode(t, add_eos=True)
        assert v.encode(t) == ids
        assert v.decode(ids) == lib.decode(ids)


def test_decoding_equals_the_library_on_random_ids():
    v, lib, rnd = S.vocabulary(PIECES), S.library(PIECES), random.Random(5)
    for _ in range(3000):
        ids = [rnd.choice([0, 1, 2, 3 + rnd.randint(0, 255), rnd.randint(259, 31999), 29871])
               for _ in range(rnd.randint(0, 9))]
        assert v.decode(ids) == lib.decode(ids)


def test_whole_table_checked_in_batches_and_round_trip(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = S.encode_texts(docs, PIECES, check_with_library=True)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in got.collect():
        assert r.decoded == texts[r.doc_id] and r.n_tokens == len(r.ids)
    again = S.decode_ids(got, PIECES)
    assert {r.doc_id: r.decoded for r in again.collect()} == texts


def test_edge_rows(make_docs, edge_rows):
    got = S.encode_texts(make_docs(edge_rows), PIECES, check_with_library=True).collect()
    assert len(got) == len(edge_rows)
    empty = next(r for r in got if r.doc_id == 1)
    assert (empty.ids, empty.n_tokens, empty.decoded) == ([2], 1, "")
    assert empty.ids_sha256 == hashlib.sha256(b"2").hexdigest()
    assert sorted((str(r.doc_id), r.decoded) for r in got) == sorted(
        (str(i), t or "") for i, t in edge_rows)
    assert S.encode_texts(make_docs(edge_rows).limit(0), PIECES).count() == 0


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(PIECES, "rb").read())
    model.trainer_spec.model_type = 1
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        S.MergeVocabulary(str(tmp_path / "m"))


def test_query_and_stage_check_with_the_library(spark, monkeypatch):
    import corpus_pipeline as C
    from tidewater.llm import queries as Q
    seen = []
    monkeypatch.setattr(S, "encode_texts", lambda *a, **k: seen.append(k["check_with_library"]))
    Q.op9_sentence_pieces(spark, SMALL)
    C.encode(spark, None, SMALL)
    assert seen == [True, True]


def test_other_operators_empty_the_memory_of_a_worker(spark):
    import weakref

    from tidewater.llm import language_id as L
    from tidewater.llm import near_dups as N
    gone = weakref.ref(S.vocabulary(PIECES))
    S.forget()
    assert gone() is None and S.vocabulary.cache_info().currsize == 0

    def held(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([S.vocabulary.cache_info().currsize] * len(b))], names=["n"])

    docs = spark.createDataFrame([(1, "Some words of a text.")], "doc_id long, text string").coalesce(1)
    model = L.LanguageModel(["en"], ["a"], L.np.full((2, 1), 0.5))
    for other in (lambda: L.identify(docs, model), lambda: N.signatures(docs)):
        S.encode_texts(docs, PIECES).collect()
        other().collect()
        assert docs.mapInArrow(held, "n long").first()["n"] == 0
