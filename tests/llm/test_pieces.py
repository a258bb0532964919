import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from motionframes.llm import pieces


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary()


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "x\ny  z\t", "▁", "a▁b", "①②", "é é", "日本語 テキスト", "<s> </s> <0x0A> <unk>", "\x00", "ab" * 3000,
    "aaaa" * 50, "          indented\n    code", "3.14159 == pi", "😀😀 family 👨‍👩‍👧", " x", "İstanbul ǅ",
]


def test_odd_texts(library, vocabulary):
    import numpy as np

    encoder, decoder = pieces.Encoder(vocabulary), pieces.Decoder(vocabulary)
    for text, code in zip(ODD, encoder.encode(ODD)):
        ids = np.frombuffer(code, np.int32)
        assert ids.tolist() == library.encode(text or ""), text
        assert decoder.decode(ids) == (text or "").replace("▁", " "), text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("abtheion \n", max_size=80))
def test_any_text(library, vocabulary, text):
    import numpy as np

    ids = np.frombuffer(pieces.Encoder(vocabulary).encode([text])[0], np.int32).tolist()
    assert ids == library.encode(text)


def test_tables_against_the_library(spark, library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5_000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = pieces.encoded(docs)
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = found.collect()
    assert len(rows) == len(text)
    for r in rows:
        assert r.ids == library.encode(text[r.doc_id]) and r.n_ids == len(r.ids) and r.round_trip
    assert {r.doc_id: r.text for r in pieces.decoded(found).collect()} == text


def test_odd_rows(spark):
    schema = "doc_id long, text string, ids string"
    assert pieces.encoded(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b", "x"), (1, None, None), (1, None, None), (2, "", "")]
    found = pieces.encoded(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.n_ids, r.round_trip) for r in found) == [(0, 2, True), (1, 0, True), (1, 0, True), (2, 0, True)]


def test_ids_outside_the_vocabulary(spark):
    rows = [(1, [5, 10_000_000]), (2, [-1]), (3, [7, None]), (4, None), (5, [])]
    found = {r.doc_id: r.text for r in pieces.decoded(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()}
    assert found == {1: None, 2: None, 3: None, 4: None, 5: ""}
