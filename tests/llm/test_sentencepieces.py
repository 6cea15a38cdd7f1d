"""Ids and texts against the library on whole texts."""

import random

import pytest
from hypothesis import given, settings, strategies as st

from isobar.llm import sentencepieces

public_tokenizers = pytest.importorskip("public_tokenizers")
spm = pytest.importorskip("sentencepiece")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = spm.SentencePieceProcessor(model_file=MODEL)
PARTS = [" ", "  ", "▁", "a", "the", "ing", "é", "é", "\n", "\t", "日本", "😀", "\x00", "�", "</s>", "<0x41>", "ﬁ", "　", " ", "1", "क्"]


@pytest.fixture
def small_table():
    """Generations so small that words go and come back."""
    return sentencepieces.ChunkTable(MODEL, generation=20)


def ids_of(encoded):
    return [int.from_bytes(encoded[k : k + 4], "little") for k in range(0, len(encoded), 4)]


def test_texts_of_odd_parts(small_table):
    rng = random.Random(1)
    for _ in range(2000):
        texts = ["".join(rng.choices(PARTS, k=rng.randrange(15))) for _ in range(3)]
        for text, found in zip(texts, small_table.encode(texts), strict=True):
            ids = ids_of(found)
            assert ids == LIBRARY.encode(text)
            assert small_table.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    table = sentencepieces.chunk_table(MODEL)
    assert ids_of(table.encode([text])[0]) == LIBRARY.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, LIBRARY.get_piece_size() - 1) | st.integers(0, 300)))
def test_any_ids(ids):
    assert sentencepieces.chunk_table(MODEL).decode(ids) == LIBRARY.decode(ids)


def test_ids_of_no_piece_are_refused(small_table):
    for ids in ([-1], [LIBRARY.get_piece_size()]):
        with pytest.raises(ValueError):
            small_table.decode(ids)


def test_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    done = sentencepieces.decode(sentencepieces.encode(docs, MODEL), MODEL).collect()
    assert len(done) == len(texts)
    for r in done:
        assert r["ids"] == LIBRARY.encode(texts[r["doc_id"]]) and r["decoded"] == LIBRARY.decode(r["ids"])


def test_clashing_names_and_null_ids(spark):
    rows = spark.createDataFrame([(1, [264, 287], "old", "t"), (2, None, None, None)], "a long, ids array<int>, decoded string, text string")
    assert [tuple(r) for r in sentencepieces.decode(rows, MODEL).sort("a").collect()] == [(1, [264, 287], "t", "a b"), (2, None, None, "")]
