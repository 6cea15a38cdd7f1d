"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from isobar.llm import (
    chat, decontamination, langid, licenses, lm_scoring, merkle, packing, quality, sentencepieces, simhash, spelling,
    syncmers, toxicity,
)

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LONG = "alpha beta, gamma delta. " * 8000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, score double, block int, node string"
ROWS = [
    (1, "One two three four five six seven.", "en", "a", 1, 9, 0.5, 1, "x"),
    (1, "One two three four five six seven.", "en", "a", 1, 9, 0.5, 1, "x"),
    (2, None, None, None, None, None, None, None, None),
    (3, "", "en", "a", 0, 1, 0.1, 2, None),
    (None, "No id here, but words all the same.", "en", None, 3, 2, 0.2, 3, "y"),
    (5, LONG, "de", "b", 4, 3, 0.3, 4, "z"),
    (6, " \t\n\x0b\x0c\r ", "fr", "b", 4, 3, 0.3, 4, "z"),
    (7, "1 2 3 !? \x1c \U0001F600 İ ퟿ é", "fr", "b", 4, 3, 0.3, 4, "z"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (5, 1, 0), (5, 1, 0), (6, 0, 1), (99, 1, 1)]


@pytest.fixture(scope="module", params=["rows", "empty"])
def tables(request, spark):
    full = request.param == "rows"
    docs = spark.createDataFrame(ROWS if full else [], SCHEMA)
    labels = spark.createDataFrame(LABELS if full else [], "doc_id long, quality int, toxic int")
    items = [(1, "Two three four five six"), (2, None), (3, ""), (3, "alpha beta")]
    bench = spark.createDataFrame(items if full else [], "item_id long, text string")
    return docs, labels, bench


def key(row):
    return tuple((v is not None, v) for v in row)


def ids(df):
    return sorted((r["doc_id"] for r in df.collect()), key=lambda v: (v is not None, v or 0))


def whole(tables):
    return ids(tables[0].select("doc_id"))


def test_lm_scoring(tables):
    docs, *_ = tables
    rows = lm_scoring.score(docs, F.col("doc_id") != 5).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in rows) == sorted((i is not None, i or 0) for i in whole(tables))
    for r in rows:
        assert r["n_tokens"] >= 1 and r["score"] <= 0 and r["base_score"] <= 0
        if r["doc_id"] in (2, 3, 6):
            assert (r["n_tokens"], r["n_known"]) == (1, 1)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    rows = lm_scoring.score(docs, F.lit(False)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows} == {(0, 0, 0.0, 0.0)}


def test_syncmers(tables):
    rows = syncmers.compare_with_next(tables[0]).collect()
    assert ids(tables[0]) == sorted((r["doc_id"] for r in rows), key=lambda v: (v is not None, v or 0))
    same = {r["fingerprint"] for r in rows if r["doc_id"] in (2, 3)}
    assert same <= {""}
    assert all(0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1 for r in rows)
    assert syncmers.anchors(tables[0]).where("position < 0").count() == 0


def test_decontamination(tables):
    docs, _, bench = tables
    found = decontamination.find_leaks(docs, bench)
    kept = decontamination.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    if docs.count():
        assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(1, 1), (1, 1), (5, 3)]
        assert 1 not in ids(kept) and 5 not in ids(kept) and kept.count() == len(ROWS) - 3
        assert decontamination.drop_leaks(docs, bench.limit(0)).count() == len(ROWS)
    else:
        assert found.count() == kept.count() == 0


def test_quality_and_toxicity(tables):
    docs, labels, _ = tables
    scored = quality.score_quality(docs, labels).collect()
    assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    graded = toxicity.score_toxicity(docs, labels).collect()
    assert len(graded) == docs.count()
    assert all(0 <= r["toxicity"]["chance"] <= 1 and r["toxicity"]["severity"] >= 0 for r in graded)
    unlabelled = quality.score_quality(docs, labels.limit(0)).collect()
    assert {r["score"] for r in unlabelled} <= {0.5}
    one_class = quality.score_quality(docs, labels.where("quality = 1")).collect()
    assert all(r["score"] > 0.5 for r in one_class)


def test_packing(tables):
    rows = packing.pack(tables[0], TOKENIZER).collect()
    assert ids(tables[0].select("doc_id").distinct()) == sorted({r["doc_id"] for r in rows}, key=lambda v: (v is not None, v or 0))
    assert all(r["doc_tokens"] == 1 for r in rows if r["doc_id"] in (2, 3, 6))


def test_simhash(tables):
    docs, *_ = tables
    rows = simhash.simhash_components(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] in (2, 3, 6):
            assert (r["fingerprint"], r["component_id"]) == ("0" * 16, 2)
        if r["doc_id"] == 1:
            assert r["component_id"] == 1
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.schema.fieldNames() == docs.schema.fieldNames()
    assert ids(kept) == ([None, 1, 2, 5, 7] if rows else [])


def test_merkle(tables):
    docs, *_ = tables
    rows = merkle.manifest(docs, fields=["doc_id", "text", "source"], keep={"node": F.col("node")}).collect()
    assert sorted(map(str, ids(docs))) == sorted(str(r["doc_id"]) for r in rows)
    assert sorted((r["group"] or "", r["position"]) for r in rows) == (
        [("", 0), ("", 1), ("a", 0), ("a", 1), ("a", 2), ("b", 0), ("b", 1), ("b", 2)] if rows else []
    )
    # The two equal rows are neighbours, and the null id comes first.
    assert {(r["doc_id"], r["position"]) for r in rows if r["doc_id"] in (None, 1)} == ({(None, 0), (1, 0), (1, 1)} if rows else set())
    assert len({r["root"] for r in rows}) == bool(rows)


def test_spelling(tables):
    counted = spelling.word_counts(tables[0], least_n=1)
    rows = spelling.spelling_variants(counted).collect()
    assert {r["word"] for r in rows} == {r["word"] for r in counted.collect()}
    assert not rows or {"letters", "words"}.isdisjoint(r["word"] for r in rows)


def test_sentencepieces(tables):
    docs, *_ = tables
    model = public_tokenizers.path("piece_bpe_32k.model")
    done = sentencepieces.decode(sentencepieces.encode(docs, model), model)
    texts = {str(r["doc_id"]): r["text"] or "" for r in docs.collect()}
    rows = done.collect()
    assert len(rows) == docs.count() and all(r["decoded"] == texts[str(r["doc_id"])] for r in rows)
    assert all(r["ids"] == [] for r in rows if r["doc_id"] in (2, 3))


def test_language(tables):
    docs, *_ = tables
    rows = langid.identify(docs, F.lit(True)).collect()
    assert len(rows) == docs.count()
    assert all(r["lang_pred"] == "und" for r in rows if r["doc_id"] in (2, 3, 6))
    assert all(0 <= r["score"] <= 1 for r in rows)
    none = langid.identify(docs, F.lit(False)).collect()
    assert {r["lang_pred"] for r in none} <= {"und"}


def test_licenses(tables):
    docs, *_ = tables
    rows = licenses.scan_licenses(docs, id_col="doc_id", path=F.col("source")).collect()
    assert len(rows) == docs.count() and all(r["license"] is None for r in rows)


def test_chat(spark):
    turns = [(1, None, None, None), (1, 2, "user", "b"), (1, 2, "user", "a"), (None, 1, "assistant", "x"), (2, 1, "user", "")]
    for rows in (turns, []):
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit(3))
        done = chat.format_conversations(df).withColumn("turns", chat.parsed(chat.formatted(F.col("segments"))))
        got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in done.collect()}
        expected = {1: [("", ""), ("user", "a"), ("user", "b")], None: [("assistant", "x")], 2: [("user", "")]}
        assert got == (expected if rows else {})


def test_pipeline(tables, spark, tmp_path):
    docs, labels, bench = tables
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert "sequence_id" in corpus_pipeline.run(spark, str(tmp_path)).columns
    stage_docs = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        stage_docs = stage(spark, stage_docs, str(tmp_path))
        assert stage_docs.columns == docs.columns and stage_docs.dtypes == docs.dtypes
