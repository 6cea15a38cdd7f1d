"""The pipeline, stage by stage, against plain versions of its decisions."""

import itertools
import math

import numpy as np
import pytest

import corpus_pipeline
from isobar.llm import decontamination, packing, quality, simhash, toxicity
from isobar.llm.components import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(documents in, documents out) by stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        result = written(stage(spark, docs, SF), name)
        out[name] = ([r.asDict() for r in docs.collect()], [r.asDict() for r in result.collect()])
        docs = result
    return out


def kept(rows):
    return sorted(r["doc_id"] for r in rows)


def labels(spark, column):
    return dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", column).collect())


def test_names_and_columns(stages):
    assert list(stages) == ["toxicity", "quality", "near_duplicates", "decontamination", "packing"]
    columns = {frozenset(r) for name, (_, after) in stages.items() if name != "packing" for r in after}
    assert columns == {frozenset(["doc_id", "text", "lang", "source", "n_chars"])}
    for before, after in list(stages.values())[:-1]:
        by_id = {r["doc_id"]: r for r in before}
        assert all(by_id[r["doc_id"]] == r for r in after)


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    truth = labels(spark, "toxic")
    known = sorted((str(r["doc_id"]), truth[r["doc_id"]], r["text"]) for r in before if truth.get(r["doc_id"]) is not None)
    rows, toxic = [toxicity.features(t) for *_, t in known], np.array([c for _, c, _ in known])
    model = toxicity.fit(rows, toxicity.severity_grades(rows, toxic))
    stay = [r["doc_id"] for r in before if toxicity.chances(model, toxicity.features(r["text"]))[0] < toxicity.REJECT_AT]
    assert kept(after) == sorted(stay)


def test_quality(spark, stages):
    before, after = stages["quality"]
    truth = labels(spark, "quality")
    known = sorted((str(r["doc_id"]), truth[r["doc_id"]], r["text"]) for r in before if truth.get(r["doc_id"]) is not None)
    known = sorted((i, c, quality.features(t).tobytes()) for i, c, t in known)
    model = quality.fit([np.frombuffer(f, np.int32) for *_, f in known], np.array([c for _, c, _ in known]))
    assert kept(after) == sorted(r["doc_id"] for r in before if quality.probability(model, quality.features(r["text"])) >= 0.5)


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    found = {r["doc_id"]: simhash.majority(simhash.shingle_hashes(r["text"].encode(), 3)) & (1 << 64) - 1 for r in before}
    root = {i: i for i in found}
    for a, b in itertools.combinations(sorted(found), 2):
        if (found[a] ^ found[b]).bit_count() <= 3:
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    assert kept(after) == sorted({*root.values()}) and len(after) < len(before)


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    items = [decontamination.words_of(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    number = {}
    code = lambda words: [number.setdefault(w, len(number)) for w in words]
    coded = [code(w) for w in items if w]
    clean = []
    for r in before:
        words = code(decontamination.words_of(r["text"]))
        present = set(words)
        # An item cannot match where more of its words are missing than it may have edits.
        near = [x for x in coded if sum(w not in present for w in x) <= math.floor(0.2 * len(x))]
        if not any(words and decontamination.best_window(x, words)[0] <= math.floor(0.2 * len(x)) for x in near):
            clean.append(r["doc_id"])
    assert kept(after) == sorted(clean) and len(clean) < len(before)


def test_packing(stages):
    before, after = stages["packing"]
    public_tokenizers = pytest.importorskip("public_tokenizers")
    own = packing.Encoder(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    ids = {r["doc_id"]: [*own.encode([r["text"].encode()])[0].tolist(), 2] for r in before}
    found = {}
    for r in sorted(after, key=lambda r: r["start"]):
        found.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert found == ids
