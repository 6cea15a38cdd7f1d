"""Each operator against a plain version of itself, or by held-out accuracy."""

import hashlib
import itertools
import math
import os
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from isobar.llm import (
    chat, components, decontamination, langid, license_texts, licenses, lm_scoring, packing, quality, queries, simhash, syncmers,
    toxicity,
)
from oracle import connect, differences

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return dict(docs.select("doc_id", "text").collect())


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


# --- language model -----------------------------------------------------------------


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_against_plain_counts(spark, docs, texts, order):
    """Scores by recursion over counts, with the shares of new words that the operator measured."""
    train = F.col("doc_id") % 5 != 0
    rows = lm_scoring.score(docs, train, order=order).collect()
    marked = {i: [0] * (order > 1) + t.encode().lower().split() + [1] for i, t in texts.items()}
    counts = Counter()
    new, seen = Counter(), Counter()
    learned = [m for i, m in marked.items() if i % 5]
    for m in learned:
        for k in range(1, order + 1):
            counts.update(tuple(m[j : j + k]) for j in range(len(m) - k + 1))
    counts[()] = tokens = sum(c for g, c in counts.items() if len(g) == 1 and g != (0,))
    kinds = sum(len(g) == 1 and g != (0,) for g in counts)
    for i, m in marked.items():
        if i % 5:
            for k in range(2, order + 1):
                for j in range(k - 1, len(m)):
                    g = tuple(m[j - k + 1 : j + 1])
                    size = (k, counts[g[:-1]].bit_length() - 1)
                    seen[size] += 1
                    new[size] += counts[g] == 1
    z = {}
    for k in range(2, order + 1):
        own = sorted((s, (new[n, s] + 0.5) / (seen[n, s] + 1)) for n, s in seen if n == k)
        z[k] = np.interp(range(64), *zip(*own))

    def p(context, word):
        if not context:
            return (counts[(word,)] + 1) / (tokens + kinds + 1)
        if not counts[context]:
            return p(context[1:], word)
        share = z[len(context) + 1][counts[context].bit_length() - 1]
        return (1 - share) * counts[context + (word,)] / counts[context] + share * p(context[1:], word)

    for r in rows:
        m = marked[r["doc_id"]]
        first = 1 if order > 1 else 0
        expected = sum(math.log10(p(tuple(m[max(0, j - order + 1) : j]), m[j])) for j in range(first, len(m)))
        assert r["score"] == pytest.approx(expected, rel=1e-9)
        assert r["base_score"] == pytest.approx(
            sum(math.log10((counts[(w,)] + 1) / (tokens + kinds + 1)) for w in m[first:]), rel=1e-9
        )
        assert r["n_tokens"] == len(m) - first and r["n_known"] == sum(counts[(w,)] > 0 for w in m[first:])
        assert r["train_tokens"] == tokens
    if order > 1:
        held = [r for r in rows if r["doc_id"] % 5 == 0]
        assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_chances_after_a_context_sum_to_one():
    texts = ["a b a c", "a b b", *"abc", *(f"a {w}" for w in "abc"), "", "a"]
    block = lm_scoring.read_block(pa.array(texts), np.array([True, True] + [False] * 8), 2)
    totals = [g.count for g in block.grams]
    counted = totals[0][1:]
    own = lm_scoring.Automaton(block, totals, int(counted.sum()), len(counted), [np.full(64, 0.3)])
    start = block.first.tolist()
    for probes, before in (([2, 3, 4, 8], 0), ([5, 6, 7, 9], 1)):
        # Each text up to the word that follows; the last is followed by its end.
        chances = [10 ** (own.walk(start[t], start[t] + 2 + before) - own.walk(start[t], start[t] + 1 + before)) for t in probes]
        # All words that were seen; what is left after backing off is the chance of anything else.
        assert sum(chances) == pytest.approx(1 - 0.3 / (counted.sum() + len(counted) + 1))


def test_keys_come_back_from_their_gaps():
    rng = np.random.default_rng(4)
    for n, buckets in ((1, 1), (5, 3), (4000, 54), (3, 1 << 20)):
        key = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        order, bucket = lm_scoring.request_order(key, buckets)
        for b in set(bucket.tolist()):
            own = key[order][bucket == b]
            assert lm_scoring.unspaced(lm_scoring.spaced(own, buckets), b, buckets).tolist() == own.tolist()


def test_blocks_are_read_as_bytes_are_split():
    texts = ["", " ", " A\tb\x0b\x0cC\r\n ", "É\x1cé\x85x\u3000y", "b  a", "İ A"]
    block = lm_scoring.read_block(pa.array(texts), np.array([True] * len(texts)), 1)
    words = sorted({w for t in texts for w in t.encode().lower().split()})
    lengths = [len(t.encode().lower().split()) + 2 for t in texts]
    assert np.diff(block.first).tolist() == lengths and len(block.grams[0].key) == len(words) + 2
    assert sorted(block.grams[0].key[2:].tolist()) == sorted(xxhash.xxh64_intdigest(w) for w in words)
    assert [block.token[a] for a in block.first[:-1]] == [0] * 6 and [block.token[a - 1] for a in block.first[1:]] == [1] * 6


# --- fingerprints -------------------------------------------------------------------


def test_texts_of_any_length_have_an_anchor():
    rng = random.Random(4)
    for n in range(1, 31):
        texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n)) for _ in range(100)]
        found = [s.tolist() for s in syncmers.sketches(["", *texts, "x" * 40])]
        assert not found[0] and all(found[1:])
        for a, b, x, y in zip(texts, texts[1:], found[1:], found[2:]):
            assert a == b or n < 3 or syncmers.likeness(x, y) < 1
            assert syncmers.likeness(x, found[0]) == 0
    which, place, _ = syncmers.find_anchors(["", *texts])
    assert (np.diff(which) >= 0).all() and (place >= 0).all()


def test_syncmers_by_definition():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdé \U0001F600") for _ in range(400))
    k, s = syncmers.K, syncmers.S
    which, place, value = syncmers.find_anchors([text, "x" + text])
    own = place[which == 0].tolist()
    points = np.array([ord(c) for c in text], dtype=np.uint64)
    h = points[: len(points) - s + 1].copy()
    for j in range(1, s):
        h = h * syncmers.GOLDEN + points[j : len(h) + j]
    h = syncmers.mixed(h).tolist()
    expected = [
        i for i in range(len(text) - k + 1)
        if min(h[i : i + k - s + 1]) in (h[i], h[i + k - s])
    ]
    assert own == expected
    assert {p + 1 for p in own} <= set(place[which == 1].tolist())  # context-free: they move with the text


def test_edited_texts(spark, docs, texts):
    rows = {r["doc_id"]: r for r in syncmers.compare_with_next(docs).collect()}
    order = sorted(texts)
    assert sorted(rows) == order
    for i, after in zip(order, order[1:] + order[:1]):
        text, quarter = texts[i], len(texts[i]) // 4
        edited = text[: len(text) - quarter] + texts[after][:quarter]
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert rows[i]["n_chars"] == len(text)
        assert rows[i]["fingerprint"] == syncmers.fingerprint(syncmers.sketches([text])[0])
        assert rows[i]["edited_fingerprint"] == syncmers.fingerprint(syncmers.sketches([edited])[0])
    long = [r for r in rows.values() if r["n_chars"] > 300]
    assert np.mean([r["near_edited"] for r in long]) > 0.5 > 0.05 > np.median([r["near_next"] for r in long])


def test_one_document_follows_itself(spark):
    df = spark.createDataFrame([(4, "abcdefgh" * 9)], "doc_id long, text string")
    row = syncmers.compare_with_next(df).first()
    assert row["near_next"] == 1.0


# --- decontamination ----------------------------------------------------------------


def edited_words(words, n, rng):
    words = list(words)
    for _ in range(n):
        at = rng.randrange(len(words)) if words else 0
        kind = rng.choice("sid") if words else "i"
        if kind == "s":
            words[at] = f"new{rng.randrange(10**9)}"
        elif kind == "i":
            words.insert(at, f"new{rng.randrange(10**9)}")
        else:
            del words[at]
    return words


def plain_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        below = [i]
        for j, t in enumerate(text, 1):
            below.append(min(row[j] + 1, below[j - 1] + 1, row[j - 1] + (w != t)))
        row = below
    return min(row)


def test_leaks_with_edits_are_found():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for k in range(60)]
    own = decontamination.Items(items, 0.2)
    docs, expected = [], set()
    for d, (k, text) in enumerate(items):
        item = text.split()
        n = math.floor(0.2 * len(item)) + d % 3  # at the limit, or just beyond it
        docs.append(" ".join(rng.choices(words, k=40) + edited_words(item, n, rng) + rng.choices(words, k=40)))
    for d, text in enumerate(docs):
        expected |= {(d, k) for k, t in items if plain_distance(t.split(), text.split()) <= math.floor(0.2 * len(t.split()))}
    found = own.search(docs)
    assert {(f[0], f[1]) for f in found} <= expected
    assert len({(f[0], f[1]) for f in found}) >= 0.98 * len(expected) > 30
    for d, k, start, stop, distance, n in found:
        assert distance == plain_distance(items[k][1].split(), docs[d].split()) and n == len(items[k][1].split())
        window = docs[d].split()[start:stop]
        assert plain_distance(items[k][1].split(), window) == distance


def test_groups_of_items_see_all_documents(spark):
    docs = spark.createDataFrame([(k, f"before {' '.join(f'k{k}w{j}' for j in range(9))} after") for k in range(30)], "doc_id long, text string")
    bench = docs.select(F.col("doc_id").alias("item_id"), "text")
    found = decontamination.find_leaks(docs, bench, group_bytes=300)
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(k, k) for k in range(30)]
    assert decontamination.drop_leaks(docs, bench.where("item_id < 7"), group_bytes=300).count() == 23


def test_whole_items_in_the_corpus(spark):
    found = {(r["doc_id"], r["item_id"]) for r in queries.op3_decontamination(spark, SF).collect()}
    read = lambda t: dict(spark.read.parquet(f"{SF}/{t}.parquet").rdd.map(lambda r: (r[0], r["text"])).collect())
    plain = lambda t: " " + " ".join(decontamination.words_of(t)) + " "
    documents, items = read("documents"), read("benchmark")
    assert {(d, i) for d, t in documents.items() for i, x in items.items() if plain(x) in plain(t)} <= found


# --- chat ---------------------------------------------------------------------------


@pytest.mark.parametrize("segment", [3, 256])
def test_chat_round_trip(spark, monkeypatch, segment):
    monkeypatch.setattr(chat, "SEGMENT", segment)
    rng = random.Random(2)
    parts = ["<|role|>", "<|end|>", "<|turn|>", "<|body|>", "<|", "<", "|", "\\", "\\|", "\n", "text ", "é\U0001F600", "[INST]", "$1", ""]
    rows = [
        (c, t, rng.choice(["user", "assistant", "a<|body|>\\"]), "".join(rng.choices(parts, k=rng.randrange(6))))
        for c in range(30) for t in range(rng.randrange(1, 14))
    ]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "conv_id long, turn long, role string, text string")
    done = chat.format_conversations(df).withColumn("all", chat.formatted(F.col("segments"))).select(
        "conv_id", "all", chat.parsed(F.col("all")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")
    )
    got = {r["conv_id"]: r for r in done.collect()}
    for c, own in itertools.groupby(rows, key=lambda r: r[0]):
        own = [(role, text) for _, _, role, text in own]
        assert [tuple(t) for t in got[c]["turns"]] == own
        assert got[c]["loss"] == "".join(text for role, text in own if role == "assistant")
        runs = sum(1 for _ in itertools.groupby(own, key=lambda t: t[0]))
        assert got[c]["all"].count("<|role|>") == runs and got[c]["all"].count("<|turn|>") == len(own) - runs


# --- classifiers ----------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect())
    rows = [r for r in queries.op5_quality(spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (crc(r["doc_id"], 3) == 1) for r in rows)
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) >= 0.97


def test_dual_descent_against_gradient_descent():
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(30, 6, replace=False)).astype(np.int32) for _ in range(60)]
    y = np.where(np.array([(r < 10).sum() for r in rows]) > 2, 1.0, -1.0)
    ratio = rng.normal(size=30)
    weights, bias = quality.descend(rows, y, ratio, 400, 1.0)
    x = np.zeros((60, 31))
    for k, r in enumerate(rows):
        x[k, r] = ratio[r] / np.linalg.norm(ratio[r])
    x[:, 30] = 1
    share = np.where(y > 0, 60 / (2 * (y > 0).sum()), 60 / (2 * (y < 0).sum()))
    objective = lambda w: 0.5 * w @ w + (share * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()
    w = np.zeros(31)
    for _ in range(20000):
        w -= 0.005 * (w - 2 * x.T @ (share * y * np.maximum(0, 1 - y * (x @ w))))
    assert objective(np.append(weights, bias)) == pytest.approx(objective(w), rel=1e-4)


def test_toxicity_keeps_clean_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").collect())
    rows = [r for r in queries.op7_toxicity(spark, sf).collect() if r["doc_id"] in labels]
    toxic = [r for r in rows if labels[r["doc_id"]]]
    assert np.mean([r["rejected"] for r in toxic]) >= 0.8
    assert np.mean([r["rejected"] for r in rows if not labels[r["doc_id"]]]) <= 0.02
    assert np.mean([r["severity"] for r in toxic]) > 1


def test_ordinal_fit_recovers_grades():
    rng = np.random.default_rng(4)
    rows, grades = [], []
    for _ in range(600):
        bad = rng.integers(0, 4)
        rows.append(np.unique(np.concatenate([rng.choice(3, bad, replace=False), 100 + rng.choice(200, 20)])).astype(np.int32))
        grades.append(bad)
    model = toxicity.fit(rows, np.array(grades), steps=400)
    assert np.all(np.diff(model.thresholds) > 0) and np.all(model.weights[:3] > 1) and np.abs(model.weights[100:300]).max() < 1
    expected = [toxicity.chances(model, r).sum() for r in rows]
    assert np.corrcoef(expected, grades)[0, 1] > 0.95
    assert np.isclose(np.mean(np.round(expected) == grades), 1, atol=0.05)


def test_language_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect())
    rows = [r for r in queries.op10_language_id(spark, sf).collect() if crc(r["doc_id"], 4) == 2]
    assert all(r["held_out"] for r in rows)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows]) >= 0.95
    assert np.mean([r["rejected"] for r in rows]) < 0.1


# --- packing ------------------------------------------------------------------------


def _language_texts(rng, n, size=(40, 120)):
    """Texts of three made languages, each with a vocabulary of its own."""
    makers = {
        lang: ["".join(rng.choices(letters, k=rng.randrange(5, 11))) for _ in range(80)]
        for lang, letters in (("aa", "abcdefgh"), ("bb", "defghijkl"), ("cc", "hijklmnop"))
    }
    return [(k, lang, " ".join(rng.choices(makers[lang], k=rng.randrange(*size)))) for k, lang in enumerate(rng.choices(list(makers), k=n))]


def test_language_by_sizes(spark):
    """Predictions are the smallest sums of compressed parts, by the dictionaries that were learned."""
    import zstandard

    texts = _language_texts(random.Random(5), 200)
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string")
    learned = langid.dictionaries(docs, F.col("doc_id") < 120, "lang", "text")
    found = {r["doc_id"]: r for r in langid.identify(docs, F.col("doc_id") < 120).collect()}
    for k, lang, text in texts:
        sizes = {}
        for name, content in learned.items():
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            packer = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=own, write_content_size=False, write_checksum=False)
            sizes[name] = sum(len(packer.compress(p)) for p in langid.parts_of(langid.plain(text)))
        assert found[k]["lang_pred"] == min(sorted(sizes), key=sizes.get)
    assert sum(found[k]["lang_pred"] == lang for k, lang, _ in texts) >= 0.95 * len(texts)


def test_languages_behind_a_shared_header(spark):
    """Texts that begin alike for longer than a piece: what follows is learned."""
    rng = random.Random(6)
    header = " ".join("".join(rng.choices("qrstuvwxyz", k=6)) for _ in range(800))
    texts = [(k, lang, f"{header} {text}") for k, lang, text in _language_texts(rng, 120, (500, 900))]
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in langid.identify(docs, F.col("doc_id") < 60).collect()}
    held = [found[k] == lang for k, lang, _ in texts if k >= 60]
    assert sum(held) >= 0.95 * len(held)


def test_copies_do_not_starve_a_dictionary(spark):
    rng = random.Random(7)
    own = _language_texts(rng, 300)
    copies = [(1000 + k, "aa", "same words again and again " * 200) for k in range(3000)]
    docs = spark.createDataFrame(own + copies, "doc_id long, lang string, text string")
    learned = langid.dictionaries(docs, F.lit(True), "lang", "text", size=20_000)
    assert len(learned["aa"]) >= 15_000


def test_many_languages_share_the_space(spark, monkeypatch):
    monkeypatch.setattr(langid, "ALL_BYTES", 300_000)
    docs = spark.range(1500).selectExpr(
        "id AS doc_id", "concat('l', id % 150) AS lang",
        "concat_ws(' ', transform(sequence(0, 300), i -> translate(sha2(concat(id % 150, '-', (i * 7 + id) % 90), 256), '0123456789', 'ghijklmnop'))) AS text",
    )
    learned = langid.dictionaries(docs, F.lit(True), "lang", "text")
    assert len(learned) == 150 and max(map(len, learned.values())) <= 2000
    rows = langid.identify(docs, F.lit(True)).join(docs, "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)



def test_word_by_word_is_whole_texts():
    from tokenizers import Tokenizer

    rng = random.Random(6)
    parts = list("abcé'ÀÉñß١٢٣3 \t\n\r\x0b\x0c\x1c\x85\xa0   　.,!?<|>") + [
        "'s", "'LL", "é", "́", "<|endoftext|>", "<|startoftext|>", "Σ", "ς", "İ", "가", "\U0001F600", "word", "don't", "123"
    ]
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(400)] + [""]
    whole = Tokenizer.from_file(TOKENIZER)
    got = packing.Encoder(TOKENIZER).encode([t.encode() for t in texts])
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("limits", [(64, 256, 64), (64, 3, 64), (64, 256, 20), (4096, 256, 4096)])
def test_packing_limits(spark, docs, texts, limits):
    tokens, segments, loss = limits
    rows = packing.pack(docs, TOKENIZER, max_tokens=tokens, max_segments=segments, max_loss=loss).collect()
    ids = dict(zip(texts, (list(x) + [2] for x in packing.Encoder(TOKENIZER).encode([t.encode() for t in texts.values()]))))
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], len(r["ids"]) // 4))
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
    for i, own in pieces.items():
        own.sort()
        assert [s for s, _ in own] == [0, *itertools.accumulate(len(x) for _, x in own)][:-1]
        assert sum((x for _, x in own), []) == ids[i]
    assert set(pieces) == set(ids)
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [0, *itertools.accumulate(n for _, n in own)][:-1]
        total = sum(n for _, n in own)
        assert total <= min(tokens, loss) and len(own) <= segments
        assert total == tokens or total & (total - 1) == 0


def test_prompts_bear_no_loss(spark):
    df = spark.createDataFrame([(k, "a b c d", "p q r s t u v w " * 2) for k in range(50)], "doc_id long, text string, ask string")
    rows = packing.pack(df, TOKENIZER, prompt_col="ask", max_tokens=64, max_loss=8).collect()
    loss = Counter()
    for r in rows:
        loss[r["sequence_id"]] += max(0, r["start"] + len(r["ids"]) // 4 - max(r["start"], 16))
    assert max(loss.values()) <= 8 and sum(loss.values()) == 50 * 5


def test_lm_shares_of_new_words_cover_all_documents(spark, docs, texts):
    train = F.col("doc_id") % 5 != 0
    blocks, buckets = lm_scoring.LEAST_BLOCKS, 8
    rows = lm_scoring.blocks_of(docs, train, "doc_id", "text", blocks)
    answers = components.written(lm_scoring.count_answers(rows, 2, buckets), "answers")
    (got,) = lm_scoring.novelty(rows, answers, 2, buckets)
    marked = [[0, *t.encode().lower().split(), 1] for i, t in texts.items() if i % 5]
    single = Counter(w for m in marked for w in m)
    pairs = Counter(p for m in marked for p in itertools.pairwise(m))
    seen, new = Counter(), Counter()
    for (a, _), n in pairs.items():
        seen[single[a].bit_length() - 1] += n
        new[single[a].bit_length() - 1] += n == 1
    sizes = sorted(seen)
    assert got == pytest.approx(np.interp(range(64), sizes, [(new[x] + 0.5) / (seen[x] + 1) for x in sizes]))


# --- SimHash ------------------------------------------------------------------------


def test_embedding_is_a_lower_bound():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)) ^ rng.integers(0, 8, 500, dtype=np.uint64)
    segments = lambda x: np.array([[int(v) >> (2 * s) & 3 for s in range(32)] for v in x])
    ones = np.array([0, 1, 1, 2])
    manhattan = np.abs(ones[segments(a)] - ones[segments(b)]).sum(axis=1)
    assert np.array_equal(np.bitwise_count(simhash.unary(a) ^ simhash.unary(b)), manhattan)
    assert np.all(manhattan <= np.bitwise_count(a ^ b))


def test_components_of_close_fingerprints(spark, monkeypatch):
    """Random centres with rings of close copies, in small and in split cells, against all pairs."""
    rng = np.random.default_rng(9)
    values = set()
    for centre in rng.integers(0, 1 << 63, 40, dtype=np.uint64):
        values.add(int(centre))
        for _ in range(20):
            for bit in rng.choice(64, rng.integers(1, 5), replace=False):
                values.add(int(centre ^ (np.uint64(1) << np.uint64(bit))))
                centre = centre if rng.random() < 0.8 else centre ^ (np.uint64(1) << np.uint64(bit))
    fp = np.array(sorted(values), dtype=np.uint64)
    root = list(range(len(fp)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k in range(len(fp)):
        for j in np.flatnonzero(np.bitwise_count(fp[k + 1 :] ^ fp[k]) <= 3) + k + 1:
            a, b = sorted((find(k), find(int(j))))
            root[b] = a
    expected = Counter(frozenset(v) for v in _groups([find(k) for k in range(len(fp))], fp.view(np.int64).tolist()))
    nodes = spark.createDataFrame([(int(v), int(v)) for v in fp.view(np.int64)], "node long, fp long")
    for split, small in ((simhash.SPLIT, simhash.SMALL), (4, 2)):
        monkeypatch.setattr(simhash, "SPLIT", split)
        monkeypatch.setattr(simhash, "SMALL", small)
        links = simhash.links(nodes, simhash.exact_grids(3), 3)
        roots = dict(components.components(links, "a", "b").collect())
        got = _groups([roots.get(v, v) for v in fp.view(np.int64).tolist()], fp.view(np.int64).tolist())
        assert Counter(map(frozenset, got)) == expected


def _groups(labels, values):
    groups = {}
    for label, v in zip(labels, values, strict=True):
        groups.setdefault(label, set()).add(v)
    return groups.values()


def test_simhash_query(spark, docs, texts):
    def fingerprint(text):
        words = text.encode().lower().split()
        runs = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [b" ".join(words)] * bool(words)
        hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = {r["doc_id"]: r for r in simhash.simhash_components(docs).collect()}
    own = {i: fingerprint(t) for i, t in texts.items()}
    assert {i: int(r["fingerprint"], 16) for i, r in rows.items()} == own
    for a, b in itertools.combinations(own, 2):
        if (own[a] ^ own[b]).bit_count() <= 3:
            assert rows[a]["component_id"] == rows[b]["component_id"]
    assert all(r["component_id"] <= i for i, r in rows.items())


def _components_by_pairs(fingerprints, bits):
    root = list(range(len(fingerprints)))
    for a, b in itertools.combinations(range(len(fingerprints)), 2):
        if (fingerprints[a] ^ fingerprints[b]).bit_count() <= bits and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = [low if x == high else x for x in root]
    return root


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_one_of_each_component_stays(spark, monkeypatch, broadcast):
    """Groups of long texts with few changed words, whose fingerprints differ in few bits; rows repeat."""
    monkeypatch.setattr(simhash, "BROADCAST_ROWS", broadcast)
    rng = random.Random(8)
    words, texts = [f"w{k}" for k in range(3000)], []
    for _ in range(40):
        base = rng.choices(words, k=rng.randrange(200, 900))
        for _ in range(rng.randrange(1, 6)):
            own = list(base)
            own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    found = [simhash.majority(simhash.shingle_hashes(t.encode(), 3)) & (1 << 64) - 1 for t in texts]
    root = _components_by_pairs(found, 3)
    assert 40 <= len(set(root)) < len(texts) - 20
    rows = [(k, t, k) for k, t in enumerate(texts)]
    # A row that occurs twice, and one that shares id and text with a row that stays but has another mark.
    extra = [rows[0], rows[0], (0, texts[0], None), (len(texts), texts[0], 5)]
    docs = spark.createDataFrame([*rows, *extra], "doc_id long, text string, key long")
    kept = [tuple(r) for r in simhash.drop_near_duplicates(docs).collect()]
    assert sorted(i for i, *_ in kept) == sorted(set(root))
    assert set(kept) <= {*rows, *extra}
    assert sorted(kept, key=str) == sorted((tuple(r) for r in simhash.drop_near_duplicates(docs).collect()), key=str)


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5, 5)]
    roots = dict(components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect())
    assert roots == {**{k: 0 for k in range(201)}, **{1000 + k: 1000 for k in range(300)}}


# --- licences -----------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_queries_match_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name]) == []


def test_licence_inheritance(spark):
    rows = [
        (1, "LICENSE", "Released under the MIT License."), (2, "src/main.c", "int main"), (3, "src/lib/a.c", None),
        (4, "src/lib/COPYING", "Licensed under the Apache License, Version 2.0."), (5, "src/lib/deep/er/b.c", "x"),
        (6, "src/lib/c.c", "word " * 40 + "\nThis work is licensed under the GNU General Public License, version 3."),
        (7, None, "x"), (8, "srcs/x.c", "the mitre of the general public"),
    ]
    got = {
        r["doc_id"]: (r["license"], r["found"], r["line"])
        for r in licenses.scan_licenses(
            spark.createDataFrame(rows, "doc_id long, path string, text string"), id_col="doc_id", path=F.col("path")
        ).collect()
    }
    assert got == {
        1: ("MIT", "own", 0), 2: ("MIT", "inherited", None), 3: ("Apache-2.0", "inherited", None), 4: ("Apache-2.0", "own", 0),
        5: ("Apache-2.0", "inherited", None), 6: ("GPL-3.0", "own", 1), 7: ("MIT", "inherited", None), 8: ("MIT", "inherited", None),
    }


def _scanned(spark, rows, **own):
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    found = licenses.scan_licenses(files, id_col="doc_id", path=F.col("path"), **own).collect()
    return sorted((r["doc_id"], r["license"], r["found"], r["line"]) for r in found)


def test_whole_licence_texts_in_a_tree(spark):
    """Full texts, wrapped anew and with names, declare their directories; one that is only quoted in part doesn't."""
    mit, bsd = license_texts.TEXTS["MIT"], license_texts.TEXTS["BSD-3-Clause"]
    rewrapped = "Copyright (c) 2020 Some Body <some@body.org>\n\n" + "\n".join(textwrap.wrap(mit.split("\n", 2)[2], 50))
    rows = [
        (1, "LICENSE", rewrapped), (2, "src/a.c", "int main"), (3, "vendor/bsd/COPYING", "Copyright Jane Doe\n" + bsd),
        (4, "vendor/bsd/x/y.c", ""), (5, "vendor/z.c", "// " + mit[:200]), (6, "two/A", mit), (7, "two/B", license_texts.TEXTS["BSD-2-Clause"]),
        (8, "two/c.c", "x"), (8, "two/c.c", "x"), (9, "long/LICENSE", mit + "\n" + "other words here " * 60_000), (10, "long/d.c", "x"),
    ]
    assert _scanned(spark, rows) == [
        (1, "MIT", "own", None), (2, "MIT", "inherited", None), (3, "BSD-3-Clause", "own", None), (4, "BSD-3-Clause", "inherited", None),
        (5, "MIT", "own", 0), (6, "MIT", "own", None), (7, "BSD-2-Clause", "own", None),
        # Both texts are exact; the first by name counts.
        (8, "BSD-2-Clause", "inherited", None), (8, "BSD-2-Clause", "inherited", None),
        # Its first line names a licence, but it is no licence text.
        (9, "MIT", "own", 0), (10, "MIT", "inherited", None),
    ]


@pytest.mark.skipif(not os.path.exists("/usr/share/common-licenses/GPL-3"), reason="no licence texts here")
def test_long_licence_texts_as_a_parameter(spark):
    texts = {n: open(f"/usr/share/common-licenses/{f}", encoding="utf-8").read()
             for n, f in (("GPL-3.0", "GPL-3"), ("GPL-2.0", "GPL-2"), ("Apache-2.0", "Apache-2.0"), ("MPL-2.0", "MPL-2.0"), ("LGPL-3.0", "LGPL-3"))}
    rows = [(k, f"{n}/LICENSE", f"Copyright {k}\n" + "\n".join(textwrap.wrap(t, 60))) for k, (n, t) in enumerate(texts.items())]
    rows += [(10 + k, f"{n}/deep/x.c", "int x;") for k, n in enumerate(texts)]
    assert _scanned(spark, rows, texts=texts) == [
        *[(k, n, "own", None) for k, n in enumerate(texts)], *[(10 + k, n, "inherited", None) for k, n in enumerate(texts)]
    ]


def test_headers_that_wrap_and_tie(spark):
    notice = "Released under the MIT License"
    rows = [
        (1, "a.c", "int x;\n# This work is licensed under the GNU\n# General Public License,\n# version 3\n" + "more " * 30),
        (2, "b/c.c", "// Licensed under the Apache\n// License, Version 2.0\n" + "y " * 50), (3, "b/d.c", "z"),
        (4, "t.c", f"{notice}\n{'w ' * 40}\n{notice}"), (5, None, None),
    ]
    assert _scanned(spark, rows) == [
        (1, "GPL-3.0", "own", 1), (2, "Apache-2.0", "own", 0), (3, None, None, None), (4, "MIT", "own", 0), (5, None, None, None),
    ]


@pytest.mark.parametrize("templates,least", [(license_texts.NOTICES, licenses.LEAST), (license_texts.TEXTS, licenses.LEAST_FILE)])
def test_marks_lose_no_match(templates, least):
    vectors, _, _ = licenses.template_weights(templates)
    marks = set(licenses.marking_words(vectors, least))
    for name, vector in vectors.items():
        assert math.sqrt(sum(v * v for w, v in vector.items() if w not in marks)) < least, name
    assert all(re.fullmatch("[a-z0-9]+", w) for w in marks)
