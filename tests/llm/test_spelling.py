"""Spelling variants against all pairs of words."""

import itertools
import random
import zlib
import re
from collections import Counter

import numpy as np
import pytest

from isobar.llm import spelling


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(counts, ratio=10):
    words = sorted(counts)
    links = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and near(a, b):
            links[a].append(b)
            links[b].append(a)
    best = {w: min(o, key=lambda x: (-counts[x], x)) for w, o in links.items() if o}
    form = {w: b for w, b in best.items() if counts[b] >= ratio * counts[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, form.get(w), root(w), counts[w], len(links[w]), counts[form[w]] if w in form else None) for w in words)


def words_around(rng, n, alphabet="abé", size=(1, 9)):
    out = {}
    while len(out) < n:
        out["".join(rng.choices(alphabet, k=rng.randrange(*size)))] = rng.choice([1, 2, 3, 20, 30, 200, 300, 2000, 40000])
    return out


@pytest.mark.parametrize("split", [2048, 7])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, monkeypatch, seed, split):
    """Words so alike that most have many near ones, whose blocks overlap and, at seven words a part, are dealt out."""
    monkeypatch.setattr(spelling, "SPLIT", split)
    counts = words_around(random.Random(seed), 400)
    counts |= {"x" * 3000: 4, "x" * 3001: 50, "x" * 1500 + "y" + "x" * 1500: 2, "y" + "x" * 3000: 2}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = spelling.spelling_variants(words).collect()
    assert sorted(map(tuple, rows)) == expected(counts)


def test_words_are_counted_by_document(spark):
    rng = random.Random(4)
    made = ["".join(rng.choices("abcÀé", k=rng.randrange(5, 12))) for _ in range(300)]
    docs = [(k, " ".join(rng.choices(made, k=60)) + " ABCDEFGH, it's×ok_abcdefgh9abcdefgh") for k in range(100)] + [(None, None)]
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    wanted = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    found = spelling.word_counts(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["word"]: r["n"] for r in found} == wanted


def test_chains_of_forms(spark):
    """Each word a tenth as frequent as the next, one letter apart."""
    words = ["a" * k + "b" * (20 - k) for k in range(12)]
    df = spark.createDataFrame([(w, 10**k) for k, w in enumerate(words)], "word string, n long")
    assert {r["root"] for r in spelling.spelling_variants(df).collect()} == {words[-1]}


def test_distances_are_exact_for_long_words():
    words = ["a" * 5000 + "b", "a" * 5001, "a" * 4999 + "bb", "a" * 4998 + "bbb"]
    counts = spelling.counted(spelling.letters(words))
    pairs = {(int(a), int(b)) for x, y in spelling.candidates(counts, np.zeros(4, int)) for a, b in zip(x, y, strict=True)}
    assert counts.dtype == np.float64 and pairs == {(0, 1), (0, 2), (2, 3)}


def test_bundles_hold_whole_shares():
    rng = np.random.default_rng(1)
    share = np.sort(rng.integers(0, 300, 4000))
    size = rng.integers(1, 9, 4000)
    size[77] = 1 << 21  # a word so long that its share stays alone
    cuts = list(spelling.bundles(share, size))
    assert [a for a, _ in cuts[1:]] == [b for _, b in cuts[:-1]] and (cuts[0][0], cuts[-1][1]) == (0, 4000)
    assert all(share[a] != share[a - 1] for a, _ in cuts[1:])
    assert sum(b - a > spelling.ROWS for a, b in cuts) == 0 and len(cuts) < 15
    alone = [(a, b) for a, b in cuts if a <= 77 < b]
    assert len({int(s) for s in share[alone[0][0] : alone[0][1]]}) == 1
    assert list(spelling.bundles(share[:0], size[:0])) == []
