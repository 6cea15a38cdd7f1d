"""Benchmark decontamination by an edit-to-Hamming embedding.

A document is contaminated by an item if some window of its words lies within
``floor(edits * n)`` word edits of the item's n words (words: runs of letters and digits, lower case).

The embedding (a random walk, after Chakraborty, Goldenberg and Koucky): a pointer runs over a word sequence for
3n steps; each step writes the word under it and moves on or stays by a random bit of (step,
word). Walks over two sequences fall into step again soon after an edit, so few edits become few
differing places. Sampling a few places gives a key; several walks with several samples each give the
keys of an item, and of each window that is as long as the item. A window that shares a key with an item is
a candidate, and the exact edit distance decides.

Only windows that can match are embedded. An edit changes at most q runs of q words, so of any
q * k + 1 runs of an item, k edits leave one as it is: a matching window holds one of that many runs,
those with the most letters, within k places of where the item has it. That loses no window. Runs have
three words where the item has enough of them.

Benchmark items are taken in groups of at most ``GROUP_BYTES``, sent to the tasks one group after
another; every group sees all documents. Nothing is shuffled. Items without words match nothing;
an item of fewer than 1 / edits words has to occur as it is. Null texts are empty. Repeated
documents or items each give their own rows.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from isobar.llm.common import GOLDEN, col, id_type, mixed, slices, text_of, total_bytes

EDITS = 0.2
WALKS, SAMPLES, PLACES = 6, 8, 3
GROUP_BYTES = 4 << 20
SLICE_BYTES = 4 << 20
WORD = re.compile(r"\w+")
PAST_END = np.uint64(0)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def walk_keys(symbols: np.ndarray) -> np.ndarray:
    """Keys of rows of word hashes (0 past the end): one column for each walk and sample."""
    rows, width = symbols.shape
    padded = np.hstack([symbols, np.zeros((rows, 1), dtype=np.uint64)])
    flat, base = padded.ravel(), np.arange(rows) * (width + 1)
    lengths = np.count_nonzero(symbols, axis=1)
    keys = np.zeros((rows, WALKS * SAMPLES), dtype=np.uint64)
    for walk in range(WALKS):
        dice = np.random.default_rng(walk)
        seeds = dice.integers(0, 1 << 63, size=3 * width, dtype=np.uint64)
        # Places are drawn by share of a row's own 3n steps, so that they do not depend on other rows.
        shares = dice.random((SAMPLES, PLACES))
        wanted = np.floor(shares[None] * 3 * lengths[:, None, None]).astype(np.int64)
        written = np.zeros((rows, 3 * width), dtype=np.uint64)
        at = np.zeros(rows, dtype=np.int64)
        for step in range(3 * width):
            symbol = flat[base + at]
            written[:, step] = symbol
            move = (mixed(symbol + seeds[step]) & np.uint64(1)).astype(np.int64)
            at = np.minimum(at + move, lengths)
        for sample in range(SAMPLES):
            key = np.full(rows, walk * SAMPLES + sample + 1, dtype=np.uint64)
            for place in range(PLACES):
                key = mixed(key * GOLDEN + written[np.arange(rows), wanted[:, sample, place]])
            keys[:, walk * SAMPLES + sample] = key
    return keys


def best_window(item: list[int], words: list[int]) -> tuple[int, int, int]:
    """(distance, start, stop) of the window with the fewest edits; of those the first to end and then the
    shortest. Edits as usual: a word put in, left out or replaced."""

    def ends(pattern: np.ndarray, text: np.ndarray, anywhere: bool) -> np.ndarray:
        ramp = np.arange(len(text) + 1)
        row = np.zeros(len(text) + 1, dtype=np.int64) if anywhere else ramp.copy()
        for k, w in enumerate(pattern, 1):
            below = np.minimum(row[1:] + 1, row[:-1] + (text != w))
            below = np.concatenate([[row[0] + 1 if not anywhere else k], below])
            row = np.minimum.accumulate(below - ramp) + ramp
        return row

    pattern, text = np.array(item), np.array(words)
    found = ends(pattern, text, True)
    stop = int(found.argmin())
    back = ends(pattern[::-1], text[:stop][::-1], False)
    return int(found[stop]), stop - int(np.flatnonzero(back == found[stop])[0]), stop


class Items:
    """A group of benchmark items, ready to be searched for."""

    def __init__(self, items: list[tuple[object, str]], edits: float) -> None:
        self.ids, self.words, self.allowed = [], [], []
        # By first word, runs of words with (item, place).
        self.anchors: dict[str, dict[tuple, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for key, text in items:
            words = words_of(text)
            if not words:
                continue
            k, allowed = len(self.ids), math.floor(edits * len(words))
            self.ids.append(key)
            self.words.append(words)
            self.allowed.append(allowed)
            n = next(q for q in (3, 2, 1) if len(words) - q + 1 > q * allowed)
            places = sorted(range(len(words) - n + 1), key=lambda p: (-sum(map(len, words[p : p + n])), p))
            for at in places[: n * allowed + 1]:
                self.anchors[words[at]][tuple(words[at : at + n])].append((k, at))
        self.width = max(map(len, self.words), default=1)
        keys = walk_keys(self.padded([hashed(w) for w in self.words])) if self.words else np.zeros((0, 1), np.uint64)
        self.keys, self.of_key = keys.ravel(), np.repeat(np.arange(len(keys)), keys.shape[1])
        order = np.argsort(self.keys, kind="stable")
        self.keys, self.of_key = self.keys[order], self.of_key[order]

    def padded(self, rows: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(rows), self.width), dtype=np.uint64)
        for k, row in enumerate(rows):
            out[k, : len(row)] = row
        return out

    def windows(self, words: list[str]) -> dict[tuple[int, int], set[int]]:
        """(start, length) of the windows that may match, with the items of that length."""
        out: dict[tuple[int, int], set[int]] = defaultdict(set)
        anchors = self.anchors
        for at in [i for i, w in enumerate(words) if w in anchors]:
            here = anchors[words[at]]
            for n in (1, 2, 3):
                for k, place in here.get(tuple(words[at : at + n]), ()):
                    for start in range(max(at - place - self.allowed[k], 0), at - place + self.allowed[k] + 1):
                        if start < len(words):
                            out[start, len(self.words[k])].add(k)
        return out

    def search(self, texts: list[str]) -> list[tuple]:
        """(number of the text, item id, start, stop, distance, words of the item)."""
        docs = [words_of(t) for t in texts]
        wanted = [(d, key, ks) for d, words in enumerate(docs) for key, ks in self.windows(words).items()]
        found: dict[tuple[int, int], list[int]] = defaultdict(list)
        for a in range(0, len(wanted), 4096):
            part = wanted[a : a + 4096]
            keys = walk_keys(self.padded([hashed(docs[d][s : s + n]) for d, (s, n), _ in part]))
            low, high = (np.searchsorted(self.keys, keys, side) for side in ("left", "right"))
            for row, column in zip(*np.nonzero(high > low), strict=True):
                d, (start, _), ks = part[row]
                for k in self.of_key[low[row, column] : high[row, column]].tolist():
                    if k in ks:
                        found[d, k].append(start)
        out = []
        for (d, k), starts in sorted(found.items()):
            best = min(
                (self.verified(docs[d], k, s, e) for s, e in runs(sorted(set(starts)), len(self.words[k]))),
            )
            if best[0] <= self.allowed[k]:
                out.append((d, self.ids[k], best[1], best[2], best[0], len(self.words[k])))
        return out

    def verified(self, words: list[str], k: int, first: int, last: int) -> tuple[int, int, int]:
        begin = max(first - self.allowed[k], 0)
        region = words[begin : last + len(self.words[k]) + self.allowed[k]]
        number: dict[str, int] = {}
        coded = [[number.setdefault(w, len(number)) for w in x] for x in (self.words[k], region)]
        distance, start, stop = best_window(*coded)
        return distance, begin + start, begin + stop


def runs(starts: list[int], near: int) -> list[tuple[int, int]]:
    """First and last of starts that lie close together."""
    out = [[starts[0], starts[0]]]
    for s in starts[1:]:
        if s - out[-1][1] <= near:
            out[-1][1] = s
        else:
            out.append([s, s])
    return [tuple(r) for r in out]


def hashed(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) | 1 for w in words], dtype=np.uint64)


def item_groups(benchmark: DataFrame, item_col: str, text_col: str, group_bytes: int) -> Iterator[list[tuple]]:
    """(id, text) of a bounded share of the items at a time."""
    items = benchmark.select(col(item_col).alias("item"), text_of(text_col).alias("text"))
    n = max(1, math.ceil(total_bytes(benchmark, text_col) / group_bytes))
    for k in range(n):
        share = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        yield sorted(((r["item"], r["text"]) for r in share.collect()), key=str)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", edits: float = EDITS, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(id, item id, start, stop, distance, item_words): the closest window of each document and item
    that match, as places of words."""
    schema = T.StructType(
        [T.StructField(id_col, id_type(docs, id_col)), T.StructField(item_col, id_type(benchmark, item_col)),
         *(T.StructField(n, T.LongType()) for n in ("start", "stop", "distance", "item_words"))]
    )
    rows = docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"))

    def search_for(items: list[tuple]) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Items(sent.value, edits)
            for batch in batches:
                for part in slices(batch, "text", SLICE_BYTES):
                    found = own.search(part.column("text").to_pylist())
                    columns = list(zip(*found, strict=True)) or [()] * 6
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id").take(pa.array(columns[0], pa.int64())),
                         pa.array(columns[1], item_type), *(pa.array(c, pa.int64()) for c in columns[2:])],
                        names=schema.names,
                    )

        return rows.mapInArrow(run, schema)

    item_type = arrow_type(id_type(benchmark, item_col))
    return reduce(DataFrame.unionAll, map(search_for, item_groups(benchmark, item_col, item_text_col, group_bytes)))


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", edits: float = EDITS, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""

    def without(docs: DataFrame, items: list[tuple]) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(items)
        at = docs.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Items(sent.value, edits)
            for batch in batches:
                texts = pa.RecordBatch.from_arrays([batch.column(at)], names=["text"])
                start = 0
                for part in slices(texts, "text", SLICE_BYTES):
                    clean = np.ones(len(part), dtype=bool)
                    for d, *_ in own.search([t or "" for t in part.column("text").to_pylist()]):
                        clean[d] = False
                    yield batch.slice(start, len(part)).filter(pa.array(clean))
                    start += len(part)

        return docs.mapInArrow(run, docs.schema)

    return reduce(without, item_groups(benchmark, item_col, item_text_col, group_bytes), docs)
