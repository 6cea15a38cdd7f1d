"""Spelling variants of words: pairs that one edit parts, found by blocked Gram matrices.

Words are letter counts: a matrix product of two blocks of them gives all inner products at once, and with the squared
lengths all squared distances. One inserted or deleted letter changes one count by one, a replaced one
two counts, so words that one edit parts are at most 2 apart. Those pairs are then verified letter by letter.

Blocks. Only words of one length or of adjacent lengths can be near. Of the two words of a pair, the shorter (length L)
is cut into thirds; one edit leaves two of them as they are, so both words share their first two thirds, their
last two thirds, or the first and the last one. A block holds all words that share such thirds for one
L: those of length L and those of length L + 1. Each word lies in three blocks for its own length and in three as the longer
word. A pair counts in the first of its blocks only. A block of more than ``SPLIT`` words is dealt in parts to
pairs of parts, each a matrix product of bounded size, so no task grows with a block, and nothing is dropped.

Words in upper case beyond A-Z stay as they are. Null texts have no words; copies of a document count each; an
empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from isobar.llm.common import col, slices, text_of
from isobar.llm.components import written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SLICE_BYTES = 2 << 20
#: One run in so many loses a letter.
SLIP = 31
#: Words of a part of a block.
SPLIT = 2048
#: Letters of the pairs that are verified at once.
VERIFIED = 1 << 22
#: Rows of a matrix product. Smaller blocks are multiplied together.
ROWS = 512


# --- words -------------------------------------------------------------------------


def words_of(doc_id: str, text: str, least: int) -> Counter[str]:
    """Lower-cased words of ``least`` letters or more and how often each occurs; where ``SLIP`` divides the hash of document and
    word, the word is without one letter."""
    out: Counter[str] = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    # Bytes are lower-cased only from A to Z.
    runs = RUN.findall(text.encode().lower().decode())
    for word, n in Counter([w for w in runs if len(w) >= least]).items():
        h = zlib.crc32(word.encode(), start)
        if h % SLIP == 0:
            k = h % len(word)
            word = word[:k] + word[k + 1 :]
            if len(word) < least:
                continue
        out[word] += n
    return out


def word_counts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 7, least_n: int = 2
) -> DataFrame:
    """(word, n): all words of at least so many letters that occur at least so often."""
    rows = docs.select(F.coalesce(col(id_col).cast("string"), F.lit("")).alias("id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                seen: Counter[str] = Counter()
                for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    seen.update(words_of(doc_id, text, least_length))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"]
                )

    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_n)


# --- near words ----------------------------------------------------------------------


def in_blocks(words: DataFrame) -> DataFrame:
    """(block, kind, length, word, n): a word's six blocks; ``length`` is that of the shorter word of a pair."""
    word, size = F.col("word"), F.length("word")

    def shared(length):
        a, b = F.floor(length / 3).cast("int"), F.floor(length * 2 / 3).cast("int")
        # The longer word has one letter more, so its end starts one later.
        ends = lambda k: F.substring(word, size - length + k + F.lit(1), length)
        texts = [F.substring(word, F.lit(1), b), ends(a), F.concat(F.substring(word, F.lit(1), a), ends(b))]
        return [
            F.struct(F.xxhash64(F.lit(k), length, t).alias("block"), F.lit(k).alias("kind"), length.alias("length"))
            for k, t in enumerate(texts)
        ]

    found = words.select("word", "n", F.explode(F.array(*shared(size), *shared(size - 1))).alias("at"))
    return found.select("at.*", "word", "n")


def dealt(cells: DataFrame) -> DataFrame:
    """``cells`` with share and part: blocks of more than ``SPLIT`` words are dealt in parts to pairs of parts."""
    large = written(cells.groupBy("block").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > SPLIT), "large-blocks")
    if large.isEmpty():
        return cells.withColumns({"share": F.col("block"), "part": F.lit(0), "same": F.lit(True)})
    parts = F.ceil(F.col("size") / SPLIT).cast("int")
    own = F.pmod(F.xxhash64("word"), parts).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda k: F.struct(
            F.xxhash64("block", F.least(k, own), F.greatest(k, own)).alias("share"), own.alias("part"), (k == own).alias("same")
        ),
    )
    whole = F.array(F.struct(F.col("block").alias("share"), F.lit(0).alias("part"), F.lit(True).alias("same")))
    joined = cells.join(large, "block", "left").withColumn("to", F.explode(F.when(F.col("size").isNull(), whole).otherwise(pairs)))
    return joined.select("kind", "length", "word", "n", "to.*")


def letters(words: list[str]) -> np.ndarray:
    """Code points by word and place, zero behind the end."""
    longest = max(map(len, words))
    return np.array(words, dtype=f"U{longest}").view(np.uint32).reshape(len(words), longest)


def counted(code: np.ndarray) -> np.ndarray:
    """Letter counts by word. Single precision is exact for the inner products of short words."""
    values, column = np.unique(code, return_inverse=True)
    cell = np.arange(len(code))[:, None] * len(values) + column.reshape(code.shape)
    out = np.bincount(cell.ravel(), minlength=len(code) * len(values)).reshape(len(code), len(values))
    out = out.astype(np.float32 if code.shape[1] <= 2048 else np.float64)
    return out[:, 1:] if values[0] == 0 else out


def candidates(counts: np.ndarray, share: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one share, the first before the second, whose squared distance is at most 2. Rows of a share
    are consecutive."""
    norm = (counts * counts).sum(axis=1)
    for k in range(0, len(counts), ROWS):
        part, stop = counts[k : k + ROWS], int(np.searchsorted(share, share[min(k + ROWS, len(share)) - 1], "right"))
        apart = norm[k : k + ROWS, None] + norm[None, k:stop] - 2 * (part @ counts[k:stop].T)
        near = (apart <= 2) & (share[k : k + ROWS, None] == share[None, k:stop])
        a, b = np.nonzero(near)
        later = b > a
        yield a[later] + k, b[later] + k


def one_edit(code: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of rows are one inserted, deleted or replaced letter apart."""
    short, long = np.where(size[a] <= size[b], a, b), np.where(size[a] <= size[b], b, a)
    near = np.zeros(len(a), dtype=bool)
    step = max(VERIFIED // code.shape[1], 1)
    for k in range(0, len(a), step):
        s, t = short[k : k + step], long[k : k + step]
        length, grown = size[s][:, None], size[t] > size[s]
        differs = code[s] != code[t]
        near[k : k + step] = ~grown & (differs.sum(axis=1) == 1)
        # Where the first letters that agree and the last that agree cover the shorter word, one was put between.
        inside = np.arange(code.shape[1] - 1)[None, :] < length
        front = (~differs[:, :-1] & inside).cumprod(axis=1).sum(axis=1)
        behind = (code[s][:, :-1] == code[t][:, 1:]) | ~inside
        back = behind[:, ::-1].cumprod(axis=1).sum(axis=1) - (~inside).sum(axis=1)
        near[k : k + step] |= grown & (front + back >= length[:, 0])
    return near


def earlier_kind(word: str, other: str, kind: int, length: int) -> bool:
    """Whether two words share a block of a smaller kind as well."""
    first, second = length // 3, length * 2 // 3
    return kind > 0 and word[:second] == other[:second] or kind == 2 and word[first - length :] == other[first - length :]


@dataclass(frozen=True)
class Cells:
    """Rows of whole shares, share after share (numbered in order). ``same`` tells rows that came to be compared
    with their own part of a block."""

    words: list[str]
    share: np.ndarray
    kind: np.ndarray
    length: np.ndarray
    part: np.ndarray
    same: np.ndarray

    def near(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows that are near, each where it counts."""
        size = np.array([len(w) for w in self.words])
        code = letters(self.words)
        for a, b in candidates(counted(code), self.share):
            # Two of the longer words are near in the blocks of their own length.
            keep = (size[a] == self.length[a]) | (size[b] == self.length[a])
            keep &= self.same[a] | (self.part[a] != self.part[b])
            a, b = a[keep], b[keep]
            keep = one_edit(code, size, a, b)
            a, b = a[keep], b[keep]
            rows = zip(a.tolist(), b.tolist(), self.kind[a].tolist(), self.length[a].tolist(), strict=True)
            first = [not earlier_kind(self.words[i], self.words[j], kind, length) for i, j, kind, length in rows]
            keep = np.array(first, dtype=bool)
            yield a[keep], b[keep]


def bundles(share: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Whole shares together, from and to which row: about ``ROWS`` rows, unless one share has more, and no more padded
    letters than are verified at once, unless one share has."""
    if not len(share):
        return
    starts = np.flatnonzero(np.concatenate([[True], share[1:] != share[:-1]]))
    longest = np.maximum.reduceat(size, starts)
    begin, most = 0, 0
    for start, stop, own in zip(starts.tolist(), [*starts[1:].tolist(), len(share)], longest.tolist(), strict=True):
        if start > begin and (stop - begin > ROWS or (stop - begin) * max(most, own) > VERIFIED):
            yield begin, start
            begin, most = start, 0
        most = max(most, own)
    yield begin, len(share)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every word with each word that one edit parts from it, both ways."""

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        share = rows.column("share").to_numpy()
        # Most shares are one word.
        alone = np.concatenate([[True], share[1:] != share[:-1]]) & np.concatenate([share[1:] != share[:-1], [True]])
        rows = rows.filter(pa.array(~alone)).combine_chunks()
        size = pc.utf8_length(rows.column("word")).to_numpy()
        for start, stop in bundles(rows.column("share").to_numpy(), size):
            own = rows.slice(start, stop - start)
            word, n = own.column("word").combine_chunks(), own.column("n").to_numpy()
            columns = [own.column(c).to_numpy() for c in ("share", "kind", "length", "part", "same")]
            number = np.cumsum(np.concatenate([[False], columns[0][1:] != columns[0][:-1]]))
            for a, b in Cells(word.to_pylist(), number, *columns[1:]).near():
                x, y = np.concatenate([a, b]), np.concatenate([b, a])
                yield pa.RecordBatch.from_arrays(
                    [word.take(pa.array(x)), pa.array(n[x]), word.take(pa.array(y)), pa.array(n[y])],
                    names=["word", "n", "other", "other_n"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []  # the open share, which may go on in the next batch
        for batch in batches:
            if not len(batch):
                continue
            table = pa.concat_tables([*held, pa.table(batch)])
            share = table.column("share").to_numpy()
            last = int(np.searchsorted(share, share[-1], "left"))
            if last:
                yield from pairs(table.slice(0, last))
            held = [table.slice(last)]
        if held:
            yield from pairs(held[0])

    cells = dealt(in_blocks(words)).select("share", "kind", "length", "part", "same", "word", "n")
    sorted_ = cells.repartition("share").sortWithinPartitions("share")
    return sorted_.mapInArrow(run, "word string, n long, other string, other_n long")


# --- forms ---------------------------------------------------------------------------


def roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """(word, root) of all words of ``forms`` (word, form): forms followed to the last.

    Each form is ``ratio`` times as frequent as its word, so ``most`` bounds a chain, and each round doubles
    how far a word sees.
    """
    hops = max(int(math.log(max(most, 1), max(ratio, 2))) + 1, 1)
    reach = written(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(math.ceil(math.log2(hops + 1))):
        further = reach.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reach = written(reach.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "forms")
    return reach


def spelling_variants(words: DataFrame, *, ratio: int = 10) -> DataFrame:
    """Per word of ``words`` (word, n): its form, root, n, n_near and form_n.

    Words are near if they differ by exactly one inserted, deleted or replaced code point. The form is the
    near word of largest n, the smallest by code points among several, if that n is ``ratio`` times the word's own or more.
    """
    words = written(words.select("word", "n"), "words")
    found = near_pairs(words).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best")
    )
    large = -F.col("best.minus") >= ratio * F.col("n")
    near = written(
        found.select(
            "word", "n_near", F.when(large, F.col("best.other")).alias("form"), F.when(large, -F.col("best.minus")).alias("form_n")
        ),
        "near",
    )
    most = words.agg(F.max("n")).first()[0] or 0
    chains = roots(near.where("form is not null"), most, ratio)
    return words.join(near, "word", "left").join(chains, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n",
    )
