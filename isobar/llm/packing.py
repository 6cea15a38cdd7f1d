"""Vector bin packing of token sequences for training.

Every sequence has three limits at once: tokens, segments (pieces of examples in it) and tokens
that bear loss. The dot-product heuristic fills one sequence at a time: of the examples that
fit, the one whose demand points most along what is left of the limits goes in; when none fits
whole, the longest is cut to what is left. What cannot fill a sequence is dealt into sequences
whose lengths are powers of two, which need no padding.

Each task packs the documents it reads, out of a pool of a few hundred, so nothing is shuffled
and memory does not grow with the input. The ids of words met lately and of their parts are
kept: the tokenizer cuts texts at white space and, within plain words, between letters, digits and marks, and
no token spans such a cut, so this is the same as encoding whole texts (``tests/llm`` compares both).

A null text is empty, and an empty text is the end id alone. Repeated rows are packed each.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from isobar.llm.common import col, id_type, slices, text_of

POOL, POOL_IDS = 256, 1 << 20
#: Words of a worker's table, some 60 bytes each, and parts of words in each generation, some 200 bytes each.
RECENT_WORDS, RECENT_PARTS = 400_000, 100_000
#: What a vocabulary of this kind writes at the end of a token that ends a word.
WORD_END = "</w>"
#: Where the tokenizer cuts a word in lower case that is printable ASCII.
PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: A slice's different words are handled once: long slices repeat more of them.
SLICE_BYTES = 4 << 20


class Recent:
    """Values of the keys met lately, in two generations: keys that are met again stay, the rest goes."""

    def __init__(self, size: int, make: Callable[[list[str]], list[bytes]]) -> None:
        self.size, self.make, self.now, self.before = size, make, {}, {}

    def values(self, keys: list[str]) -> list[bytes]:
        """One for each key; keys are all different."""
        if len(self.now) > self.size:
            self.now, self.before = {}, self.now
        out = list(map(self.now.get, keys))
        gaps = [k for k, value in enumerate(out) if value is None]
        unknown = []
        for k in gaps:
            if (value := self.before.get(keys[k])) is None:
                unknown.append(k)
            else:
                out[k] = value
        for k, value in zip(unknown, self.make([keys[k] for k in unknown]) if unknown else [], strict=True):
            out[k] = value
        self.now.update((keys[k], out[k]) for k in gaps)
        return out


class WordTable:
    """Ids of the words met lately, as flat arrays: a slice's words are looked up in one call."""

    def __init__(self, limit: int, make: Callable[[list[str]], list[bytes]]) -> None:
        self.limit, self.make, self.turn = limit, make, 0
        self.words = pa.array([], pa.string())
        self.start, self.size, self.met = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat = np.zeros(0, dtype=np.uint32)

    def forget(self) -> None:
        """Keep the half that was met last."""
        stay = np.sort(np.argsort(self.met, kind="stable")[-(self.limit // 2) :])
        self.words = self.words.take(pa.array(stay))
        self.flat = gathered(self.flat, self.start[stay], self.size[stay])
        self.size, self.met = self.size[stay], self.met[stay]
        self.start = np.cumsum(self.size) - self.size

    def places(self, words: pa.Array) -> np.ndarray:
        """The entries of some words, all different; what is not known is made."""
        if len(self.words) > self.limit:
            self.forget()
        self.turn += 1
        found = pc.index_in(words, value_set=self.words)
        new = words.filter(found.is_null())
        place = found.fill_null(0).to_numpy().copy()
        if len(new):
            ids = self.make(new.to_pylist())
            size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
            place[found.is_null().to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(new))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int32)])
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(ids), dtype="<u4")])
            self.words = pa.concat_arrays([self.words, new])
        self.met[place] = self.turn
        return place


def gathered(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` of those sizes from those starts on, one after the other."""
    stops = np.cumsum(size)
    total = int(stops[-1]) if len(stops) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    place = np.repeat((start - (stops - size)).astype(kind), size)
    place += np.arange(total, dtype=kind)
    return flat[place]


class Encoder:
    """Ids of whole texts by a tokenizer file, word by word; new words part by part."""

    def __init__(self, path: str, words: int = RECENT_WORDS, parts: int = RECENT_PARTS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.parts = WordTable(words, self.by_parts), Recent(parts, self.by_tokenizer)
        # Texts that the tokenizer takes out before anything else start with these.
        special = {t.content[0] for t in self.tokenizer.get_added_tokens_decoder().values()} | {"<"}
        #: By id, whether the token ends a word.
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(WORD_END)]] = True
        self.plain = re.compile("[" + "".join(re.escape(chr(c)) for c in range(33, 127) if chr(c) not in special) + "]+").fullmatch

    def by_tokenizer(self, texts: list[str]) -> list[bytes]:
        """Encode texts without white space as one text and cut the ids where each ends."""
        done = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        ids = np.array(done.ids, dtype="<u4")
        # A part of a plain word ends with its one word end; other texts may hold several.
        stops = np.flatnonzero(self.ends[ids]) + 1
        if not (all(map(self.plain, texts)) and len(stops) == len(texts)):
            starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
            at = np.fromiter(chain.from_iterable(done.offsets), dtype=np.int64, count=2 * len(done))[::2]
            stops = np.searchsorted(at, starts[1:], "left")
        packed, cuts = ids.tobytes(), (4 * np.concatenate([[0], stops])).tolist()
        return [packed[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def by_parts(self, words: list[str]) -> list[bytes]:
        plain = list(map(self.plain, words))
        odd = [w for w, yes in zip(words, plain, strict=True) if not yes]
        cut = [PART.findall(w.lower()) if yes else (w,) for w, yes in zip(words, plain, strict=True)]
        parts = list(set(chain.from_iterable(cut)).difference(odd))
        known = dict(zip(parts, self.parts.values(parts), strict=True)) if parts else {}
        known.update(zip(odd, self.by_tokenizer(odd), strict=True) if odd else ())
        known_ids = known.__getitem__
        return [known_ids(p[0]) if len(p) == 1 else b"".join(map(known_ids, p)) for p in cut]

    def encode(self, texts: pa.Array | list[bytes]) -> list[np.ndarray]:
        column = texts if isinstance(texts, pa.Array) else pa.array([t.decode() for t in texts], pa.string())
        if not len(column):
            return []
        # The tokenizer lower-cases anyway, but takes out special texts before that; they hold a ``<``.
        if not pc.any(pc.match_substring(column, "<")).as_py():
            column = pc.ascii_lower(column)
        # White space at the ends leaves empty words, which have no ids.
        split = pc.ascii_split_whitespace(column)
        words = split.flatten().dictionary_encode()
        place = self.words.places(words.dictionary)[words.indices.to_numpy()]
        size = self.words.size[place]
        out = gathered(self.words.flat, self.words.start[place], size)
        stops = np.concatenate([[0], np.cumsum(size)])
        cuts = stops[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])]
        return [out[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_ENCODERS: dict[tuple[str, int, int], Encoder] = {}


def encoder(path: str, words: int = RECENT_WORDS, parts: int = RECENT_PARTS) -> Encoder:
    """One for each worker process, file and size."""
    key = (path, words, parts)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


class Pool:
    """Examples that wait, with what each still demands: tokens, segments, loss-bearing tokens."""

    def __init__(self, limits: tuple[int, int, int]) -> None:
        self.limits = np.array(limits, dtype=np.float64)
        self.items: list[tuple] = []  # id, ids, start of what is left, start of the loss
        self.demand = np.zeros((0, 3))

    def add(self, examples: list[tuple]) -> None:
        """(id, ids, start of the loss) each."""
        self.items += [(key, ids, 0, loss_from) for key, ids, loss_from in examples]
        demand = [(len(ids), 1, len(ids) - loss_from) for _, ids, loss_from in examples]
        self.demand = np.concatenate([self.demand, np.array(demand, dtype=np.float64).reshape(-1, 3)])

    def full(self) -> bool:
        return len(self.items) >= POOL or self.demand[:, 0].sum() >= POOL_IDS

    def fill(self) -> list[tuple]:
        """(id, ids, start, stop) of one sequence."""
        left, pieces = self.limits.copy(), []
        while self.items and left[0] > 0 and left[1] > 0:
            fits = (self.demand <= left).all(axis=1)
            if fits.any():
                along = (self.demand / self.limits) @ (left / self.limits)
                k = int(np.where(fits, along, -1.0).argmax())
                key, ids, start, _ = self.items.pop(k)
                pieces.append((key, ids, start, len(ids)))
                left -= self.demand[k]
                self.demand = np.delete(self.demand, k, axis=0)
                continue
            k = int(self.demand[:, 0].argmax())
            key, ids, start, loss_from = self.items[k]
            stop = min(start + int(left[0]), len(ids), max(start, loss_from) + int(left[2]))
            if stop > start:
                self.items[k] = (key, ids, stop, loss_from)
                self.demand[k] = (len(ids) - stop, 1, len(ids) - max(stop, loss_from))
                pieces.append((key, ids, start, stop))
            break
        return pieces


def without_padding(pieces: list[tuple], full: int) -> list[list[tuple]]:
    """A full sequence as it is; another cut anew into sequences as long as powers of two."""
    total = sum(stop - start for *_, start, stop in pieces)
    if total == full:
        return [pieces]
    out, waiting = [], pieces[::-1]
    for bit in reversed(range(total.bit_length())):
        room, sequence = total & (1 << bit), []
        while room:
            key, ids, start, stop = waiting.pop()
            cut = min(stop, start + room)
            sequence.append((key, ids, start, cut))
            room -= cut - start
            if cut < stop:
                waiting.append((key, ids, cut, stop))
        if sequence:
            out.append(sequence)
    return out


def pack(
    docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None,
    end_id: int = 2, max_tokens: int = 4096, max_segments: int = 256, max_loss: int = 4096,
    recent: tuple[int, int] = (RECENT_WORDS, RECENT_PARTS), slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """A row per piece: id, start, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``prompt_col`` holds text that comes before a document's and bears no loss (instruction
    data); without it all ids bear loss. A sequence keeps all three limits; ``max_loss`` and
    ``max_segments`` are 1 at least. ``recent`` (words, parts) and ``slice_bytes`` trade a worker's memory for time and
    change no result but which documents share a sequence.
    """
    if min(max_tokens, max_segments, max_loss) < 1:
        raise ValueError("limits are 1 at least")
    kind = id_type(docs, id_col)
    schema = T.StructType(
        [T.StructField(id_col, kind), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType()),
         *(T.StructField(n, T.LongType()) for n in ("doc_tokens", "sequence_id", "offset"))]
    )
    rows = docs.select(
        col(id_col).alias("id"), text_of(text_col).alias("text"),
        *([text_of(prompt_col).alias("prompt")] if prompt_col else []),
    )

    def examples(batch: pa.RecordBatch) -> Iterator[list[tuple]]:
        own = encoder(tokenizer, *recent)
        for part in slices(batch, "text", slice_bytes):
            ids = own.encode(part.column("text"))
            prompts = (
                own.encode(part.column("prompt"))
                if prompt_col else [np.zeros(0, np.uint32)] * len(ids)
            )
            yield [
                (key, np.concatenate([before, own_ids, [end_id]]).astype(np.uint32), len(before))
                for key, before, own_ids in zip(part.column("id").to_pylist(), prompts, ids, strict=True)
            ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, sequence = Pool((max_tokens, max_segments, max_loss)), TaskContext.get().partitionId() << 33

        def packed(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            out: list[tuple] = []
            while pool.items and (last or pool.full()):
                for pieces in without_padding(pool.fill(), max_tokens):
                    offset = 0
                    for key, ids, start, stop in pieces:
                        out.append((key, start, ids[start:stop].astype("<u4").tobytes(), len(ids), sequence, offset))
                        offset += stop - start
                    sequence += 1
            if out:
                columns = zip(*out, strict=True)
                types = (source_type, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names
                )

        source_type = pa.null()
        for batch in batches:
            source_type = batch.schema.field("id").type
            for some in examples(batch):
                for k in range(0, len(some), POOL):
                    pool.add(some[k : k + POOL])
                    yield from packed(last=False)
        yield from packed(last=True)

    return rows.mapInArrow(run, schema)
