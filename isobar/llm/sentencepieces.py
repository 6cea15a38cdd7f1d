"""SentencePiece ids of whole texts and texts of ids, by a table of distinct marked words.

A sentencepiece model marks white space: a text gets a marker in front and one for every space. In
the models meant here a marker occurs in no piece after any other character. So no merge ever
crosses from a word into the next marker, and a text's ids are the ids of its marked words (a run
of markers with what follows up to the next one), one after the other. ``ChunkTable`` refuses a model that
has other pieces or that normalises texts.

A task reads its texts in slices of a few MB. A slice's distinct marked words are looked up in the table that the worker
keeps, those not in it are segmented by the library in one call, and ids are joined back by position. The
table has two generations of bounded size: words that occur again move to the younger one,
the rest goes. Nothing is shuffled, so neither a frequent word nor a copied text is a hot key, and
memory doesn't grow with the input. A table for the whole corpus would have to send every slice's words and
answers over the network, while most words that are rare here occur once anyway.

Decoding looks up the bytes of every id. What needs the library's own rules (unknown and control ids,
bytes that are no UTF-8) is decoded by the library.

A null text is empty, and an empty text has no ids; null ids decode to the empty text. Repeated rows
are encoded each. Texts in a slice that is longer than its bound are whole: a text is never cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from isobar.llm.common import col, id_type, slices, text_of

MARK = "▁"
#: A run of markers (as spaces) and the word behind it.
CHUNK = re.compile(" +[^ ]*")
SLICE_BYTES = 2 << 20
#: Rows that are decoded at a time.
ROWS = 256
#: Marked words in each of the two generations of a worker's table, some 200 bytes each.
GENERATION = 100_000
#: What normalising would change: runs of spaces, compatibility forms, composed letters, controls.
PROBE = " a  ﬁ Ａé　​\t\r\nb "


def chunks(text: str) -> list[str]:
    """Marked words in order; markers are spaces."""
    return CHUNK.findall(" " + text.replace(MARK, " ")) if text else []


class ChunkTable:
    """Ids (little-endian, 32 bits) of marked words, and bytes of ids."""

    def __init__(self, path: str, generation: int = GENERATION) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces) or self.model.normalize(PROBE) != MARK + PROBE.replace(" ", MARK):
            raise ValueError(f"{path}: pieces cross white space, or texts are normalised")
        self.generation, self.known, self.older = generation, {}, {}
        #: None for ids that need the library's rules.
        self.bytes_of: list[bytes | None] = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(k)
            else None if self.model.is_control(k) or self.model.is_unknown(k) or self.model.is_unused(k)
            else p.replace(MARK, " ").encode()
            for k, p in enumerate(pieces)
        ]
        self.marked = [p.startswith(MARK) for p in pieces]

    def learn(self, words: Iterable[str]) -> None:
        """Take distinct marked words into the younger generation."""
        new = []
        for w in words:
            if (ids := self.older.get(w)) is None:
                new.append(w)
            else:
                self.known[w] = ids
        # The library puts the first marker in front itself, but leaves an empty text empty.
        for w, ids in zip(new, self.model.encode([w[1:] for w in new], num_threads=1), strict=True):
            self.known[w] = np.array(ids if len(w) > 1 else [self.model.piece_to_id(MARK)], dtype="<i4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.generation:
            self.older, self.known = self.known, {}
        split = [chunks(t) for t in texts]
        known = self.known
        self.learn({w for words in split for w in words if w not in known})
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, ids: list[int]) -> str:
        if not ids:
            return ""
        if min(ids) < 0 or max(ids) >= len(self.marked):
            raise ValueError(f"no id of this model: {min(ids)} or {max(ids)}")
        try:
            text = b"".join(map(self.bytes_of.__getitem__, ids)).decode()
        except (TypeError, UnicodeDecodeError):
            return self.model.decode(ids)
        return text[1:] if self.marked[ids[0]] else text


_TABLES: dict[str, ChunkTable] = {}


def chunk_table(path: str) -> ChunkTable:
    """One for each worker process and model file."""
    if path not in _TABLES:
        _TABLES[path] = ChunkTable(path)
    return _TABLES[path]


def encode(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document (id, ids): what the library gives for the whole text, without begin or end ids."""
    rows = docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    schema = T.StructType([T.StructField(id_col, id_type(docs, id_col)), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = table.encode(part.column("text").to_pylist())
                ends = np.concatenate([[0], np.cumsum([len(b) // 4 for b in found])])
                ids = pa.array(np.frombuffer(b"".join(found), dtype="<i4"))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([part.column("id"), lists], names=schema.names)

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, *, ids_col: str = "ids", result: str = "decoded") -> DataFrame:
    """All columns, and the library's text of the ids (a list of ints) as one more. A column named ``result`` is replaced."""
    rows = encoded.select(F.struct(*[col(n) for n in encoded.columns if n != result]).alias("kept"))
    schema = T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = chunk_table(model)
        for batch in batches:
            for k in range(0, len(batch), ROWS):
                kept = batch.column("kept").slice(k, ROWS)
                lists = kept.field(kept.type.get_field_index(ids_col))
                texts = [table.decode(ids.values.to_numpy().tolist()) if ids.is_valid else "" for ids in lists]
                yield pa.RecordBatch.from_arrays([kept, pa.array(texts, pa.string())], names=["kept", "text"])

    return rows.mapInArrow(run, schema).select("kept.*", col("text").alias(result))
