"""Language identification by compression.

For every language a piece of its texts becomes a raw-content dictionary of a zstandard
compressor: what a text shares with it costs little. A text is cut into parts of a few hundred bytes
(at white space where there is some), every part is compressed with every dictionary, and the
language with the smallest sum wins. Texts and dictionaries are lower case and all but letters is
one space. Parts are short so that a long text cannot live on its own repetitions instead of
the dictionary's. If the runner-up needs less than ``margin`` more, the
answer is marked as rejected; it is still the best one.

Dictionaries are learned from a sample: at most ``dictionary_bytes`` for each language, and less for each where
languages are so many that all dictionaries together would pass ``ALL_BYTES``, since every task holds them. It is made of
pieces of at most 4,096 characters from many texts, each from a place in its text that a hash of the text
chooses, so that no shared beginning is all that is learned. A hash chooses the texts too, and
copies of a text count once. All texts are scored, whole. Texts that are null or hold no letter, and all
texts if nothing was learned, are ``und``. Of languages with equal sums the first by name wins; such
answers are rejected.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from isobar.llm.common import col, id_type, slices, text_of

UNDETERMINED = "und"
DICTIONARY_BYTES = 128 << 10
PART_BYTES = 1024
#: Lengths of the pieces: the longest of which a dictionary holds 32.
PIECES = (4096, 1024, 256, 64)
LEVEL = 3
MARGIN = 0.01
#: Of all dictionaries, and the least of one.
ALL_BYTES, LEAST_BYTES = 64 << 20, 1 << 10
SLICE_BYTES = 4 << 20
LETTER = re.compile(r"[^\W\d_]")
OTHER = re.compile(r"[\W\d_]+")


def plain(text: str) -> bytes:
    return OTHER.sub(" ", text.lower()).strip().encode()


def dictionaries(
    docs: DataFrame, learn: Column, lang_col: str, text_col: str, size: int = DICTIONARY_BYTES
) -> dict[str, bytes]:
    """A dictionary of at most ``size`` bytes for each language of the rows to learn from."""
    rows = docs.where(learn & col(lang_col).isNotNull() & col(text_col).isNotNull()).select(
        col(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text")
    )
    texts = rows.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.max(F.length("text")).alias("length"))
    sums = [F.sum(F.least("length", F.lit(p))).alias(f"gain{p}") for p in PIECES]
    totals = texts.groupBy("lang").agg(*sums).where(f"gain{PIECES[0]} > 0").collect()
    size = min(size, max(ALL_BYTES // max(len(totals), 1), LEAST_BYTES))
    piece = next((p for p in PIECES if 32 * p <= size), PIECES[-1])
    gains = [(r["lang"], r[f"gain{piece}"]) for r in totals]
    found = docs.sparkSession.createDataFrame(gains, "lang string, gain long")
    # Three times as much as needed, in expectation: white space and signs fall away.
    chance = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    taken = rows.join(F.broadcast(found), "lang").where(chance * F.col("gain") <= 3.0 * size)
    start = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - piece, F.lit(0)) + 1) + 1
    pieces = taken.select("lang", F.substring("text", start, F.lit(piece)).alias("text")).distinct()

    def join(texts: pd.DataFrame) -> pd.DataFrame:
        parts = sorted({plain(t) for t in texts["text"]}, key=lambda p: (zlib.crc32(p), p))
        return pd.DataFrame({"lang": [texts["lang"].iloc[0]], "content": [b" ".join(parts)[:size]]})

    content = pieces.groupBy("lang").applyInPandas(join, "lang string, content binary")
    return {r["lang"]: bytes(r["content"]) for r in content.collect()}


def parts_of(text: bytes) -> Iterator[bytes]:
    start = 0
    while len(text) - start > PART_BYTES:
        cut = text.rfind(b" ", start + PART_BYTES // 2, start + PART_BYTES)
        stop = cut if cut > 0 else start + PART_BYTES
        yield text[start:stop]
        start = stop
    yield text[start:]


def compressors(learned: dict[str, bytes]) -> list[zstandard.ZstdCompressor]:
    out = []
    for lang in sorted(learned):
        content = zstandard.ZstdCompressionDict(learned[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(dict_data=content, write_content_size=False, write_checksum=False))
    return out


def decide(sizes: list[int], margin: float) -> tuple[int, float, bool]:
    """The smallest, a score and whether the runner-up is too close. The score is the share of
    the winner if a byte less makes a language twice as likely."""
    best = min(range(len(sizes)), key=sizes.__getitem__)
    least = sizes[best]
    score = 1 / sum(2.0 ** max(least - s, -1000) for s in sizes)
    second = min((s for k, s in enumerate(sizes) if k != best), default=math.inf)
    return best, score, second - least < margin * least


def identify(
    docs: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    margin: float = MARGIN, dictionary_bytes: int = DICTIONARY_BYTES,
) -> DataFrame:
    """Per document (id, lang_pred, score, rejected). ``learn`` says which rows teach."""
    learned = dictionaries(docs, learn, lang_col, text_col, dictionary_bytes)
    names = sorted(learned)
    schema = T.StructType(
        [T.StructField(id_col, id_type(docs, id_col)), T.StructField("lang_pred", T.StringType()),
         T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = compressors(learned)
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                preds, scores, rejected = [], [], []
                for text in rows.column("text").to_pylist():
                    if not own or not LETTER.search(text):
                        preds.append(UNDETERMINED)
                        scores.append(0.0)
                        rejected.append(True)
                        continue
                    parts = list(parts_of(plain(text)))
                    best, score, close = decide([sum(len(c.compress(p)) for p in parts) for c in own], margin)
                    preds.append(names[best])
                    scores.append(score)
                    rejected.append(close)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), pa.array(preds, pa.string()), pa.array(scores, pa.float64()),
                     pa.array(rejected, pa.bool_())],
                    names=schema.names,
                )

    return docs.select(col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, schema)
