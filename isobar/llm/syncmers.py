"""Document fingerprints of closed syncmers.

A k-mer of code points is a closed syncmer if the smallest of its s-mers (by hash) is the first
or the last one. Whether it is chosen depends on the k-mer alone, so equal passages have the
same anchors wherever they stand and whatever surrounds them, and a choice falls at least once
in every k - s + 1 places of plain text. ``anchors`` lists them with their positions;
the fingerprint keeps the 64 smallest different anchor hashes, and the likeness of two
fingerprints estimates the Jaccard similarity of the anchor sets: of the 64 smallest of both
together, the share that both hold.

A text without a closed syncmer (all shorter than k, some of fewer than 2k - s - 1 code points) has one anchor,
itself; only an empty or null text has none. Two empty fingerprints are alike (1). Whole texts are read in parts of about a million code points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from isobar.llm.common import GOLDEN, M1, M2, col, id_type, mixed, pieces_for, slices, text_of, total_bytes

K, S, KEPT = 16, 5, 64
SLICE_BYTES = 2 << 20
BUCKET_BYTES = 32 << 20


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """By doubling: windows of 2, 4, ... and two that overlap."""
    done, out = 1, values
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def find_anchors(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, position, 32-bit hash) of the closed syncmers, or of a text without any, in order."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    stops = np.cumsum(lengths)
    points = codes("".join(texts)).astype(np.uint64)
    which, place, value = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    if len(points) >= K:
        n = len(points) - S + 1
        h = points[:n].copy()
        for k in range(1, S):
            h = h * GOLDEN + points[k : n + k]
        h = mixed(h)
        smallest = sliding_minimum(h, K - S + 1)
        m = len(smallest)
        chosen = np.flatnonzero((h[:m] == smallest) | (h[K - S : K - S + m] == smallest))
        text = np.searchsorted(stops, chosen, "right")
        inside = chosen + K <= stops[text]
        chosen, text = chosen[inside], text[inside]
        # The s-mers at these places cover the k-mer.
        whole = h[chosen] * M1 + h[chosen + S] * M2
        for at in (2 * S, K - S):
            whole = mixed(whole) + h[chosen + at] * GOLDEN
        which, place = text, chosen - (stops - lengths)[text]
        value = (mixed(whole) >> np.uint64(32)).astype(np.uint32)
    bare = np.flatnonzero((np.bincount(which, minlength=len(texts)) == 0) & (lengths > 0))
    if len(bare):
        own = np.array([xxhash.xxh32_intdigest(texts[k].encode()) for k in bare], dtype=np.uint32)
        which, place, value = (
            np.concatenate(x) for x in ((bare, which), (np.zeros(len(bare), np.int64), place), (own, value))
        )
        order = np.argsort(which, kind="stable")
        which, place, value = which[order], place[order], value[order]
    return which, place, value


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The smallest different anchor hashes of each text, ascending."""
    which, _, value = find_anchors(texts)
    pairs = np.unique((which.astype(np.uint64) << np.uint64(32)) | value.astype(np.uint64))
    cuts = np.searchsorted(pairs >> np.uint64(32), np.arange(len(texts) + 1, dtype=np.uint64))
    values = (pairs & np.uint64(0xFFFFFFFF)).astype(">u4")
    return [values[a : min(b, a + KEPT)] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def fingerprint(sketch: np.ndarray) -> str:
    """Eight hexadecimal digits for each hash."""
    return sketch.tobytes().hex()


def likeness(a: list[int], b: list[int]) -> float:
    if not a and not b:
        return 1.0
    one, other = set(a), set(b)
    both = one & other
    together = sorted(one | other)[:KEPT]
    return sum(x in both for x in together) / len(together)


def anchors(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, position, anchor): every closed syncmer of every text."""
    schema = T.StructType(
        [T.StructField(id_col, id_type(docs, id_col)), T.StructField("position", T.LongType()),
         T.StructField("anchor", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                which, place, value = find_anchors(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(which)), pa.array(place), pa.array(value.astype(np.int64))],
                    names=schema.names,
                )

    return docs.select(col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, schema)


def with_next(docs: DataFrame, id_col: str, text_col: str, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Documents in buckets of neighbouring ids, each bucket closed by the document after it.

    Columns bucket, place (0 own, 1 the closing one), id, text; partitioned by bucket and sorted.
    The document after the last is the first. Rows that share an id follow each other by text.
    The driver holds a few numbers for each bucket of ``bucket_bytes``.
    """
    spark = docs.sparkSession
    rows = docs.select(col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    n = pieces_for(spark, total_bytes(docs, text_col), bucket_bytes)
    cuts = sorted(set(rows.approxQuantile("id", [k / n for k in range(1, n)], 0.1 / n))) if n > 1 else []
    bounds = F.array(*[F.lit(int(c)) for c in cuts]) if cuts else F.expr("CAST(array() AS ARRAY<BIGINT>)")
    bucket = F.coalesce(F.size(F.filter(bounds, lambda x: x <= F.col("id"))), F.lit(0))
    own = rows.select(bucket.alias("bucket"), F.lit(0).alias("place"), "id", "text")
    # A null id comes first of all.
    least = own.groupBy("bucket").agg(
        F.min("id").alias("id"), F.max(F.col("id").isNull()).alias("null_first")
    ).collect()
    first = {r["bucket"]: None if r["null_first"] else r["id"] for r in least}
    order = sorted(first)
    closing = list(zip(order, order[1:] + order[:1], strict=True))
    closers = spark.createDataFrame([(b, first[after]) for b, after in closing], "bucket int, id long")
    ends = rows.join(F.broadcast(closers), rows["id"].eqNullSafe(closers["id"])).select(
        "bucket", F.lit(1).alias("place"), rows["id"], "text"
    )
    return own.unionByName(ends).repartition(n, "bucket").sortWithinPartitions("bucket", "place", "id", "text")


def compare_with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of the text edited: its last quarter replaced by as much
    from the start of the next document. Ids are numbers.

    Columns id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    schema = T.StructType(
        [T.StructField(id_col, T.LongType()), T.StructField("n_chars", T.LongType()),
         *(T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")),
         *(T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next"))]
    )

    def compare(rows: pa.Table) -> pa.RecordBatch | None:
        """Each row with the one that follows it."""
        texts, ids = rows.column("text").to_pylist(), rows.column("id").to_pylist()
        bucket, place = (rows.column(c).to_numpy() for c in ("bucket", "place"))
        which = np.flatnonzero((place[:-1] == 0) & (bucket[:-1] == bucket[1:])).tolist()
        if not which:
            return None
        edited = []
        for k in which:
            quarter = len(texts[k]) // 4
            edited.append(texts[k][: len(texts[k]) - quarter] + texts[k + 1][:quarter])
        plain = sketches(texts)
        changed = sketches(edited)
        listed = [s.tolist() for s in plain]
        out = [
            [ids[k] for k in which],
            [len(texts[k]) for k in which],
            [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            [fingerprint(plain[k]) for k in which],
            [fingerprint(s) for s in changed],
            [likeness(listed[k], s.tolist()) for k, s in zip(which, changed, strict=True)],
            [likeness(listed[k], listed[k + 1]) for k in which],
        ]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.Table | None = None
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                rows = pa.Table.from_batches([part])
                rows = rows if last is None else pa.concat_tables([last, rows])
                last = rows.slice(len(rows) - 1)
                if (done := compare(rows)) is not None:
                    yield done

    return with_next(docs, id_col, text_col).mapInArrow(run, schema)
