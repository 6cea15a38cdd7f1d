"""Near-duplicates by SimHash, joined on segment popcounts.

A text's fingerprint has 64 bits: each is set if it is set in over half of the hashes of the
text's word shingles. Two fingerprints link if they differ in few bits.

The join. A fingerprint is embedded as 32 counts, the set bits of its 2-bit segments. Changing
one bit changes one count by one, so the Manhattan distance of two embeddings never exceeds the
number of differing bits. Counts are kept in unary (00, 01, 11), which makes an embedding 64 bits
again and its Manhattan distance one exclusive-or and a bit count. Grids of cell width one over
some of the segments find candidates; the lower bound and then the exact distance decide. The
segments fall into ``max_bits + 3`` runs. Within the radius at most ``max_bits`` runs differ, so
three agree: one grid for each three runs (``exact_grids``) finds every pair.

Rows are distinct fingerprints, so copies are one row. A cell gives a spanning forest of its
links once they are many, never all pairs; one with more than ``SPLIT`` rows is dealt in
blocks to pairs of blocks, each a task's share of bounded size.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from isobar.llm.common import col, id_type, slices, text_of
from isobar.llm.components import components, written

SEGMENTS = 32
EVEN = 0x5555555555555555
SPLIT = 8192
#: Cells up to this size compare row by row, shifted; larger ones by a walk over neighbours.
SMALL = 256
#: Links of a cell for each row before a forest and the nearest neighbour stand for them.
PER_ROW = 4
#: More broadcast rows than this (24 bytes each) are joined by a shuffle instead.
BROADCAST_ROWS = 100_000
SLICE_BYTES = 2 << 20
SEED = 42


# --- fingerprints ----------------------------------------------------------------


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of the word shingles in order; of the whole sequence if it is shorter."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    hashed, join = xxhash.xxh64_intdigest, b" ".join
    runs = zip(*(words[k:] for k in range(size)))
    return np.fromiter((hashed(join(r), SEED) for r in runs), dtype=np.uint64, count=len(words) - size + 1)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed number."""
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, *, text_col: str, size: int, keep: dict[str, Column]) -> DataFrame:
    """The columns of ``keep`` and the fingerprint ``fp``. A null text is empty; its fingerprint is zero."""
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], text_of(text_col).alias("text"))
    names = list(keep)
    schema = T.StructType([*(T.StructField(n, id_type(rows, n)) for n in keep), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found = [majority(shingle_hashes(t, size)) for t in part.column("text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(found, pa.int64())], names=[*names, "fp"]
                )

    return rows.mapInArrow(run, schema)


# --- the join --------------------------------------------------------------------


def embedded(fp: Column) -> Column:
    """Set bits of each 2-bit segment in unary."""
    high, even = F.shiftrightunsigned(fp, 1), F.lit(EVEN)
    both, either = fp.bitwiseAND(high).bitwiseAND(even), fp.bitwiseOR(high).bitwiseAND(even)
    return F.shiftleft(both, 1).bitwiseOR(either)


def mask_of(segments: list[int]) -> int:
    """The bits of some segments, as a signed number."""
    mask = sum(3 << (2 * s) for s in segments)
    return mask - (1 << 64) if mask >> 63 else mask


def exact_grids(max_bits: int) -> list[int]:
    groups = [a.tolist() for a in np.array_split(np.arange(SEGMENTS), max_bits + 3)]
    return [mask_of(sum(chosen, [])) for chosen in itertools.combinations(groups, 3)]


def unary(fp: np.ndarray) -> np.ndarray:
    """As ``embedded``."""
    even, high = np.uint64(EVEN), fp >> np.uint64(1)
    return ((fp & high & even) << np.uint64(1)) | ((fp | high) & even)


def close_to(fps: list[np.ndarray], a: np.ndarray, b: np.ndarray | int, max_bits: int) -> np.ndarray:
    """Which pairs of rows are within the radius by every fingerprint; the lower bound goes first."""
    near = np.bitwise_count(unary(fps[0][a]) ^ unary(fps[0][b])) <= max_bits
    for fp in fps:
        k = np.flatnonzero(near)
        near[k] = np.bitwise_count(fp[a[k]] ^ (fp[b] if np.ndim(b) == 0 else fp[b[k]])) <= max_bits
    return near


def walked(fps: list[np.ndarray], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links in one cell, and each row's nearest neighbour."""
    rows = np.arange(len(fps[0]))
    unseen = np.ones(len(rows), dtype=bool)
    a, b = [], []
    for root in rows.tolist():
        if not unseen[root]:
            continue
        unseen[root], waiting = False, [root]
        while waiting:
            k = waiting.pop()
            near = np.flatnonzero(close_to(fps, rows, k, max_bits))
            new = near[unseen[near]]
            unseen[new] = False
            waiting += new.tolist()
            bits = sum(np.bitwise_count(fp[near] ^ fp[k]).astype(int) for fp in fps)
            bits[near == k] = 999
            other = np.union1d(new, near[bits.argmin()]) if len(near) > 1 else new
            a.append(np.full(len(other), k))
            b.append(other)
    return np.concatenate(a), np.concatenate(b)


def cell_links(cell: np.ndarray, fps: list[np.ndarray], max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of row numbers that link; rows of a cell are consecutive."""
    starts = np.flatnonzero(np.diff(cell, prepend=cell[0] - 1)) if len(cell) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(cell)))
    size = np.repeat(sizes, sizes)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    rows = np.flatnonzero((size > 1) & (size <= SMALL))
    shift = 1
    while len(rows):
        rows = rows[rows + shift < len(cell)]
        rows = rows[cell[rows] == cell[rows + shift]]
        close = rows[close_to(fps, rows, rows + shift, max_bits)]
        left.append(close)
        right.append(close + shift)
        shift += 1
    a, b = np.concatenate(left), np.concatenate(right)
    group = np.repeat(np.arange(len(sizes)), sizes)
    found = np.bincount(group[a], minlength=len(sizes))
    many = (sizes > SMALL) | (found > PER_ROW * sizes)
    stay = ~many[group[a]]
    parts = [(a[stay], b[stay])]
    for k in np.flatnonzero(many):
        x, y = walked([fp[starts[k] : starts[k] + sizes[k]] for fp in fps], max_bits)
        parts.append((x + starts[k], y + starts[k]))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def links(nodes: DataFrame, grids: list[int], max_bits: int) -> DataFrame:
    """(a, b): nodes (columns node and fp) whose fingerprints differ in ``max_bits`` bits or fewer.

    Where a cell has many links, a spanning forest of them and each row's nearest neighbour.
    """
    code = embedded(F.col("fp"))
    fps = ["fp"]
    keys = F.array(*[F.xxhash64(F.lit(g), code.bitwiseAND(F.lit(mask))) for g, mask in enumerate(grids)])
    cells = nodes.select("node", *fps, F.explode(keys).alias("cell"))
    hot = written(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SPLIT), "hot-cells")
    n_hot = hot.count()
    if n_hot:
        hot = F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot
        blocks = F.ceil(F.col("n") / SPLIT).cast("int")
        own = F.pmod(F.xxhash64("node"), blocks).cast("int")
        shares = F.transform(
            F.sequence(F.lit(0), blocks - 1), lambda k: F.xxhash64("cell", F.least(k, own), F.greatest(k, own))
        )
        cells = cells.join(hot, "cell", "left").select(
            "node", *fps, F.explode(F.when(F.col("n").isNull(), F.array("cell")).otherwise(shares)).alias("cell")
        )

    def pairs(cell: np.ndarray, node: np.ndarray, *fps: np.ndarray) -> pa.RecordBatch:
        a, b = cell_links(cell, [fp.view(np.uint64) for fp in fps], max_bits)
        return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows = [np.zeros(0, np.int64)] * (2 + len(fps))
        for batch in batches:
            fresh = [batch.column(c).to_numpy() for c in ("cell", "node", *fps)]
            rows = [np.concatenate(x) for x in zip(open_rows, fresh, strict=True)]
            # The last cell may go on in the next batch.
            cut = int(np.searchsorted(rows[0], rows[0][-1], "left")) if len(rows[0]) else 0
            if cut:
                yield pairs(*(x[:cut] for x in rows))
            open_rows = [x[cut:] for x in rows]
        if len(open_rows[0]):
            yield pairs(*open_rows)

    # Rows of a cell in the order of nodes: cells that share members then grow the same forests.
    dealt = cells.repartition("cell").sortWithinPartitions("cell", "node")
    return dealt.select("cell", "node", *fps).mapInArrow(run, "a long, b long").distinct()


def simhash_components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 3, max_bits: int = 3
) -> DataFrame:
    """Per document (id, fingerprint, component_id): the smallest id that links of ``max_bits``
    or fewer differing bits reach. Lossless.

    Fingerprint as 16 hexadecimal digits. Null texts are empty; empty texts have fingerprint
    zero. Repeated rows come back each; a null id is never a component's id unless all are null.
    """
    found = written(
        fingerprints(docs, text_col=text_col, size=size, keep={id_col: col(id_col)}), "fingerprints"
    )
    distinct = found.groupBy(F.col("fp").alias("node")).agg(F.min(col(id_col)).alias("least"))
    nodes = distinct.select("node", F.col("node").alias("fp"))
    roots = components(links(nodes, exact_grids(max_bits), max_bits), "a", "b")
    rooted = distinct.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(named, "root").select(F.col("node").alias("fp"), "component_id")
    return found.join(by_fp, "fp").select(
        col(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns that tells nulls apart by their place."""
    values = [F.to_json(F.struct(c)) if isinstance(f.dataType, T.MapType) else c for f in docs.schema for c in [col(f.name)]]
    return F.xxhash64(*values, F.array(*[v.isNull() for v in values]))


def drop_near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 3, max_bits: int = 3
) -> DataFrame:
    """One whole row of each component of ``simhash_components``: that with the smallest id, ties by a hash of all columns.

    Null ids come first; empty and null texts are one component. All columns stay as they are. Texts stay where they
    are as long as the rows that go are few; else they move once.
    """
    key = row_hash(docs)
    found = written(fingerprints(docs, text_col=text_col, size=size, keep={"id": col(id_col), "key": key}), "fingerprints")
    distinct = found.groupBy(F.col("fp").alias("node")).agg(F.min(F.struct("id", "key")).alias("least"))
    roots = components(links(distinct.select("node", F.col("node").alias("fp")), exact_grids(max_bits), max_bits), "a", "b")
    chosen = distinct.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(
        F.min("least").alias("least")
    )
    stay = written(chosen.select(F.col("least.key").alias("key")), "stay")
    # Rows that share a key are equal in all columns.
    counts = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    go = written(counts.join(stay.withColumn("stays", F.lit(True)), "key", "left").where("n > 1 or stays is null"), "go")
    n_go, n_repeated = go.agg(F.count(F.lit(1)), F.count(F.when(F.col("stays"), 1))).first()
    keyed = docs.select(F.struct(*[col(n) for n in docs.columns]).alias("kept"), key.alias("key"))
    gone = go.select("key")
    kept = keyed.join(F.broadcast(gone) if n_go <= BROADCAST_ROWS else gone, "key", "left_anti").select("kept")
    if n_repeated:
        repeated = keyed.join(go.where("stays").select("key"), "key", "left_semi")
        kept = kept.unionByName(repeated.groupBy("key").agg(F.first("kept").alias("kept")).select("kept"))
    return kept.select("kept.*")
