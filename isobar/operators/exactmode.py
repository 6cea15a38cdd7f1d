"""The exact mode of numeric columns; their values are only sent over the network where nothing is frequent.

A sketch of frequent values proposes; exact counts of what it proposed decide, as long as they exceed what the sketch
guarantees for everything else. That settles columns that have a frequent value.

Where values are all different, or the most frequent one is rare, they are counted by a shuffle, up to ``FEW_VALUES`` of
them. In longer columns every value is hashed to one of some 128 slots for each value. Rows are counted by slot: a task
sends its slots as sorted arrays, a row for thousands of values.
A value is no more frequent than its slot, so only slots that hold as many rows as the best exact count
found so far are counted by value. Most of a column's values are alone in their slots and never leave their task.

No way decides more cheaply whether anything repeats at all: that takes bits in proportion to the number of
different values. A column of more than ``MOST_VALUES`` values, or with more slots to count than may be
broadcast, is counted by value after all, which is exact too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from isobar.operators.frequency import modes
from isobar.operators.numeric import as_doubles, numeric_columns
from isobar.operators.partials import Partial, gathered, long_form
from isobar.session import shared_dir

TRACKED = 10_000
#: The share of all rows by which a count of a sketch with so many entries may be too high: 3.5 by the size of its table,
#: which is a power of two above what it tracks at three quarters.
SKETCH_ERROR = 3.5 / 8192
#: Fewer different values than this are all tracked, and their counts exact.
SURELY_TRACKED = 6_000
PROPOSED = 17

#: Slots for each value, as a power of two; values of a shard, likewise.
SLOT_BITS, SHARD_BITS = 7, 20
#: Values that a task hashes before it sends slots.
FLUSH = 1 << 20
#: Up to so many values a shuffle of their counts, which repeated values shrink first, costs less time than the passes
#: over slots, and no memory of Python.
FEW_VALUES = 1 << 30
#: Past this many shards a row would hold too few slots.
MOST_VALUES = 1 << (SHARD_BITS + 13)
#: Slots that are broadcast, some 16 bytes each.
BROADCAST_SLOTS = 2_000_000
#: The fullest slots are counted by value first.
FIRST_SLOTS = 1_000
SEED = 42

FREQUENT = Partial(
    "frequent", f"approx_top_k_accumulate(s, {TRACKED}) FILTER (WHERE s IS NOT NULL)",
    f"approx_top_k_estimate(approx_top_k_combine(frequent, {TRACKED}), {PROPOSED})",
)
SCHEMA = "field string, n bigint, has_mode boolean, mode double, n_mode bigint"


@dataclass(frozen=True)
class Mode:
    """The most frequent value and its count; ``value`` is the smallest of several. Null and 0 without any value."""

    value: float | None
    n: int

    def record(self) -> tuple:
        """(has_mode, mode): none where nothing repeats."""
        return (self.n > 1, self.value if self.n > 1 else None)


def proposals(frequent: Sequence, n: int) -> tuple[list[float], int]:
    """The proposed values, and the count that no other value exceeds."""
    found = [(r["item"], r["count"]) for r in frequent or [] if r["item"] is not None]
    if len(found) < PROPOSED:
        others = 0 if n <= SURELY_TRACKED else math.ceil(2 * SKETCH_ERROR * n)
    else:
        others = found[-1][1]
    return [v for v, _ in found], others


def best(counts: dict[float, int]) -> Mode:
    return Mode(*min(counts.items(), key=lambda c: (-c[1], c[0]))) if counts else Mode(None, 0)


def decided(counts: dict[float, int], others: int, n: int) -> Mode | None:
    """The mode by exact counts of proposed values, where no other value comes near."""
    found = best(counts)
    if found.n > others or n == 0 or (n <= SURELY_TRACKED and found.n == 1):
        return found
    return None


def slot_of(hashes: str, bits: int) -> str:
    """The highest bits of a hash."""
    return f"shiftrightunsigned({hashes}, {64 - bits})"


def slot_counts(rows: DataFrame, n_values: int) -> tuple[DataFrame, int]:
    """(id, slot, n) of the slots that two rows of (id, x) at least share, and the bits of a slot."""
    bits = max(math.ceil(math.log2(max(n_values, 2))), 1) + SLOT_BITS
    in_shard = min(SHARD_BITS + SLOT_BITS, bits)
    hashed = rows.where("x IS NOT NULL").select("id", F.xxhash64(F.lit(SEED), "x").alias("h"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, slots, held = [], [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            own, slot = np.concatenate(ids).astype(np.int64), np.concatenate(slots)
            order = np.lexsort((slot, own))
            own, slot = own[order], slot[order]
            starts = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (slot[1:] != slot[:-1])]))
            n = np.diff(np.append(starts, len(own)))
            own, slot = own[starts], slot[starts]
            shard = (slot >> np.uint64(in_shard)).astype(np.int64)
            cuts = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (shard[1:] != shard[:-1])]))
            ends = pa.array(np.append(cuts, len(own)), pa.int32())
            low = (slot & np.uint64((1 << in_shard) - 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[cuts], pa.int32()), pa.array(shard[cuts]), pa.ListArray.from_arrays(ends, pa.array(low)),
                 pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int32)))],
                names=["id", "shard", "slots", "counts"],
            )

        for batch in batches:
            h = batch.column("h").to_numpy().view(np.uint64)
            ids.append(batch.column("id").to_numpy())
            slots.append(h >> np.uint64(64 - bits))
            held += len(h)
            if held >= FLUSH:
                yield from flushed()
                ids, slots, held = [], [], 0
        if held:
            yield from flushed()

    def total(shard: pa.Table) -> pa.Table:
        slots, counts = (shard.column(c).combine_chunks().flatten().to_numpy() for c in ("slots", "counts"))
        different, where = np.unique(slots, return_inverse=True)
        n = np.bincount(where, weights=counts, minlength=len(different)).astype(np.int64)
        several = n > 1
        high = np.int64(shard.column("shard")[0].as_py()) << in_shard
        return pa.table(
            {
                "id": pa.array(np.full(several.sum(), shard.column("id")[0].as_py()), pa.int32()),
                "slot": pa.array(different[several].astype(np.int64) + high), "n": pa.array(n[several]),
            }
        )

    sent = hashed.mapInArrow(send, "id int, shard long, slots array<int>, counts array<int>")
    return sent.groupBy("id", "shard").applyInArrow(total, "id int, slot long, n long"), bits


def first_bound(sizes: list[tuple[int, int]]) -> int:
    """From how many rows on a slot is counted first: so that no more than ``FIRST_SLOTS`` are, unless all are."""
    if sum(c for _, c in sizes) <= FIRST_SLOTS:
        return 2
    bound, taken = max(n for n, _ in sizes) + 1, 0
    for n, c in sorted(sizes, reverse=True):
        taken += c
        if taken > FIRST_SLOTS:
            break
        bound = n
    return bound


def _from(slots: DataFrame, least: dict[int, int], below: dict[int, int] | None = None) -> DataFrame:
    """(id, slot) of the slots with so many rows or more, and fewer than ``below``."""
    bounds = [(k, n, below[k] if below else 1 << 62) for k, n in least.items()]
    wanted = slots.sparkSession.createDataFrame(bounds, "id int, least long, below long")
    return slots.join(F.broadcast(wanted), "id").where("n >= least AND n < below").select("id", "slot")


def _counted(rows: DataFrame, slots: DataFrame, bits: int) -> dict[int, Mode]:
    """Per id the most frequent value within some slots, by exact counts."""
    slot = F.expr(slot_of(f"xxhash64({SEED}, x)", bits))
    found = rows.where("x IS NOT NULL").withColumn("slot", slot).join(F.broadcast(slots), ["id", "slot"], "left_semi")
    counts = found.groupBy("id", "x").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("id").agg(F.min(F.struct((-F.col("n")).alias("minus"), "x")).alias("top")).collect()
    return {r["id"]: Mode(r["top"]["x"], -r["top"]["minus"]) for r in top}


def by_slots(rows: DataFrame, sizes: dict[int, int]) -> dict[int, Mode]:
    """The modes of the ids in ``sizes`` (their numbers of values) over ``rows`` (id, x). A mode that occurs
    once has no value."""
    spark = rows.sparkSession
    out = {k: Mode(None, 1) for k in sizes}
    by_value = [k for k, n in sizes.items() if n > MOST_VALUES or n <= FEW_VALUES]
    rest = [k for k in sizes if k not in by_value]
    if rest:
        own = rows.where(F.col("id").isin(rest))
        slots, bits = slot_counts(own, max(sizes[k] for k in rest))
        path = shared_dir(spark, "slots")
        slots.write.parquet(path)
        slots = spark.read.schema(slots.schema).parquet(path)
        # How many slots have how many rows: at most as many rows as the square root of twice the values.
        sizes_of: dict[int, list[tuple[int, int]]] = {}
        for r in slots.groupBy("id", "n").agg(F.count(F.lit(1)).alias("slots")).collect():
            sizes_of.setdefault(r["id"], []).append((r["n"], r["slots"]))
        least = {k: first_bound(found) for k, found in sizes_of.items()}
        for k, found in _counted(own, _from(slots, least), bits).items():
            if found.n > 1:
                out[k] = found
        # Whatever else may be as frequent as the best so far.
        rest_of = {k: out[k].n for k, found in sizes_of.items() if any(max(out[k].n, 2) <= n < least[k] for n, _ in found)}
        n_left = {k: sum(c for n, c in sizes_of[k] if max(m, 2) <= n < least[k]) for k, m in rest_of.items()}
        if sum(n_left.values()) <= BROADCAST_SLOTS:
            left = _from(slots, {k: max(m, 2) for k, m in rest_of.items()}, least)
            for k, found in _counted(own, left, bits).items():
                if found.n > 1:
                    out[k] = min(out[k], found, key=lambda m: (-m.n, m.value if m.value is not None else math.inf))
        else:
            by_value += list(n_left)
    if by_value:
        values = rows.where(F.col("id").isin(by_value) & F.col("x").isNotNull())
        counts = values.groupBy(F.col("id").alias("field"), F.col("x").alias("value")).agg(F.expr("count(*) AS n"))
        for r in modes(counts, with_count=True).collect():
            out[r["field"]] = Mode(r["mode"], r["n_mode"])
    return out


def counts_of(rows: DataFrame, proposed: dict[int, list[float]]) -> dict[int, dict[float, int]]:
    """Exact counts of some values of each id over ``rows`` (id, x)."""
    pairs = [(k, v) for k, values in proposed.items() for v in values]
    if not pairs:
        return {}
    wanted = rows.sparkSession.createDataFrame(pairs, "id int, x double")
    found = rows.join(F.broadcast(wanted), ["id", "x"]).groupBy("id", "x").agg(F.count(F.lit(1)).alias("n")).collect()
    out: dict[int, dict[float, int]] = {}
    for r in found:
        out.setdefault(r["id"], {})[r["x"]] = r["n"]
    return out


def exact_modes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(field, n, has_mode, mode, n_mode)`` per numeric column: the smallest of the most frequent values.

    ``has_mode`` is false, and the mode null, when no value occurs twice. Runs its scans when called; the
    result is one local row per column.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    doubles = as_doubles(df, columns)
    rows = long_form(doubles, doubles.columns)
    first = {r["id"]: r for r in gathered(rows, [FREQUENT]).collect()} if columns else {}
    proposed = {k: proposals(r["frequent"], r["n"]) for k, r in first.items()}
    counts = counts_of(rows, {k: values for k, (values, _) in proposed.items()})
    found = {k: decided(counts.get(k, {}), others, first[k]["n"]) for k, (_, others) in proposed.items()}
    open_ = {k: first[k]["n"] for k, m in found.items() if m is None}
    found |= by_slots(rows, open_) if open_ else {}
    none = Mode(None, 0)
    records = [
        (c, first[k]["n"] if k in first else 0, *found.get(k, none).record(), found.get(k, none).n) for k, c in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(records, SCHEMA)
