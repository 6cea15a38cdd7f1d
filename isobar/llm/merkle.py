"""A Merkle manifest of a dataset, with proofs, by bitmap ranks.

Every row is a leaf: the sha256 of its fields. The leaves of a group ascend by id, and every 16
consecutive nodes become the hash of their concatenated hexadecimal digests until one is left. The
roots of the groups, ordered by name (null first, then by bytes), give the root of the dataset likewise.

Coordinates. No leaf is sorted to find its place. A group's ids make a bitmap, kept compressed as the
64-bit words that have a bit at all; a bitwise or merges them, partially in every task. The directory
says how many leaves lie before each word: a word's number is cut into four digits, and each digit has
sums of its own among at most 65,536 siblings, so no window is longer than that, however many ids a
group has. A leaf's coordinate is the directory's entry and the set bits below its own in its word. Ids that
occur several times carry their counts beside the word; such leaves are ranked among themselves by a
second bitmap, over their digests. Ids are integers; a null id comes before all others.

Levels. 4,096 consecutive nodes, three levels, are one group of a task: digests go to the slots that
their coordinates name, and runs of 16 slots are hashed in place. A pass leaves one node for each block, so
there are as many passes as the largest group needs, and a hot group is many blocks. On the way back each
block gets the siblings above it and hands its members theirs.

Rows that are equal in all fields are leaves each, next to each other. A null field counts as ``-``; an empty
table gives no rows. Columns that are not named are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from isobar.llm.common import col, id_type
from isobar.llm.components import written

FAN = 16
#: Levels that a pass takes.
LEVELS = 3
#: Bits that each digit of a word's number leaves out, the coarsest digit first.
DIGITS = (42, 26, 10)
#: The word of null ids, below all others.
NULL_WORD = -(1 << 57) - 1
PATH = "array<struct<before:string,after:string>>"


# --- leaves ------------------------------------------------------------------------


def field(value: Column) -> Column:
    """``-`` for null, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


# --- ranks -------------------------------------------------------------------------


def bits_below(bits: Column) -> Column:
    """Set bits under the one that the column low names."""
    return F.bit_count(bits.bitwiseAND(F.bitwise_not(F.expr("shiftleft(-1L, low)")))).cast("long")


def before_siblings(counts: DataFrame, parent: list[Column], digit: str) -> Column:
    rows_before = Window.partitionBy(*parent).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(rows_before), F.lit(0))


def with_ranks(rows: DataFrame, number: Column, weight: Column) -> DataFrame:
    """``rows`` (with a column grp that is not null) and two more columns: rank, the weight of all rows of the
    same grp whose number is smaller, and n_same, the weight of those with the same number."""
    rows = rows.withColumns(
        {
            "word": F.coalesce(F.shiftright(number, 6), F.lit(NULL_WORD)),
            "low": F.coalesce(number.bitwiseAND(F.lit(63)), F.lit(0)).cast("int"),
            "weight": weight.cast("long"),
        }
    )
    words = written(
        rows.groupBy("grp", "word").agg(F.bit_or(F.expr("shiftleft(1L, low)")).alias("bits"), F.sum("weight").alias("n")),
        "bitmap",
    )
    more = F.array().cast("array<struct<low:int,n:bigint>>")
    crowded = words.where(F.col("n") > F.bit_count("bits")).select("grp", "word")
    if crowded.isEmpty():
        words = words.withColumn("more", more)
    else:
        by_id = rows.join(crowded, ["grp", "word"], "left_semi").groupBy("grp", "word", "low").agg(F.sum("weight").alias("n"))
        counts = by_id.where("n > 1").groupBy("grp", "word").agg(F.collect_list(F.struct("low", F.expr("n - 1 AS n"))).alias("more"))
        words = words.join(counts, ["grp", "word"], "left").withColumn("more", F.coalesce("more", more))
    parent: list[Column] = []
    names = []
    for shift in DIGITS:
        name, here = f"before_{shift}", F.shiftright("word", shift)
        counts = words.groupBy("grp", here.alias("digit"), *[p.alias(f"p{k}") for k, p in enumerate(parent)]).agg(
            F.sum("n").alias("n")
        )
        over = [F.col("grp"), *[F.col(f"p{k}") for k in range(len(parent))]]
        names.append((shift, name, counts.select("grp", "digit", before_siblings(counts, over, "digit").alias(name))))
        parent = [here]
    placed = words.withColumn("rank", before_siblings(words, [F.col("grp"), *parent], "word"))
    for shift, name, counts in names:
        placed = placed.withColumn("digit", F.shiftright("word", shift)).join(counts, ["grp", "digit"])
        placed = placed.withColumn("rank", F.col("rank") + F.col(name)).drop("digit", name)
    found = rows.join(placed.drop("n"), ["grp", "word"])

    def count_of(wanted) -> Column:
        return F.aggregate(
            F.filter("more", wanted), F.lit(0).cast("long"), lambda total, one: total + one["n"]
        )

    return found.withColumns(
        {
            "rank": F.col("rank") + bits_below(F.col("bits")) + count_of(lambda m: m["low"] < F.col("low")),
            "n_same": count_of(lambda m: m["low"] == F.col("low")) + F.lit(1),
        }
    ).drop("word", "low", "weight", "bits", "more")


def coordinates(leaves: DataFrame) -> DataFrame:
    """``leaves`` (grp, id, hash, kept) with position: the number of leaves of the grp before it."""
    ranked = with_ranks(leaves, F.col("id").cast("long"), F.lit(1))
    several = written(ranked, "ranks")
    alone = several.where("n_same = 1").select("grp", "id", "hash", "kept", F.col("rank").alias("position"))
    tied = several.where("n_same > 1")
    if tied.isEmpty():
        return alone
    # Rows that are equal are one item of so many copies; items are ranked by 60 bits of their digests.
    items = tied.groupBy("grp", "id", "hash", "kept", "rank").agg(F.count(F.lit(1)).alias("copies"))
    items = items.select(
        F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("-")), "grp").alias("grp"),
        F.col("grp").alias("own"), "id", "hash", "kept", F.col("rank").alias("first"), "copies",
    )
    among = with_ranks(written(items, "tied"), F.conv(F.substring("hash", 1, 15), 16, 10).cast("long"), F.col("copies"))
    copies = F.explode(F.expr("sequence(0L, copies - 1)")).alias("copy")
    each = among.select("own", "id", "hash", "kept", (F.col("first") + F.col("rank")).alias("from"), copies)
    return alone.unionByName(
        each.select(F.col("own").alias("grp"), "id", "hash", "kept", (F.col("from") + F.col("copy")).alias("position"))
    )


def numbered(groups: DataFrame) -> DataFrame:
    """``groups`` with position: their number in the order of grp. Only counts by partition meet in one place."""
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = groups.repartitionByRange("grp").sortWithinPartitions("grp").withColumns(
        {"part": F.spark_partition_id(), "within": within}
    )
    ordered = written(ordered, "groups")
    parts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select("part", before.alias("start"))
    return ordered.join(F.broadcast(starts), "part").withColumn("position", F.col("start") + F.col("within")).drop(
        "part", "within", "start"
    )


# --- levels ------------------------------------------------------------------------


def levels(nodes: pa.Table, height: int) -> list[bytes]:
    """Digests by level of one block (columns position, n, hash), its own nodes first. The last level
    is one node: after ``height`` levels, or as soon as one is left if the block is the whole group."""
    at, n, block = nodes.column("position").to_numpy(), nodes.column("n")[0].as_py(), FAN**height
    size = min(block, n - int(at[0]) // block * block)
    slots, taken = np.zeros(size, dtype="S64"), np.zeros(size, dtype=bool)
    if len(at) != size or at.max() % block >= size:
        raise RuntimeError(f"{len(at)} nodes for {size} slots")
    slots[at % block] = np.array(nodes.column("hash").cast(pa.binary()).to_pylist(), dtype="S64")
    taken[at % block] = True
    if not taken.all():
        raise RuntimeError("two nodes for one slot")
    out, run = [slots.tobytes()], 64 * FAN
    for _ in range(height):
        if n <= block and len(out[-1]) == 64:
            break
        below = out[-1]
        out.append(
            b"".join(hashlib.sha256(below[k : k + run]).hexdigest().encode() for k in range(0, len(below), run))
        )
    return out


def climbed(nodes: DataFrame, most: int, height: int) -> list[DataFrame]:
    """``nodes`` (grp, position, n, hash; n nodes in the grp, ``most`` at most), then those one pass higher, and
    so on up to one node for each grp."""
    size = FAN**height

    def up(block: pa.Table) -> pa.Table:
        n, at = block.column("n")[0].as_py(), block.column("position")[0].as_py()
        return pa.table(
            {
                "grp": block.column("grp").slice(0, 1),
                "position": pa.array([at // size], pa.int64()),
                "n": pa.array([-(-n // size)], pa.int64()),
                "hash": [levels(block, height)[-1].decode()],
            }
        )

    passes = [nodes]
    while most > 1:
        now = passes[-1].select("grp", "position", "n", "hash")
        blocks = now.groupBy("grp", F.expr(f"position div {size}"))
        passes.append(written(blocks.applyInArrow(up, "grp string, position long, n long, hash string"), "nodes"))
        most = math.ceil(most / size)
    return passes


def with_path(block: pa.Table, parent: pa.Table, names: list[str], height: int) -> pa.Table:
    """The nodes of a block with their paths: their siblings in each level, then the path of the block's own node."""
    rising, upper = levels(block, height), parent.column("path")[0].as_py()
    over = [p["before"] for p in upper], [p["after"] for p in upper]
    before, after = [], []
    for at in (block.column("position").to_numpy() % FAN**height).tolist():
        for level in rising[:-1]:
            start = at // FAN * FAN
            before.append(level[64 * start : 64 * at])
            after.append(level[64 * (at + 1) : 64 * (start + FAN)])
            at //= FAN
        before += over[0]
        after += over[1]
    steps = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], ["before", "after"])
    ends = np.arange(len(block) + 1) * (len(rising) - 1 + len(upper))
    first = pa.array(np.zeros(len(block), dtype=np.int64))
    return pa.table(
        {
            **{n: block.column(n) for n in names},
            "path": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps),
            **{n: parent.column(n).take(first) for n in ("subroot", "root")},
        }
    )


def descent(names: list[str], height: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def down(block: pa.Table, parent: pa.Table) -> pa.Table:
        return with_path(block, parent, names, height)

    return down


def descended(passes: list[DataFrame], top: DataFrame, height: int) -> DataFrame:
    """The first of ``passes`` with each node's path to the root, its siblings by level, and with subroot and root.

    ``top`` (grp, path, subroot, root) says what is above the one node of each grp.
    """
    if len(passes) == 1:
        return passes[0].join(top, "grp")
    above = top.withColumn("position", F.lit(0).cast("long"))
    for nodes in reversed(passes[:-1]):
        schema = T.StructType([*nodes.schema.fields, *(above.schema[n] for n in ("path", "subroot", "root"))])
        down = descent(nodes.columns, height)
        parents = above.select("grp", "position", "path", "subroot", "root").groupBy("grp", "position")
        above = nodes.groupBy("grp", F.expr(f"position div {FAN**height}")).cogroup(parents).applyInArrow(down, schema)
    return above


# --- the manifest ------------------------------------------------------------------


def manifest(
    docs: DataFrame, *, fields: list[str], group_col: str = "source", id_col: str = "doc_id",
    keep: dict[str, Column] | None = None, height: int = LEVELS,
) -> DataFrame:
    """Per row (id, group, leaf, position, path, subroot, root) and the columns of ``keep``.

    ``leaf`` hashes ``fields`` in their order; ``path`` holds for each level the digests before and after the
    leaf's own node in its run of 16, up to the root of the dataset. A pass takes ``height`` levels.
    """
    keep = keep or {}
    group, kind = col(group_col).cast("string"), id_type(docs, id_col)
    kept = F.struct(group.alias("group"), *[c.alias(n) for n, c in keep.items()])
    leaves = written(
        docs.select(
            # Names in the order of their bytes, with null first.
            F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("grp"),
            col(id_col).alias("id"), leaf_hash([col(f) for f in fields]).alias("hash"), kept.alias("kept"),
        ),
        "leaves",
    )
    sizes = leaves.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    groups = written(numbered(sizes), "numbers")
    n_groups, most = groups.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    placed = written(coordinates(leaves).join(groups.select("grp", "n"), "grp"), "placed")
    passes = climbed(placed, most, height)

    roots = passes[-1].select("grp", "hash").join(groups.select("grp", "position"), "grp")
    over = climbed(
        written(
            roots.select(
                F.lit("").alias("grp"), F.col("grp").alias("name"), "position",
                F.lit(n_groups).cast("long").alias("n"), "hash",
            ),
            "subroots",
        ),
        n_groups, height,
    )
    none = F.lit(None).cast("string")
    top = over[-1].select("grp", F.array().cast(PATH).alias("path"), none.alias("subroot"), F.col("hash").alias("root"))
    named = descended(over, top, height).select(F.col("name").alias("grp"), "path", F.col("hash").alias("subroot"), "root")
    found = descended(passes, written(named, "paths"), height)
    return found.select(
        F.col("id").cast(kind).alias(id_col), "kept.*", F.col("hash").alias("leaf"), "position", "path", "subroot", "root"
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["before"], h, step["after"]), 256))


def siblings(path: Column) -> Column:
    """All digests of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")
