"""The manifest against a plain tree over sorted leaves."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from isobar.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][k : k + 16])) for k in range(0, len(out[-1]), 16)])
    return out


def path(levels, at):
    out = []
    for level in levels[:-1]:
        start = at // 16 * 16
        out.append(("".join(level[start:at]), "".join(level[at + 1 : start + 16])))
        at //= 16
    return out


def expected(rows):
    """(id, group, text) to (id, group, leaf, position, path, subroot, root)."""
    groups = {}
    for i, g, t in rows:
        groups.setdefault(g, []).append((i, digest(field(i) + field(g) + field(t))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = tree([h for _, h in groups[g]])
    top = tree([trees[g][-1][0] for g in names])
    return [
        (i, g, h, k, path(trees[g], k) + path(top, names.index(g)), trees[g][-1][0], top[-1][0])
        for g in names for k, (i, h) in enumerate(groups[g])
    ]


def manifest(spark, rows, **own):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    return merkle.manifest(docs, fields=["doc_id", "source", "text"], **own)


def plain(found):
    columns = ("doc_id", "group", "leaf", "position", "path", "subroot", "root")
    return sorted(
        (tuple([tuple(p) for p in r[c]] if c == "path" else r[c] for c in columns) for r in found.collect()), key=str
    )


def rows_of(case):
    rng = random.Random(3)
    if case == "one":
        return [(5, "a", "x")]
    if case == "lone leaves":
        return [(k, f"s{k}", "x") for k in range(300)]
    if case == "wide ids":
        own = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(300)] + [-(1 << 63), (1 << 63) - 1, 0, -1, 63, 64, -64, 1 << 32]
        return [(i, rng.choice(["a", "b", None, "é", "B", ""]), str(i)) for i in own]
    if case == "ties":
        # A null id with many texts, one id for a third of the rows, and rows that are equal.
        rows = [(rng.choice([None, 7, 7, *range(60)]), "a", rng.choice(["x", "y", f"t{k}"])) for k in range(200)]
        return rows + [(7, "a", f"u{k}") for k in range(100)] + [(3, None, None)] * 20 + [(None, None, None)] * 3
    return [(k * 3, "hot" if k % 3 else f"s{k % 4}", f"text {k}") for k in range(5000)]


@pytest.mark.parametrize("height", [1, 3])
@pytest.mark.parametrize("case", ["one", "lone leaves", "wide ids", "ties", "hot group"])
def test_against_a_plain_tree(spark, case, height):
    """Blocks of one level make many passes of what blocks of three do in one or two."""
    rows = rows_of(case)
    assert plain(manifest(spark, rows, height=height)) == sorted(expected(rows), key=str)


def test_proofs_tell_tampered_texts(spark):
    rows = [(k, "a" if k % 3 else "b", f"Text {k}") for k in range(100)]
    tampered = merkle.leaf_hash([F.col("doc_id"), F.col("source"), F.lower("text")])
    found = manifest(spark, rows, keep={"tampered": tampered})
    checked = found.select(
        (merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("good"),
        (merkle.folded(F.col("tampered"), F.col("path")) == F.col("root")).alias("bad"),
    ).collect()
    assert len(checked) == 100 and all(r["good"] and not r["bad"] for r in checked)


def test_a_lost_leaf_is_no_shorter_tree():
    import pyarrow as pa

    nodes = pa.table({"position": [0, 2], "n": [3, 3], "hash": [digest("a"), digest("b")]})
    with pytest.raises(RuntimeError):
        merkle.levels(nodes, 3)
