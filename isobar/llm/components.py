"""Connected components of a table of links, by alternating stars.

A large star hangs every larger neighbour of a node on the smallest node it knows, a small star
the smaller ones and the node itself; both keep components as they are, and rounds end once the
links are stars around their smallest nodes. Every round is written to the shared folder, which
cuts the lineage and outlives executors. A node with many neighbours is aggregated per task
first, and its join is one that Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from isobar.session import shared_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """The table, computed once and kept in the shared folder."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _hung(edges: DataFrame, keep: str) -> DataFrame:
    """Neighbours v of u that ``keep`` admits, hung on the smallest of u and all such neighbours."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    hung = edges.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has a link to another; the root is the smallest node."""
    edges = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"
    )
    mark = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))]
    before = tuple(edges.agg(*mark).first())
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hung(both, "v > u")
        turned = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = written(_hung(turned, "v < u"), "stars")
        now = tuple(edges.agg(*mark).first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
