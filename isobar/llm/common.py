"""Helpers that the operators of this folder share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from isobar.functions.sql import ident

M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col(ident(name))


def text_of(name: str) -> Column:
    """A text column as string, null as the empty text."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def crc_mod(name: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(col(name).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def total_bytes(df: DataFrame, text: str) -> int:
    return df.select(F.sum(F.octet_length(text_of(text)))).first()[0] or 0


def pieces_for(spark: SparkSession, size: int, piece: int, times: int = 1) -> int:
    """Groups to deal out: so many that none is much larger than ``piece`` bytes, and
    ``times`` as many as there are shuffle partitions at least."""
    return max(math.ceil(size / piece), times * int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser; wraps."""
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


def id_type(df: DataFrame, name: str) -> T.DataType:
    return next(f.dataType for f in df.schema.fields if f.name == name)


def binaries(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column without nulls."""
    return column.cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch | pa.Table, text: str, size: int) -> Iterator[pa.RecordBatch | pa.Table]:
    """Consecutive rows holding about ``size`` bytes of text; one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text).cast(pa.binary())), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def labelled_sample(
    docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, bound: int
) -> DataFrame:
    """(id, text, label) of about ``bound`` labelled documents at most.

    Labels are taken by a hash of their id, so that every labelled row is as likely; a
    document that has several rows or labels counts once. The ids are few by the bound, so they
    are broadcast and the texts of other documents never move.
    """
    known = labels.where(col(label_col).isNotNull() & col(id_col).isNotNull()).groupBy(
        col(id_col).alias("id")
    ).agg(F.max(col(label_col)).cast("int").alias("label"))
    n = known.count()
    share = F.pmod(F.xxhash64(F.col("id"), F.lit(17)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, bound / max(n, 1)))
    texts = docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    return texts.join(F.broadcast(known.where(share)), "id")
