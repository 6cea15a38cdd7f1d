"""Numbered output folders, complete once the committer has left its marker, on any
filesystem Spark writes to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def complete_versions(spark: SparkSession, root: str) -> list[int]:
    pattern, fs = _filesystem(spark, f"{root}/v=*/_SUCCESS")
    found = fs.globStatus(pattern) or []
    return sorted(int(status.getPath().getParent().getName().partition("=")[2]) for status in found)


def version_path(root: str, version: int) -> str:
    return f"{root}/v={version}"


def read_versions(spark: SparkSession, root: str, versions: list[int], schema: T.StructType) -> DataFrame:
    """The rows of the given folders with their number as ``v``. The number is part of
    the schema, so that folders without any row do not change it."""
    numbered = T.StructType([*schema.fields, T.StructField("v", T.LongType())])
    paths = [version_path(root, v) for v in versions]
    return spark.read.option("basePath", root).schema(numbered).parquet(*paths)


def is_complete(spark: SparkSession, root: str, version: int) -> bool:
    marker, fs = _filesystem(spark, f"{version_path(root, version)}/_SUCCESS")
    return fs.exists(marker)


def write_version(df: DataFrame, root: str, version: int, *partitions: str, format: str = "parquet") -> None:
    """Write a numbered folder once: one that is complete stays as it is, so that readers
    never miss it while a batch runs again; one that was broken off is replaced."""
    if not is_complete(df.sparkSession, root, version):
        writer = df.write.mode("overwrite").format(format)
        (writer.partitionBy(*partitions) if partitions else writer).save(version_path(root, version))


def days_of(spark: SparkSession, root: str, version: int) -> list[str]:
    """The day partitions of a numbered folder."""
    pattern, fs = _filesystem(spark, f"{version_path(root, version)}/day=*")
    return sorted(s.getPath().getName().partition("=")[2] for s in fs.globStatus(pattern) or [])


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One file, replaced if it is there."""
    hadoop_path, fs = _filesystem(spark, path)
    out = fs.create(hadoop_path, True)
    try:
        out.write(text.encode("utf-8"))
    finally:
        out.close()


def delete_folder(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _filesystem(spark, path)
    fs.delete(hadoop_path, True)
