"""A corpus made ready for training, stage by stage.

STAGES are applied to ``documents`` in order; each result is written to the shared folder and read again
as the next stage's documents. Null doc_ids and texts pass like any others: a null text is empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from isobar.llm import decontamination, packing, quality, simhash, toxicity
from isobar.llm.common import col, table
from isobar.session import shared_dir
from isobar.sources.versions import delete_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"


def free_name(docs: DataFrame) -> str:
    """A name that no column has."""
    return "result" + "_" * max(map(len, docs.columns))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model doesn't reject, learned from the labels of these documents."""
    name = free_name(docs)
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), keep=docs.columns, result=name)
    return scored.where(~col(name)["rejected"]).select(*map(col, docs.columns))


def of_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier good than not."""
    name = free_name(docs)
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"), keep=docs.columns, result=name)
    return scored.where(col(name) >= 0.5).select(*map(col, docs.columns))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group whose fingerprints (three-word shingles) link at 3 bits."""
    return simhash.drop_near_duplicates(docs, size=3, max_bits=3)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, even edited."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences, with their ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("quality", of_good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL cannot express the models, the walks or the tokenizer; ``tests/llm`` compare stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's table goes once the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_dir(spark, name)
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            delete_folder(spark, before)
        before = path
    return docs
