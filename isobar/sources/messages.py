"""Message sources and sinks: ``(key, value)`` text frames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from isobar.sources.versions import write_version

MESSAGE = "key STRING, value STRING"


def topic_set(topics: str | Iterable[str]) -> str:
    """Comma-joined topics, each once."""
    names = topics.split(",") if isinstance(topics, str) else list(topics)
    return ",".join(dict.fromkeys(t.strip() for t in names if t.strip()))


def kafka_messages(
    spark: SparkSession, brokers: str, topics: str | Iterable[str], starting: str = "latest", **options: str
) -> DataFrame:
    """Streaming messages from Kafka. The connector package has to be on the class path.

    Offsets are kept in the query's checkpoint; ``starting`` counts only without one.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic_set(topics))
        .option("startingOffsets", starting)
    )
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "timestamp"
    )


def publish_to_kafka(brokers: str, topic: str):
    """A batch publisher for Kafka. Delivery is at least once."""

    def publish(messages: DataFrame, batch_id: int) -> None:
        (
            messages.select("key", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("topic", topic)
            .save()
        )

    return publish


def publish_to_files(root: str):
    """A batch publisher for a folder; a repeated batch is written once."""

    def publish(messages: DataFrame, batch_id: int) -> None:
        write_version(messages.select("key", "value"), root, batch_id, format="json")

    return publish


def file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming messages from JSON-lines files of keys and values."""
    reader = spark.readStream.schema(MESSAGE).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def landed_responses(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming responses, one document per file, with the time each file landed."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    landed = F.unix_seconds(F.col("_metadata.file_modification_time"))
    return reader.text(path, wholetext=True).select("value", landed.alias("landed_at"))
