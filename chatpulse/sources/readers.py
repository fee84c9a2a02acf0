"""Readers. Each takes ``streaming`` and returns the same columns either way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatpulse.config import KafkaSettings
from chatpulse.schemas import CHAT_EVENT, MESSAGE, RESULT_FEED

#: Arrival order of rows read from Kafka.
KAFKA_ORDER = ("arrival", "partition", "offset")


def _reader(spark: SparkSession, streaming: bool):
    return spark.readStream if streaming else spark.read


def kafka_lines(
    spark: SparkSession,
    settings: KafkaSettings,
    streaming: bool = True,
    topics: list[str] | None = None,
    starting: str | None = None,
) -> DataFrame:
    """``value, arrival, partition, offset, topic`` of one or more topics.

    ``starting`` is ``earliest`` or ``latest``; a restarted stream goes on from its
    checkpoint whatever it says. Needs the Kafka connector on the class path.
    """
    reader = (
        _reader(spark, streaming)
        .format("kafka")
        .option("kafka.bootstrap.servers", settings.bootstrap_servers)
        .option("subscribe", ",".join(topics or [settings.messages_topic]))
    )
    if streaming:
        reader = reader.option("kafka.group.id", settings.group_id)
    if starting:
        reader = reader.option("startingOffsets", starting)
    return reader.load().select(
        "value", F.col("timestamp").alias("arrival"), "partition", "offset", "topic"
    )


def text_lines(spark: SparkSession, path: str, streaming: bool = False, line_sep: str = "\n") -> DataFrame:
    """``value`` per line of text files. Use another separator if messages hold line breaks."""
    return _reader(spark, streaming).format("text").option("lineSep", line_sep).load(path)


def line_table(spark: SparkSession, path: str, schema: T.StructType, streaming: bool = False) -> DataFrame:
    """Lines or messages stored as parquet, with a declared schema."""
    return _reader(spark, streaming).schema(schema).parquet(path)


def message_table(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Parsed messages stored as parquet."""
    return line_table(spark, path, MESSAGE, streaming)


def chat_events(
    spark: SparkSession, path: str, fmt: str = "json", streaming: bool = False
) -> DataFrame:
    """The chat service's event feed; filter it with ``channel_events``."""
    return _reader(spark, streaming).format(fmt).schema(CHAT_EVENT).load(path)


def stamped(lines: DataFrame, clock: Column | None = None) -> DataFrame:
    """Add ``arrival`` for sources that have none: the time of the micro-batch."""
    return lines.withColumn("arrival", F.current_timestamp() if clock is None else clock)


def result_topics(
    spark: SparkSession, settings: KafkaSettings, streaming: bool = True, from_start: bool = True
) -> DataFrame:
    """Both result topics as one feed; ``from_start`` replays everything they hold."""
    topics = [settings.classifier_topic, settings.narrative_topic]
    feed = kafka_lines(spark, settings, streaming, topics, "earliest" if from_start else "latest" if streaming else None)
    return feed.withColumn("value", F.col("value").cast("string"))


def result_table(spark: SparkSession, path: str, streaming: bool = False, files: int | None = None) -> DataFrame:
    """Stored results; a batch read is a replay from the start. ``files`` limits what a micro-batch takes."""
    reader = _reader(spark, streaming).schema(RESULT_FEED)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)
