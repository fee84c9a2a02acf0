"""Sinks. ``*_sink`` functions return ``(frame, batch_id) -> None`` for streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from chatpulse.config import KafkaSettings

BatchSink = Callable[[DataFrame, int], None]


def write_lines(lines: DataFrame, path: str) -> None:
    """``value`` as text files, one message per line."""
    lines.select("value").write.mode("append").text(path)


def write_lines_to_kafka(lines: DataFrame, settings: KafkaSettings) -> None:
    (
        lines.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", settings.bootstrap_servers)
        .option("topic", settings.messages_topic)
        .save()
    )


def table_sink(path: str) -> BatchSink:
    """Append to a parquet table, one folder per micro-batch.

    A micro-batch that runs again after a failure replaces its own folder, so every
    window is stored once. Readers resolve repeated results with ``latest_per_window``.
    """

    def write(frame: DataFrame, batch_id: int) -> None:
        frame.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def kafka_sink(settings: KafkaSettings, topic: str) -> BatchSink:
    """Publish ``value`` without a key, at least once."""

    def write(frame: DataFrame, batch_id: int) -> None:
        (
            frame.select("value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", settings.bootstrap_servers)
            .option("topic", topic)
            .save()
        )

    return write


def both(*sinks: BatchSink) -> BatchSink:
    def write(frame: DataFrame, batch_id: int) -> None:
        for sink in sinks:
            sink(frame, batch_id)

    return write
