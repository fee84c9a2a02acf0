"""Messages, lines and events made from the stored tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatpulse.functions.lines import epoch_text
from chatpulse.operators.lines import format_lines

#: Arrival of document 0; every later document arrives one second after the one before.
FIRST_ARRIVAL = "2024-01-01 00:00:00"

#: Weights of frequent tokens of the stored prose.
TABLE_LEXICON = {
    "ononst": 1,
    "orantion": 2,
    "thing": 1,
    "oning": 1,
    "thatin": -1,
    "inoran": -2,
    "thble": -1,
    "erble": -1,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lexicon_table(spark: SparkSession, weights: dict[str, int]) -> DataFrame:
    """``token, weight`` rows of known size."""
    rows = ", ".join(f"('{token}', {weight})" for token, weight in weights.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS lexicon(token, weight)")


def document_messages(documents: DataFrame, first: str = FIRST_ARRIVAL, step: int = 1) -> DataFrame:
    """One message per document: 60 a minute, so the one-minute limit of 50 does evict.

    ``first`` is the arrival of document 0, ``step`` the seconds from one document to the next.
    """
    arrival = F.timestamp_seconds(
        F.unix_timestamp(F.lit(first).cast("timestamp")) + F.col("doc_id") * step
    )
    return documents.select(
        arrival.alias("arrival"),
        F.col("doc_id").alias("seq"),
        F.unix_seconds(arrival).alias("event_time"),
        F.col("source").alias("user"),
        F.col("text").alias("message"),
    )


def _event_user():
    return F.concat(F.lit("U"), F.col("user_id").cast("string"))


def _event_text():
    return F.concat_ws(" ", "event_type", "props")


def event_messages(events: DataFrame) -> DataFrame:
    arrival = F.col("ts").cast("timestamp")
    return events.select(
        arrival.alias("arrival"),
        F.col("event_id").alias("seq"),
        F.unix_seconds(arrival).alias("event_time"),
        _event_user().alias("user"),
        _event_text().alias("message"),
    )


def event_feed(events: DataFrame) -> DataFrame:
    """The events as a chat-event feed: the event type serves as the channel."""
    return events.select(
        F.lit("message").alias("type"),
        F.col("event_type").alias("channel"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("arrival"),
        epoch_text(F.col("ts").cast("timestamp")).alias("ts"),
        _event_user().alias("user"),
        _event_text().alias("text"),
    )


def event_lines(events: DataFrame) -> DataFrame:
    """All events as lines; those of type ``error`` break off before their message."""
    lines = format_lines(event_feed(events))
    broken = F.regexp_extract("value", r"^(.*?, .*?), ", 1)
    return lines.select(
        "seq", F.when(F.col("channel") == "error", broken).otherwise(F.col("value")).alias("value")
    )


def turn_messages(conversations: DataFrame) -> DataFrame:
    """Conversation turns as messages, ten seconds apart, keyed by ``conv_id``."""
    arrival = F.timestamp_seconds(
        F.unix_timestamp(F.lit(FIRST_ARRIVAL).cast("timestamp")) + F.col("turn") * 10
    )
    return conversations.select(
        "conv_id",
        arrival.alias("arrival"),
        F.col("turn").alias("seq"),
        F.col("role").alias("user"),
        F.col("text").alias("message"),
    )
