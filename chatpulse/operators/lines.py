"""Message lines: writing, parsing, quarantine, and the chat-event filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatpulse.functions.lines import (
    decoded,
    labelled_value,
    line_fields,
    line_of,
    message_text,
    whole_seconds,
)
from chatpulse.functions.once import with_once

MALFORMED = "malformed line"
REASONS = ("timestamp", "user", "message")


def channel_events(events: DataFrame, channel: str, event_type: str = "message") -> DataFrame:
    """Events of one type in one channel; a plain predicate, so it reaches the scan."""
    return events.where((F.col("type") == event_type) & (F.col("channel") == channel))


def format_lines(events: DataFrame) -> DataFrame:
    """Replace ``ts, user, text`` by the line ``value``; other columns stay."""
    line = line_of(F.col("ts"), F.col("user"), F.col("text"))
    return events.withColumn("value", line).drop("ts", "user", "text")


def _read_fields(lines: DataFrame, value: str) -> DataFrame:
    split_up = with_once(lines, _parts=line_fields(decoded(F.col(value))))
    texts = with_once(
        split_up,
        _seconds=labelled_value(F.get("_parts", F.lit(0))),
        user=labelled_value(F.get("_parts", F.lit(1))),
        message=message_text(F.get("_parts", F.lit(2))),
    )
    return with_once(texts, event_time=whole_seconds(F.col("_seconds"))).drop("_parts", "_seconds")


def _well_formed():
    return F.col("event_time").isNotNull() & F.col("user").isNotNull() & F.col("message").isNotNull()


def parse_lines(lines: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """``event_time, user, message`` of every well-formed line, next to the other columns.

    Malformed lines are left out (``quarantine_lines`` returns them); ``strict`` fails
    the job on the first one instead.
    """
    fields = _read_fields(lines, value)
    if strict:
        reason = F.concat(F.lit(MALFORMED + ": "), decoded(F.col(value)))
        checked = F.when(_well_formed(), F.col("event_time")).otherwise(
            F.raise_error(reason).cast("bigint")
        )
        return fields.withColumn("event_time", checked).drop(value)
    return fields.where(_well_formed()).drop(value)


def _reason():
    return (
        F.when(F.col("event_time").isNull(), "timestamp")
        .when(F.col("user").isNull(), "user")
        .when(F.col("message").isNull(), "message")
    )


def tagged_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Every line, parsed once: ``event_time, user, message`` and ``reason``, the first field that failed.

    ``reason`` is null for well-formed lines. ``good_lines`` and ``damaged_lines`` take the two kinds out of
    a stored table of these rows.
    """
    return _read_fields(lines, value).withColumn("reason", _reason())


def good_lines(tagged: DataFrame, value: str = "value") -> DataFrame:
    """What ``parse_lines`` gives, from stored ``tagged_lines``."""
    return tagged.where(F.col("reason").isNull()).drop(value, "reason")


def damaged_lines(tagged: DataFrame) -> DataFrame:
    """What ``quarantine_lines`` gives, from stored ``tagged_lines``."""
    return tagged.where(F.col("reason").isNotNull()).drop("event_time", "user", "message")


def line_counts() -> list[Column]:
    """Metrics to observe on ``tagged_lines``: all lines, and the damaged ones by their reason."""
    by_reason = [F.count_if(F.col("reason") == name).alias(name) for name in REASONS]
    return [F.count(F.lit(1)).alias("lines"), *by_reason]


def quarantine_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """The malformed lines, unchanged, with the first field that failed as ``reason``."""
    return (
        _read_fields(lines, value)
        .where(~_well_formed())
        .withColumn("reason", _reason())
        .drop("event_time", "user", "message")
    )
