"""Declared record types."""

from __future__ import annotations

from pyspark.sql import types as T

SENTENCE_SCORES = T.ArrayType(
    T.StructType([T.StructField("score", T.IntegerType()), T.StructField("class", T.StringType())])
)

#: One parsed chat message. ``event_time`` is the sender's clock in whole seconds and is
#: carried along only; windows run on ``arrival``, and ``seq`` breaks ties.
MESSAGE = T.StructType(
    [
        T.StructField("arrival", T.TimestampType()),
        T.StructField("seq", T.LongType()),
        T.StructField("event_time", T.LongType()),
        T.StructField("user", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

#: One event of the chat service's feed, before lines are made from it.
CHAT_EVENT = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("ts", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

#: Fields of both result kinds as they arrive in JSON text. Counts stay text here: the
#: narrative side is written by a model and may quote its numbers.
RESULT_FIELDS = T.StructType(
    [
        T.StructField("start", T.StringType()),
        T.StructField("end", T.StringType()),
        T.StructField("overallSentiment", T.StringType()),
        T.StructField("mostPositiveMessage", T.StringType()),
        T.StructField("mostNegativeMessage", T.StringType()),
        T.StructField("messageCount", T.StringType()),
        T.StructField("averageScore", T.StringType()),
        T.StructField("descriptiveParagraph", T.StringType()),
    ]
)

#: One result record as stored in the serving table or read from the result topics.
RESULT_FEED = T.StructType(
    [
        T.StructField("win_start", T.TimestampType()),
        T.StructField("win_end", T.TimestampType()),
        T.StructField("seq", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)
