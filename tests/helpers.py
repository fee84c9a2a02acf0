from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from chatpulse.schemas import SENTENCE_SCORES

BASE = dt.datetime(2024, 1, 1)
NAMES = ["Very negative", "Negative", "Neutral", "Positive", "Very positive"]


def at(seconds: float) -> dt.datetime:
    return BASE + dt.timedelta(seconds=seconds)


def messages(spark: SparkSession, rows: list[tuple[float, str | None]]) -> DataFrame:
    """``(second, text)`` pairs as messages; the list position is ``seq``."""
    data = [(at(second), i, f"U{i}", text) for i, (second, text) in enumerate(rows)]
    return spark.createDataFrame(data, "arrival timestamp, seq long, user string, message string")


def scored(spark: SparkSession, rows: list[tuple[float, str, list[int]]]) -> DataFrame:
    """``(second, text, sentence scores)`` as scored messages."""
    data = [
        (at(second), i, text, [(s, NAMES[s]) for s in scores])
        for i, (second, text, scores) in enumerate(rows)
    ]
    schema = "arrival timestamp, seq long, message string, sentences " + SENTENCE_SCORES.simpleString()
    return spark.createDataFrame(data, schema)


def plan_text(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
