"""Window results as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatpulse.config import WindowPlan
from chatpulse.functions.clock import london_text

# Fixed value: printed where a window has no such message.
NO_MESSAGE = "N/A"


def result_json(summaries: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """``value``: the classifier result of each window, fields in their published order."""
    body = F.struct(
        london_text("win_start").alias("start"),
        london_text("win_end").alias("end"),
        F.col("overall_sentiment").alias("overallSentiment"),
        F.coalesce("most_positive", F.lit(NO_MESSAGE)).alias("mostPositiveMessage"),
        F.coalesce("most_negative", F.lit(NO_MESSAGE)).alias("mostNegativeMessage"),
        F.col("message_count").alias("messageCount"),
        F.col("average_score").alias("averageScore"),
    )
    return summaries.select(*plan.group, F.to_json(body).alias("value"))
