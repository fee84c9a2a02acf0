"""One row per window: counts, average, label and picked messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatpulse.config import WindowPlan
from chatpulse.functions.sentiment import NEGATIVE_CEILING, POSITIVE_FLOOR, label_of
from chatpulse.operators.windows import order_key


#: Columns of a summary after the group columns.
SUMMARY_COLUMNS = (
    "message_count",
    "sentence_count",
    "score_sum",
    "max_score",
    "min_score",
    "most_positive",
    "most_negative",
    "average_score",
    "overall_sentiment",
)


#: The numbers of a summary, and the places of its two picks in arrival order.
NUMBERS = SUMMARY_COLUMNS[:5]
PLACES = ("_positive_at", "_negative_at")


def _average() -> Column:
    return F.when(
        F.col("sentence_count") > 0, F.col("score_sum") / F.col("sentence_count")
    ).otherwise(F.lit(0.0))


def with_label(summaries: DataFrame) -> DataFrame:
    """Add ``average_score`` (two decimals) and ``overall_sentiment`` (of the exact average)."""
    return (
        summaries.withColumn("_average", _average())
        .withColumn("average_score", F.round("_average", 2))
        .withColumn("overall_sentiment", label_of(F.col("_average")))
        .drop("_average")
    )


def summary_numbers() -> list[Column]:
    """``NUMBERS`` from rows of ``message_stats``."""
    return [
        F.count(F.lit(1)).alias("message_count"),
        F.sum("sentence_count").alias("sentence_count"),
        F.sum("score_sum").alias("score_sum"),
        F.max("max_score").alias("max_score"),
        F.min("min_score").alias("min_score"),
    ]


def pick_places(at: str = "_at") -> list[Column]:
    """``PLACES``: where the first clearly positive and the first clearly negative message stand."""
    positive = F.when(F.col("max_score") >= POSITIVE_FLOOR, F.col(at))
    negative = F.when(F.col("min_score") < NEGATIVE_CEILING, F.col(at))
    return [F.min(pick).alias(name) for pick, name in zip((positive, negative), PLACES)]


def summary_aggregates(plan: WindowPlan = WindowPlan(), true_extremes: bool = False) -> list[Column]:
    """What a window needs from rows of ``message_stats``.

    The picks are the FIRST clearly positive and the FIRST clearly negative message in
    arrival order. ``true_extremes`` picks the highest and lowest scoring ones instead,
    the earliest on ties.
    """
    arrival = order_key(plan)
    positive_rank = negative_rank = arrival
    if true_extremes:
        positive_rank = F.struct((-F.col("max_score")).alias("score"), arrival.alias("at"))
        negative_rank = F.struct(F.col("min_score").alias("score"), arrival.alias("at"))
    positive = F.when(F.col("max_score") >= POSITIVE_FLOOR, positive_rank)
    negative = F.when(F.col("min_score") < NEGATIVE_CEILING, negative_rank)
    return [
        *summary_numbers(),
        F.min_by("message", positive).alias("most_positive"),
        F.min_by("message", negative).alias("most_negative"),
    ]


def window_summary(
    stats: DataFrame, plan: WindowPlan = WindowPlan(), true_extremes: bool = False
) -> DataFrame:
    """Summarise rows of ``message_stats`` per window.

    Counts, sums and picks all combine, so nothing of a window is buffered, and rows that
    ``keep_newest`` already placed are not moved again.
    """
    return with_label(stats.groupBy(*plan.group).agg(*summary_aggregates(plan, true_extremes)))


def _earliest(pick: str) -> Column:
    return F.min_by(pick, F.when(F.col(pick).isNotNull(), F.col("win_start"))).alias(pick)


def rollup_windows(summaries: DataFrame, duration: str, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """Merge summaries of short windows into longer ones: counts and sums add up, the
    earliest window that has a pick provides it.

    A window that doesn't lie within one of the longer ones can't be split and raises.
    """
    span = F.window("win_start", duration, startTime=plan.offset)
    uneven = F.raise_error(F.concat(F.lit(f"a window reaches over the end of its {duration}: "), F.col("win_start").cast("string")))
    count = F.when(F.col("win_end") <= F.col("_span.end"), F.col("message_count")).otherwise(uneven.cast("bigint"))
    merged = (
        summaries.withColumn("_span", span)
        .groupBy(*plan.keys, F.col("_span.start").alias("long_start"), F.col("_span.end").alias("long_end"))
        .agg(
            F.sum(count).alias("message_count"),
            F.sum("sentence_count").alias("sentence_count"),
            F.sum("score_sum").alias("score_sum"),
            F.max("max_score").alias("max_score"),
            F.min("min_score").alias("min_score"),
            _earliest("most_positive"),
            _earliest("most_negative"),
        )
        .withColumnsRenamed({"long_start": "win_start", "long_end": "win_end"})
    )
    return with_label(merged)
