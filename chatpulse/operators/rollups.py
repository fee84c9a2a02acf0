"""Window states that merge to any longer span, tumbling or sliding: class counts and the places of the picks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatpulse.config import WindowPlan
from chatpulse.functions.packed import packed_order
from chatpulse.functions.sentiment import (
    CLASS_NAMES,
    NEGATIVE_CEILING,
    POSITIVE_FLOOR,
    TOP_SCORE,
    Scorer,
    scores_only,
)
from chatpulse.operators.summary import SUMMARY_COLUMNS, with_label

SCORES = range(TOP_SCORE + 1)
#: Sentences of each score, lowest first.
CLASS_COUNTS = tuple(f"sentences_{score}" for score in SCORES)
STATE_COLUMNS = ("message_count", *CLASS_COUNTS, "positive_at", "most_positive", "negative_at", "most_negative")


def window_states(windowed: DataFrame, scorer: Scorer, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """One state per window of windowed (or ``keep_newest``) messages.

    ``message_count``, how many sentences have each score, and the first clearly positive and the first
    clearly negative message with its place in arrival order. All of it combines, and scores are
    whole numbers from 0 to 4, so counts by score hold sums, averages, extremes and exact
    quantiles of any span.
    """
    at = packed_order(windowed, plan.order)
    if at is None:
        raise ValueError(f"the order {plan.order} doesn't fit one number")
    scored = windowed.withColumn("_scores", scores_only(scorer, F.col("message"))).withColumn("_at", at)

    def sentences(score: int) -> Column:
        return F.size(F.filter("_scores", lambda s: s == score)).cast("bigint")

    counts = [F.sum(sentences(score)).alias(name) for score, name in zip(SCORES, CLASS_COUNTS)]
    positive = F.when(F.array_max("_scores") >= POSITIVE_FLOOR, F.col("_at"))
    negative = F.when(F.array_min("_scores") < NEGATIVE_CEILING, F.col("_at"))
    return scored.groupBy(*plan.group).agg(
        F.count(F.lit(1)).alias("message_count"),
        *counts,
        F.min(positive).alias("positive_at"),
        F.min_by("message", positive).alias("most_positive"),
        F.min(negative).alias("negative_at"),
        F.min_by("message", negative).alias("most_negative"),
    )


def merge_states(
    states: DataFrame, span: str, slide: str | None = None, plan: WindowPlan = WindowPlan()
) -> DataFrame:
    """States of ``span``s, each ``slide`` after the one before (next to each other without one).

    ``states`` are panes: a message has been counted in one of them, and only panes, one narrow row each,
    are copied to the spans they lie in. Merging merged states gives the same as merging the
    panes. A pane that reaches over the end of a span can't be split and raises.
    """
    window = F.window("win_start", span, slide or span, startTime=plan.offset)
    placed = states.withColumn("_span", window)
    uneven = F.raise_error(F.concat(F.lit(f"a window reaches over the end of its {span}: "), F.col("win_start").cast("string")))
    count = F.when(F.col("win_end") <= F.col("_span.end"), F.col("message_count")).otherwise(uneven.cast("bigint"))
    merged = placed.groupBy(*plan.keys, F.col("_span.start").alias("span_start"), F.col("_span.end").alias("span_end")).agg(
        F.sum(count).alias("message_count"),
        *[F.sum(name).alias(name) for name in CLASS_COUNTS],
        F.min("positive_at").alias("positive_at"),
        F.min_by("most_positive", "positive_at").alias("most_positive"),
        F.min("negative_at").alias("negative_at"),
        F.min_by("most_negative", "negative_at").alias("most_negative"),
    )
    return merged.withColumnsRenamed({"span_start": "win_start", "span_end": "win_end"}).select(*plan.group, *STATE_COLUMNS)


def _total(weight) -> Column:
    return reduce(lambda a, b: a + b, [F.col(name) * weight(score) for score, name in zip(SCORES, CLASS_COUNTS)])


def score_quantile(share: float) -> Column:
    """The least score that at least ``share`` of a state's sentences don't exceed; null without sentences. Exact."""
    if not 0 <= share <= 1:
        raise ValueError("a share lies between 0 and 1")
    everything, below, found = _total(lambda _: 1), F.lit(0), None
    for score, name in zip(SCORES, CLASS_COUNTS):
        below = below + F.col(name)
        reached = (below > 0) & (below >= everything * share)
        found = F.when(reached, score) if found is None else found.when(reached, score)
    return found.cast("int")


def state_summary(states: DataFrame, plan: WindowPlan = WindowPlan(), quantiles: dict[str, float] | None = None) -> DataFrame:
    """The columns of ``window_summary`` from states, and a column for each of ``quantiles`` (name -> share)."""
    seen = [F.when(F.col(name) > 0, score) for score, name in zip(SCORES, CLASS_COUNTS)]
    summed = states.withColumns(
        {
            "sentence_count": _total(lambda _: 1),
            "score_sum": _total(lambda score: score),
            "max_score": F.greatest(*seen),
            "min_score": F.least(*seen),
        }
        | {name: score_quantile(share) for name, share in (quantiles or {}).items()}
    )
    return with_label(summed).select(*plan.group, *SUMMARY_COLUMNS, *(quantiles or {}))


def state_histogram(states: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """Sentences per class and window, as ``class_histogram`` gives them: classes without sentences have no row."""
    pairs = [F.struct(F.lit(label).alias("class"), F.col(name).alias("sentences")) for label, name in zip(CLASS_NAMES, CLASS_COUNTS)]
    rows = states.select(*plan.group, F.inline(F.array(*pairs)))
    return rows.where(F.col("sentences") > 0)
