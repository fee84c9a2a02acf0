"""Both results of a window side by side."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatpulse.config import WindowPlan
from chatpulse.functions.clock import london_instant, window_key
from chatpulse.functions.once import with_once
from chatpulse.operators.results import NO_MESSAGE
from chatpulse.schemas import RESULT_FIELDS

CLASSIFIER = "classifier"
NARRATIVE = "narrative"


def union_feeds(*feeds: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def read_results(feed: DataFrame) -> DataFrame:
    """Parse ``value`` and name each result's ``kind`` by the field only that kind has.

    A field counts as present even when it is null. Text that is no JSON object, and
    objects with neither field, are left out. A feed without ``win_start`` and ``win_end``, such
    as rows of the result topics, gets them from the printed bounds; ``unplaced_results``
    returns those whose bounds can't be read.
    """
    bounds = {} if "win_start" in feed.columns else {
        "win_start": london_instant(F.col("_r.start")), "win_end": london_instant(F.col("_r.end"))
    }
    names = F.json_object_keys("value")
    kind = F.when(F.array_contains(names, "averageScore"), CLASSIFIER).when(
        F.array_contains(names, "descriptiveParagraph"), NARRATIVE
    )
    return (
        with_once(feed, kind=kind, _r=F.from_json("value", RESULT_FIELDS))
        .where(F.col("kind").isNotNull())
        .withColumns(bounds)
        .withColumn("window_key", window_key(F.col("_r.start"), F.col("_r.end")))
        .withColumn("overall_sentiment", F.col("_r.overallSentiment"))
        .withColumn("most_positive", F.col("_r.mostPositiveMessage"))
        .withColumn("most_negative", F.col("_r.mostNegativeMessage"))
        .withColumn("message_count", F.col("_r.messageCount").try_cast("bigint"))
        .withColumn("average_score", F.col("_r.averageScore").try_cast("double"))
        .withColumn("descriptive_paragraph", F.col("_r.descriptiveParagraph"))
        .drop("_r", "value")
    )


RESULT_COLUMNS = (
    "window_key",
    "overall_sentiment",
    "most_positive",
    "most_negative",
    "message_count",
    "average_score",
    "descriptive_paragraph",
)


#: One column, or several that order results together.
Order = str | Sequence[str]
PLACED = "win_start IS NOT NULL AND win_end IS NOT NULL"


def order_of(seq: Order) -> Column:
    return F.struct(*([seq] if isinstance(seq, str) else seq))


def unplaced_results(results: DataFrame) -> DataFrame:
    """Results that belong to no window, as a bound is missing; the functions below leave them out."""
    return results.where(f"NOT ({PLACED})")


def latest_per_window(results: DataFrame, plan: WindowPlan = WindowPlan(), seq: Order = "seq") -> DataFrame:
    """The last result of each window and kind; ``seq`` (several columns for rows of Kafka topics) must be
    unique within them, or null for at most one: a result without an order counts as the
    oldest and is never lost."""
    newest = F.max_by(F.struct(*RESULT_COLUMNS), order_of(seq)).alias("_newest")
    latest = results.where(PLACED).groupBy(*plan.group, "kind").agg(newest, F.max(order_of(seq)).alias("_order"))
    return latest.select(*plan.group, "kind", "_order.*", "_newest.*")


def _sides(results: DataFrame, group: list[str], seq: Order) -> DataFrame:
    """Both kinds of a window in one row, from one shuffle and no join."""

    def side(kind: str) -> Column:
        return F.max_by(F.struct(*RESULT_COLUMNS), F.when(F.col("kind") == kind, order_of(seq))).alias(kind)

    return results.where(PLACED).groupBy(*group).agg(side(CLASSIFIER), side(NARRATIVE))


def shown(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(NO_MESSAGE))


def comparison_columns(classifier: str = CLASSIFIER, narrative: str = NARRATIVE) -> list[Column]:
    """Display columns of a compared window, from two struct columns."""
    c, n = F.col(classifier), F.col(narrative)
    return [
        c["window_key"].alias("window_key"),
        c["overall_sentiment"].alias("classifier_sentiment"),
        c["most_positive"].alias("classifier_positive"),
        shown(c["most_negative"]).alias("classifier_negative"),
        c["message_count"].alias("classifier_count"),
        c["average_score"].alias("average_score"),
        n["overall_sentiment"].alias("narrative_sentiment"),
        n["most_positive"].alias("narrative_positive"),
        shown(n["most_negative"]).alias("narrative_negative"),
        n["message_count"].alias("narrative_count"),
        F.nullif(n["descriptive_paragraph"], F.lit("")).alias("descriptive_paragraph"),
    ]


def compare_windows(results: DataFrame, plan: WindowPlan = WindowPlan(), seq: Order = "seq") -> DataFrame:
    """Windows that have both results, each side's latest one."""
    pairs = _sides(results, plan.group, seq).where(
        F.col(CLASSIFIER).isNotNull() & F.col(NARRATIVE).isNotNull()
    )
    return pairs.select(*plan.group, *comparison_columns())


def unmatched_windows(results: DataFrame, plan: WindowPlan = WindowPlan(), seq: Order = "seq") -> DataFrame:
    """Windows still waiting for one side, with the ``missing`` kind."""
    missing = F.when(F.col(CLASSIFIER).isNull(), CLASSIFIER).otherwise(NARRATIVE)
    return (
        _sides(results, plan.group, seq)
        .where(F.col(CLASSIFIER).isNull() | F.col(NARRATIVE).isNull())
        .select(*plan.group, missing.alias("missing"))
    )
