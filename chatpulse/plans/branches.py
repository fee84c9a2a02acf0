"""The two branches over one set of messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatpulse.config import EnrichSettings, WindowPlan
from chatpulse.functions.packed import id_filter, packed_order
from chatpulse.functions.sentiment import Scorer
from chatpulse.operators.enrichment import (
    ClientFactory,
    enrich,
    window_prompts,
    window_requests,
)
from chatpulse.operators.scoring import score_stats
from chatpulse.operators.summary import (
    NUMBERS,
    PLACES,
    SUMMARY_COLUMNS,
    pick_places,
    summary_aggregates,
    summary_numbers,
    window_summary,
    with_label,
)
from chatpulse.operators.windows import assign_windows, keep_newest
from chatpulse.session import small_batches, store_once


def kept_messages(messages: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """Messages both branches work on: windowed, newest ``plan.limit`` of each window."""
    return keep_newest(assign_windows(messages, plan), plan)


def summarise_kept(
    kept: DataFrame, scorer: Scorer, plan: WindowPlan = WindowPlan(), true_extremes: bool = False
) -> DataFrame:
    """Classifier branch. Only kept rows are scored: the limit comes first and costs no text work."""
    return window_summary(score_stats(kept, scorer), plan, true_extremes)


def sentiment_branch(messages: DataFrame, scorer: Scorer, plan: WindowPlan = WindowPlan()) -> DataFrame:
    return summarise_kept(kept_messages(messages, plan), scorer, plan)


def _window_of(plan: WindowPlan) -> Column:
    return F.window(F.col(plan.order[0]), plan.duration, startTime=plan.offset).alias("_span")


def _bounds() -> list[Column]:
    return [F.col("_span.start").alias("win_start"), F.col("_span.end").alias("win_end")]


def unlimited_numbers(messages: DataFrame, scorer: Scorer, plan: WindowPlan, at: Column) -> DataFrame:
    """What a window needs over ALL its messages, as numbers: sums, extremes and the places of both picks.

    Numbers of fixed width combine in a hash aggregation, so nothing is sorted and no text
    reaches the shuffle: a task sends one narrow row per window.
    """
    stats = score_stats(messages.withColumn("_at", at), scorer)
    grouped = stats.groupBy(_window_of(plan), *plan.keys).agg(*summary_numbers(), *pick_places())
    return grouped.select(*plan.keys, *_bounds(), *NUMBERS, *PLACES)


def with_pick_texts(numbers: DataFrame, messages: DataFrame, plan: WindowPlan, at: Column) -> DataFrame:
    """``most_positive`` and ``most_negative`` of each window, fetched by the places of its picks.

    At most two messages of a window are wanted. A filter of fixed size drops nearly all
    others where they are read, so that only picked texts move, whichever join is chosen.
    """
    places = F.explode(F.array(*PLACES)).alias("_at")
    picks = numbers.select(*plan.keys, places).where(F.col("_at").isNotNull()).distinct()
    wanted = id_filter(picks, "_at")
    texts = messages.select(*plan.keys, at.alias("_at"), F.col("message")).where(wanted(F.col("_at")))
    found = numbers
    for place, name in zip(PLACES, ("most_positive", "most_negative")):
        mine = texts.select(*[F.col(k).alias(f"_{k}") for k in plan.keys], F.col("_at").alias(f"{place}_of"), F.col("message").alias(name))
        same = F.col(place) == F.col(f"{place}_of")
        for key in plan.keys:
            same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
        found = found.join(mine, same, "left").drop(*[f"_{k}" for k in plan.keys], f"{place}_of")
    return found.drop(*PLACES)


def unlimited_summary(messages: DataFrame, scorer: Scorer, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """Summaries over ALL messages of a window of a table (streams: ``start_unlimited``).

    Late materialisation: the windows' numbers and the places of their picks first
    (``unlimited_numbers``, stored: they are read twice), the texts of the picks afterwards. The order
    columns must tell messages apart within the plan's keys. Orders too wide for one number take the texts
    along instead.
    """
    at = packed_order(messages, plan.order)
    if at is None:
        stats = score_stats(messages, scorer)
        grouped = stats.groupBy(_window_of(plan), *plan.keys).agg(*summary_aggregates(plan))
        return with_label(grouped).select(*plan.keys, *_bounds(), *SUMMARY_COLUMNS)
    numbers = store_once(unlimited_numbers(messages, scorer, plan, at), "window-numbers")
    return with_label(with_pick_texts(numbers, messages, plan, at)).select(*plan.group, *SUMMARY_COLUMNS)


def narrative_requests(kept: DataFrame, settings: EnrichSettings, plan: WindowPlan = WindowPlan()) -> DataFrame:
    return window_requests(window_prompts(kept, plan), settings.model, plan)


def narrative_branch(
    kept: DataFrame,
    client_factory: ClientFactory,
    settings: EnrichSettings,
    plan: WindowPlan = WindowPlan(),
    parallelism: int | None = None,
) -> DataFrame:
    """Replies of the narrative branch; write them to a table before reading them twice."""
    return enrich(narrative_requests(kept, settings, plan), client_factory, settings, plan, parallelism)


def stored_replies(
    requests: DataFrame,
    client_factory: ClientFactory,
    settings: EnrichSettings,
    plan: WindowPlan = WindowPlan(),
    parallelism: int | None = None,
) -> DataFrame:
    """Replies to the ``requests`` of a table, called for once and stored, some prompts at a time."""
    with small_batches(requests.sparkSession):
        return store_once(enrich(requests, client_factory, settings, plan, parallelism), "replies")
