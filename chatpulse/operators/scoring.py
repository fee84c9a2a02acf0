"""Scoring messages sentence by sentence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatpulse.functions.sentiment import (
    Scorer,
    check_scorer,
    clamp_score,
    class_name,
    scores_only,
    sentences_of,
    tokens_of,
)


def score_messages(messages: DataFrame, scorer: Scorer | None) -> DataFrame:
    """Add ``sentences``, the scored sentences of ``message``."""
    return messages.withColumn("sentences", check_scorer(scorer)(F.col("message")))


def _with_stats(frame: DataFrame) -> DataFrame:
    return (
        frame.withColumn("sentence_count", F.size("_scores"))
        .withColumn("score_sum", F.aggregate("_scores", F.lit(0), lambda acc, v: acc + v))
        .withColumn("max_score", F.array_max("_scores"))
        .withColumn("min_score", F.array_min("_scores"))
        .drop("_scores")
    )


def message_stats(scored: DataFrame) -> DataFrame:
    """Replace ``sentences`` by what a window needs: count, sum, highest, lowest.

    A message without sentences has count and sum 0 and null extremes.
    """
    return _with_stats(scored.withColumn("_scores", F.col("sentences.score"))).drop("sentences")


def score_stats(messages: DataFrame, scorer: Scorer | None) -> DataFrame:
    """``message_stats`` of ``score_messages`` without building the scored sentences."""
    return _with_stats(messages.withColumn("_scores", scores_only(scorer, F.col("message"))))


def sentence_rows(scored: DataFrame) -> DataFrame:
    """One row per sentence: ``sentence`` (position from 0), ``score``, ``class``."""
    others = [c for c in scored.columns if c not in ("sentences", "message")]
    return scored.select(*others, F.posexplode("sentences").alias("sentence", "_s")).select(
        *others, "sentence", F.col("_s.score").alias("score"), F.col("_s.class").alias("class")
    )


def score_with_lexicon_table(messages: DataFrame, lexicon: DataFrame, key: str = "seq") -> DataFrame:
    """``message_stats`` columns per ``key`` for a lexicon (``token, weight``) kept in a table.

    Only the key and single tokens travel; the text is dropped first. Whether the lexicon
    is sent to all tasks or joined by shuffle is left to Spark's own size check, and sums
    are combined before each shuffle. ``key`` must be unique per message, ``token`` per lexicon.
    """
    sentences = messages.select(key, F.posexplode_outer(sentences_of(F.col("message"))).alias("_pos", "_text"))
    weights = lexicon.where(F.col("weight") != 0).select("token", "weight")
    tokens = sentences.select(
        key, "_pos", F.posexplode_outer(tokens_of(F.col("_text"))).alias("_at", "token")
    )
    # Words without a weight leave again before the sums; the first token stands for its
    # sentence, so that a sentence (or a message without one) is never lost.
    weighted = tokens.join(weights, "token", "left").where(
        F.col("weight").isNotNull() | F.coalesce("_at", F.lit(0)).eqNullSafe(0)
    )
    per_sentence = (
        weighted.groupBy(key, "_pos")
        .agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("_weight"))
        .withColumn("_score", F.when(F.col("_pos").isNotNull(), clamp_score(F.col("_weight"))))
    )
    return per_sentence.groupBy(key).agg(
        F.count("_score").cast("int").alias("sentence_count"),
        F.coalesce(F.sum("_score"), F.lit(0)).cast("int").alias("score_sum"),
        F.max("_score").alias("max_score"),
        F.min("_score").alias("min_score"),
    )


def class_histogram(scored: DataFrame, group: list[str]) -> DataFrame:
    """Sentences per class and group."""
    return (
        sentence_rows(scored)
        .groupBy(*group, "score")
        .agg(F.count(F.lit(1)).alias("sentences"))
        .withColumn("class", class_name(F.col("score")))
        .select(*group, "class", "sentences")
    )
