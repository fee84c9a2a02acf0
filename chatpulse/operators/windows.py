"""Tumbling windows and the newest-rows limit inside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatpulse.config import WindowPlan


def assign_windows(messages: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """Add ``win_start`` and ``win_end`` of the epoch-aligned window an arrival falls in."""
    span = F.window(F.col(plan.order[0]), plan.duration, startTime=plan.offset)
    return (
        messages.withColumn("_span", span)
        .withColumn("win_start", F.col("_span.start"))
        .withColumn("win_end", F.col("_span.end"))
        .drop("_span")
    )


def order_key(plan: WindowPlan) -> Column:
    return F.struct(*[F.col(name) for name in plan.order])


def tumbling_count(messages: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """Messages per window, before any limit. Counts are combined before the shuffle."""
    return (
        assign_windows(messages, plan)
        .groupBy(*plan.group)
        .agg(F.count(F.lit(1)).alias("message_count"))
    )


def keep_newest(windowed: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """The newest ``plan.limit`` rows of each window.

    Ranked twice. The first ranking splits every window by input split, so Spark's group
    limit leaves at most ``limit`` rows per window and input task before the shuffle, and a
    window holding most of the table is spread over ``shards`` tasks. The second ranking
    sees at most ``limit * shards`` rows of a window. The newest rows of a whole are among
    the newest rows of its parts, so the split never changes the result. (Spark applies the
    group limit up to ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000; beyond it the
    result is the same, but whole windows travel to their shards.)
    """
    newest_first = [F.col(name).desc() for name in plan.order]
    thinned = windowed
    if plan.shards > 1:
        per_shard = Window.partitionBy(*plan.group, "_shard").orderBy(*newest_first)
        thinned = (
            windowed.withColumn("_shard", F.spark_partition_id() % F.lit(plan.shards))
            .withColumn("_rank", F.row_number().over(per_shard))
            .where(F.col("_rank") <= plan.limit)
            .drop("_rank", "_shard")
        )
    per_window = Window.partitionBy(*plan.group).orderBy(*newest_first)
    return (
        thinned.withColumn("_rank", F.row_number().over(per_window))
        .where(F.col("_rank") <= plan.limit)
        .drop("_rank")
    )
