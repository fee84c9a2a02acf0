"""Which windows are so full that their rows should be dealt to several tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatpulse.config import WindowPlan

#: Windows a task keeps count of, and the most that can come out.
COUNTERS = 512


def trimmed(counts: pd.Series, most: int) -> pd.Series:
    """The ``most`` largest counts, lowered by the next one: what is left is never above the truth.

    A window that held more than one in ``most + 1`` of the rows counted so far is always left.
    """
    if len(counts) <= most:
        return counts
    counts = counts.sort_values(ascending=False, kind="stable")
    return (counts.iloc[:most] - counts.iloc[most]).loc[lambda c: c > 0]


def heavy_windows(
    windowed: DataFrame, plan: WindowPlan = WindowPlan(), rows_per_shard: int = 1_000_000, counters: int = COUNTERS
) -> DataFrame:
    """(group columns, ``shards``) of windows with ``rows_per_shard`` rows or more, at most ``counters`` of them.

    Every task counts in a summary of bounded size (heavy hitters after Misra and Gries), reads nothing
    but the group columns, and sends one row for each counter it has left. Counts are
    lower bounds, off by at most one in ``counters`` of the rows, so a window with more than that share
    is never missed. A wrong count only ever costs balance, never rows.
    """
    group = plan.group

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.Series(dtype="int64")
        for batch in batches:
            found = batch.groupby(group, dropna=False, sort=False).size()
            held = trimmed(held.add(found, fill_value=0).astype("int64") if len(held) else found, counters)
        if len(held):
            yield held.rename("n").reset_index()[[*group, "n"]]

    schema = T.StructType([windowed.schema[name] for name in group] + [T.StructField("n", T.LongType())])
    counted = windowed.select(*group).mapInPandas(count, schema).groupBy(*group).agg(F.sum("n").alias("n"))
    heavy = counted.where(F.col("n") >= rows_per_shard).orderBy(F.desc("n"), *group).limit(counters)
    return heavy.select(*group, F.ceil(F.col("n") / rows_per_shard).cast("int").alias("shards"))


def keep_newest_by_load(windowed: DataFrame, heavy: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """``keep_newest`` that deals only the ``heavy`` windows (``heavy_windows``) to several tasks.

    All other windows go to their task at once, so that their rows are shuffled once; the table is read once for each of the two kinds. ``heavy`` holds at most ``COUNTERS`` rows, so it is sent to all tasks;
    without any the plan is one ranking, whatever ``plan.shards`` says. The result never depends on it.
    """
    group = plan.group
    newest_first = [F.col(name).desc() for name in plan.order]

    def newest(rows: DataFrame, *split: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*group, *split).orderBy(*newest_first))
        return rows.withColumn("_rank", rank).where(F.col("_rank") <= plan.limit).drop("_rank")

    loads = heavy.collect()
    if not loads:
        return newest(windowed)
    named = [F.col(name).alias(f"_{name}") for name in group]
    sent = F.broadcast(windowed.sparkSession.createDataFrame(loads, heavy.schema).select(*named, F.col("shards").alias("_shards")))
    same: Column = F.lit(True)
    for name in group:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    marked = windowed.join(sent, same, "left").drop(*[f"_{name}" for name in group])
    shard = F.when(F.col("_shards").isNotNull(), F.spark_partition_id() % F.col("_shards"))
    dealt = newest(marked.where(F.col("_shards").isNotNull()).withColumn("_shard", shard), "_shard")
    light = marked.where(F.col("_shards").isNull())
    return newest(light.drop("_shards").unionByName(dealt.drop("_shards", "_shard")))
