"""Run the streaming jobs over stored tables until everything there is processed."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatpulse.config import EnrichSettings, WindowPlan
from chatpulse.functions.sentiment import Scorer
from chatpulse.operators.comparison import read_results
from chatpulse.operators.enrichment import ClientFactory
from chatpulse.session import fresh_folder, is_written, store_once
from chatpulse.sources.files import child_names
from chatpulse.sources.readers import line_table, result_table, stamped
from chatpulse.sources.serving import ServingTable
from chatpulse.sources.tables import document_messages
from chatpulse.sources.writers import table_sink
from chatpulse.streaming.jobs import (
    NarrativeStep,
    newest_pairs,
    start_comparison,
    start_live,
    start_model,
    start_served,
    start_unlimited,
    start_windows,
)
from chatpulse.streaming.merge import last_changes
from chatpulse.streaming.model import REPLY
from chatpulse.streaming.newest import PROCESSING_TIME


def _partitions(spark: SparkSession) -> int:
    """State partitions of a replay: as many as run at once, never more than a shuffle has."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(shuffle, spark.sparkContext.defaultParallelism))


def _document_stream(spark: SparkSession, path: str, plan: WindowPlan, folder: str) -> DataFrame:
    """The table's messages and, as nothing comes after them, a marker that ends their last window.

    The marker arrives two windows later and carries no message; its own window stays open.
    """
    # As a pattern, the path may name one file as well as a folder of files.
    pattern = f"{path[:-1]}[{path[-1]}]"
    stored = spark.read.parquet(path)
    messages = document_messages(line_table(spark, pattern, stored.schema, streaming=True))
    first = plan.order[0]
    later = F.expr(f"max({first}) + INTERVAL '{plan.duration}' + INTERVAL '{plan.duration}'").alias(first)
    marker = document_messages(stored).agg(later).where(F.col(first).isNotNull())
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in messages.schema.fields if f.name != first]
    marker.select(first, *empty).select(*messages.columns).write.parquet(f"{folder}/end")
    return messages.unionByName(spark.readStream.schema(messages.schema).parquet(f"{folder}/end"))


def replay_summary(
    spark: SparkSession, path: str, scorer: Scorer, plan: WindowPlan = WindowPlan()
) -> DataFrame:
    """Summaries of all windows of a documents table, through the stateful stream."""
    folder = fresh_folder(spark, "replay-summary")
    out = f"{folder}/summaries"
    messages = _document_stream(spark, path, plan, folder)
    query = start_windows(
        messages, scorer, folder, plan, summaries=table_sink(out), trigger=None, partitions=_partitions(spark)
    )
    query.awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


def replay_published(
    spark: SparkSession,
    path: str,
    scorer: Scorer,
    client_factory: ClientFactory,
    settings: EnrichSettings,
    plan: WindowPlan = WindowPlan(),
) -> DataFrame:
    """Everything both branches publish for a documents table, as stored by the stream."""
    folder = fresh_folder(spark, "replay-published")
    sink = table_sink(f"{folder}/results")
    narratives = table_sink(f"{folder}/narratives")
    messages = _document_stream(spark, path, plan, folder)
    query = start_windows(
        messages, scorer, folder, plan, results=sink, narrative=NarrativeStep(client_factory, settings, narratives),
        trigger=None, partitions=_partitions(spark),
    )
    query.awaitTermination()
    return result_table(spark, f"{folder}/results").unionByName(result_table(spark, f"{folder}/narratives"))


def replay_unlimited(
    spark: SparkSession, path: str, scorer: Scorer, plan: WindowPlan = WindowPlan()
) -> DataFrame:
    folder = fresh_folder(spark, "replay-unlimited")
    out = f"{folder}/summaries"
    messages = _document_stream(spark, path, plan, folder)
    query = start_unlimited(
        messages, scorer, folder, table_sink(out), plan, trigger=None, partitions=_partitions(spark)
    )
    query.awaitTermination()
    return spark.read.parquet(out).drop("batch_id")


def replay_comparison(feed: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """Store a result feed, join both kinds as streams, and return the newest pairs."""
    spark = feed.sparkSession
    folder = fresh_folder(spark, "replay-comparison")
    feed.select("win_start", "win_end", feed["seq"].cast("bigint").alias("seq"), "value").write.parquet(
        f"{folder}/feed"
    )
    sides = [result_table(spark, f"{folder}/feed", streaming=True) for _ in range(2)]
    query = start_comparison(
        *sides, folder, table_sink(f"{folder}/pairs"), plan, trigger=None, partitions=_partitions(spark)
    )
    query.awaitTermination()
    return newest_pairs(spark.read.parquet(f"{folder}/pairs"), plan)


def _store_in_turns(feed: DataFrame, path: str, turns: int) -> None:
    """A result feed as files that come one after the other, without any order among windows or kinds."""
    turn = F.pmod(F.xxhash64("win_start", "seq", "value"), F.lit(turns))
    rows = feed.select("win_start", "win_end", F.col("seq").cast("bigint").alias("seq"), "value", turn.alias("_turn"))
    stored = store_once(rows, "turns")
    for i in range(turns):
        stored.where(F.col("_turn") == i).drop("_turn").coalesce(1).write.mode("append").parquet(path)


def replay_served(feed: DataFrame, plan: WindowPlan = WindowPlan(), turns: int = 5) -> DataFrame:
    """A result feed through a serving table, a micro-batch a file, with compactions in between."""
    spark = feed.sparkSession
    folder = fresh_folder(spark, "replay-served")
    _store_in_turns(feed, f"{folder}/feed", turns)
    results = read_results(result_table(spark, f"{folder}/feed", streaming=True, files=1))
    table = ServingTable(spark, f"{folder}/served", results.schema, [*plan.group, "kind"], compact_after=3, keep=2)
    start_served(results, folder, table, trigger=None).awaitTermination()
    return table.read()


def replay_live(feed: DataFrame, plan: WindowPlan = WindowPlan(), turns: int = 3) -> DataFrame:
    """A result feed through the live comparison: what holds of each window at the end."""
    spark = feed.sparkSession
    folder = fresh_folder(spark, "replay-live")
    _store_in_turns(feed, f"{folder}/feed", turns)
    # Results come in any order here, so windows stay open until a result far behind all others ends them.
    latest = spark.read.parquet(f"{folder}/feed").agg(F.max("win_start").alias("last"))
    far = [(F.col("last") + F.expr(f"INTERVAL {days} DAYS")).alias(name) for name, days in (("win_start", 3000), ("win_end", 3001))]
    end = latest.where("last IS NOT NULL").select(*far, F.lit(0).cast("bigint").alias("seq"), F.lit('{"averageScore":0}').alias("value"))
    end.coalesce(1).write.mode("append").parquet(f"{folder}/feed")
    results = read_results(result_table(spark, f"{folder}/feed", streaming=True, files=1))
    query = start_live(
        results, folder, table_sink(f"{folder}/changes"), plan, delay="2000 days", trigger=None, partitions=_partitions(spark)
    )
    query.awaitTermination()
    return last_changes(spark.read.parquet(f"{folder}/changes"), plan)


def replay_model(
    requests: DataFrame,
    client_factory: ClientFactory,
    settings: EnrichSettings,
    plan: WindowPlan = WindowPlan(),
    limit_s: float = 600,
) -> DataFrame:
    """Stored requests through the model stream, until every window has a reply or a reason."""
    spark = requests.sparkSession
    folder = fresh_folder(spark, "replay-model")
    requests.write.parquet(f"{folder}/requests")
    stored = spark.read.parquet(f"{folder}/requests")
    due = stored.select(*plan.group).distinct().count()
    stream = spark.readStream.schema(stored.schema).parquet(f"{folder}/requests")
    query = start_model(
        stream, client_factory, settings, folder, table_sink(f"{folder}/contents"), plan=plan,
        trigger="0 seconds", partitions=_partitions(spark),
    )
    try:
        until = time.monotonic() + limit_s
        while due and settled_windows(spark, folder) < due:
            if query.exception() or not query.isActive or time.monotonic() > until:
                raise RuntimeError(f"the model stream ended early: {query.exception() or 'time is over'}")
            time.sleep(0.3)
    finally:
        query.stop()
    return spark.read.schema(_reply_schema(stored, plan)).parquet(f"{folder}/replies") if due else spark.createDataFrame([], _reply_schema(stored, plan))


def _reply_schema(requests: DataFrame, plan: WindowPlan) -> T.StructType:
    return T.StructType([requests.schema[name] for name in plan.group] + REPLY)


def settled_windows(spark: SparkSession, work_dir: str) -> int:
    """Rows in the finished micro-batches of a model stream's replies."""
    names = child_names(spark, f"{work_dir}/replies")
    done = [f"{work_dir}/replies/{name}" for name in names if is_written(spark, f"{work_dir}/replies/{name}")]
    return spark.read.parquet(*done).count() if done else 0


def replay_clock(
    spark: SparkSession,
    path: str,
    scorer: Scorer,
    duration: str = "10 seconds",
    limit_s: float = 600,
) -> DataFrame:
    """Summaries of a documents table whose rows arrive now: windows by the clock, which end an idle stream's too.

    All messages count, so that sums over all windows don't depend on when rows were read.
    """
    folder = fresh_folder(spark, "replay-clock")
    stored = spark.read.parquet(path)
    pattern = f"{path[:-1]}[{path[-1]}]"
    lines = document_messages(line_table(spark, pattern, stored.schema, streaming=True)).drop("arrival")
    due = stored.count()
    query = start_unlimited(
        stamped(lines), scorer, folder, table_sink(f"{folder}/summaries"), WindowPlan(duration=duration),
        trigger="0 seconds", partitions=_partitions(spark), mode=PROCESSING_TIME,
    )
    try:
        until = time.monotonic() + limit_s
        while due and _summarised(spark, f"{folder}/summaries") < due:
            if query.exception() or not query.isActive or time.monotonic() > until:
                raise RuntimeError(f"the stream ended early: {query.exception() or 'time is over'}")
            time.sleep(0.3)
    finally:
        query.stop()
    return spark.read.parquet(f"{folder}/summaries").drop("batch_id")


def _summarised(spark: SparkSession, path: str) -> int:
    done = [f"{path}/{name}" for name in child_names(spark, path) if is_written(spark, f"{path}/{name}")]
    return spark.read.parquet(*done).agg(F.sum("message_count")).first()[0] or 0 if done else 0
