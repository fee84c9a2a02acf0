"""Live jobs: window summaries, the narrative branch, and the comparison of both."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chatpulse.config import EnrichSettings, WindowPlan
from chatpulse.functions.sentiment import Scorer, check_scorer
from chatpulse.operators.comparison import (
    CLASSIFIER,
    NARRATIVE,
    RESULT_COLUMNS,
    Order,
    comparison_columns,
    order_of,
    read_results,
)
from chatpulse.operators.enrichment import ClientFactory, answered, extract_content, failed, unusable_replies
from chatpulse.operators.results import result_json
from chatpulse.operators.windows import keep_newest
from chatpulse.plans.branches import narrative_branch, narrative_requests, summarise_kept
from chatpulse.session import is_written, stream_settings
from chatpulse.sources.files import expire_batches
from chatpulse.sources.serving import ServingTable
from chatpulse.sources.writers import BatchSink, table_sink
from chatpulse.streaming.merge import merged_sides
from chatpulse.streaming.model import model_replies
from chatpulse.streaming.newest import EVENT_TIME, PROCESSING_TIME, closed_windows
from chatpulse.streaming.totals import all_message_windows


MODES = (EVENT_TIME, PROCESSING_TIME)


@dataclass(frozen=True)
class NarrativeStep:
    """How closed windows are sent to the model. ``failures`` gets the windows without a usable reply."""

    client_factory: ClientFactory
    settings: EnrichSettings
    sink: BatchSink
    failures: BatchSink | None = None
    parallelism: int | None = None


@dataclass(frozen=True)
class HandOff:
    """Requests of closed windows, stored for a model stream (``start_model``) that reads them at its own pace."""

    settings: EnrichSettings
    sink: BatchSink


def start_batches(
    frame: DataFrame,
    handler: Callable[[DataFrame, int], None],
    name: str,
    work_dir: str,
    trigger: str | None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Start a stream whose micro-batches go to ``handler``; its checkpoint lies in ``work_dir``."""
    writer = (
        frame.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", f"{work_dir}/checkpoint")
        .foreachBatch(handler)
    )
    with stream_settings(frame.sparkSession, partitions):
        if trigger:
            return writer.trigger(processingTime=trigger).start()
        return writer.trigger(availableNow=True).start()


def window_handler(
    scorer: Scorer,
    plan: WindowPlan,
    work_dir: str,
    results: BatchSink | None = None,
    summaries: BatchSink | None = None,
    narrative: NarrativeStep | None = None,
    hand_off: HandOff | None = None,
    keep_batches: int = 100,
) -> Callable[[DataFrame, int], None]:
    """Both branches over the windows a micro-batch has closed.

    The closed rows are written down first and both branches read that table: they see the
    same messages, and losing an executor repeats neither the stateful step nor a branch
    that is done. Replies of the model are written down before use for the same reason: a
    micro-batch that runs again takes those it has and calls the model only if it has none.
    Results carry their micro-batch as ``seq``. ``narrative`` calls the model here; ``hand_off`` only
    stores what is to be sent, one row a window, so that no call holds up the classifier.

    A micro-batch starts once all before it are committed, and only a micro-batch that runs again reads
    its own folders; so those more than ``keep_batches`` back are deleted.
    """
    scorer = check_scorer(scorer)
    settled = plan.with_(shards=1)

    def handle(closed: DataFrame, batch_id: int) -> None:
        spark = closed.sparkSession
        for own in ("closed", "replies"):
            expire_batches(spark, f"{work_dir}/{own}", batch_id - keep_batches)
        closed = closed.persist()
        try:
            if closed.isEmpty():
                return
            table_sink(f"{work_dir}/closed")(closed, batch_id)
        finally:
            closed.unpersist()
        stored = spark.read.schema(closed.schema).parquet(f"{work_dir}/closed/batch_id={batch_id}")
        kept = keep_newest(stored, settled)
        seq = F.lit(batch_id).cast("bigint")
        if results or summaries:
            summary = summarise_kept(kept, scorer, plan)
            if summaries:
                summaries(summary, batch_id)
            if results:
                results(result_json(summary, plan).withColumn("seq", seq), batch_id)
        if hand_off:
            hand_off.sink(narrative_requests(kept, hand_off.settings, plan), batch_id)
        if narrative:
            called = narrative_branch(
                kept, narrative.client_factory, narrative.settings, plan, narrative.parallelism
            )
            path = f"{work_dir}/replies/batch_id={batch_id}"
            if not is_written(spark, path):
                table_sink(f"{work_dir}/replies")(called, batch_id)
            replies = spark.read.schema(called.schema).parquet(path)
            narrative.sink(extract_content(answered(replies)).withColumn("seq", seq), batch_id)
            if narrative.failures:
                unusable = unusable_replies(answered(replies)).withColumn("error", F.lit("unusable reply"))
                lost = failed(replies).unionByName(unusable.drop("response"))
                narrative.failures(lost, batch_id)

    return handle


def start_windows(
    messages: DataFrame,
    scorer: Scorer,
    work_dir: str,
    plan: WindowPlan = WindowPlan(),
    results: BatchSink | None = None,
    summaries: BatchSink | None = None,
    narrative: NarrativeStep | None = None,
    hand_off: HandOff | None = None,
    mode: str = EVENT_TIME,
    delay: str = "0 seconds",
    trigger: str | None = "10 seconds",
    name: str = "chat-windows",
    partitions: int | None = None,
) -> StreamingQuery:
    """Summarise the newest rows of each window of ``messages`` as the windows close.

    ``work_dir`` is a shared folder of this job: its checkpoint and intermediate tables.
    ``trigger=None`` processes what is there and stops. ``partitions`` is the number of
    state partitions, fixed with the first start.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    handler = window_handler(scorer, plan, work_dir, results, summaries, narrative, hand_off)
    closed = closed_windows(messages, plan, mode, delay)
    return start_batches(closed, handler, name, work_dir, trigger, partitions)


def start_unlimited(
    messages: DataFrame,
    scorer: Scorer,
    work_dir: str,
    sink: BatchSink,
    plan: WindowPlan = WindowPlan(),
    delay: str = "0 seconds",
    trigger: str | None = "10 seconds",
    name: str = "chat-all-messages",
    partitions: int | None = None,
    mode: str = EVENT_TIME,
) -> StreamingQuery:
    """Summarise ALL messages of each window; its numbers and two texts are the whole state."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    summary = all_message_windows(messages, check_scorer(scorer), plan, mode, delay)
    return start_batches(summary, sink, name, work_dir, trigger, partitions)


def model_handler(
    work_dir: str, sink: BatchSink, failures: BatchSink | None = None, keep_batches: int | None = None
) -> Callable[[DataFrame, int], None]:
    """Publish replies: contents to ``sink``, windows without a usable one and the reason to ``failures``.

    Replies are written down before they are used, so each is taken from the state once. Their folders are
    deleted when they are more than ``keep_batches`` back, if that is given.
    """

    def handle(replies: DataFrame, batch_id: int) -> None:
        if keep_batches is not None:
            expire_batches(replies.sparkSession, f"{work_dir}/replies", batch_id - keep_batches)
        replies = replies.persist()
        try:
            if replies.isEmpty():
                return
            table_sink(f"{work_dir}/replies")(replies, batch_id)
        finally:
            replies.unpersist()
        stored = replies.sparkSession.read.schema(replies.schema).parquet(f"{work_dir}/replies/batch_id={batch_id}")
        seq = F.lit(batch_id).cast("bigint")
        sink(extract_content(answered(stored)).withColumn("seq", seq), batch_id)
        if failures:
            unusable = unusable_replies(answered(stored)).withColumn("error", F.lit("unusable reply"))
            failures(failed(stored).unionByName(unusable.drop("response")), batch_id)

    return handle


def start_model(
    requests: DataFrame,
    client_factory: ClientFactory,
    settings: EnrichSettings,
    work_dir: str,
    sink: BatchSink,
    failures: BatchSink | None = None,
    plan: WindowPlan = WindowPlan(),
    trigger: str = "1 second",
    name: str = "chat-model",
    partitions: int | None = None,
) -> StreamingQuery:
    """Send stored requests (``HandOff``) to the model, apart from the classifier's stream.

    ``partitions`` is the number of calls under way at a time.
    """
    replies = model_replies(requests, client_factory, settings, plan)
    return start_batches(replies, model_handler(work_dir, sink, failures), name, work_dir, trigger, partitions)


def compared_stream(
    classifier_feed: DataFrame,
    narrative_feed: DataFrame,
    plan: WindowPlan = WindowPlan(),
    delay: str = "10 minutes",
    seq: Order = "seq",
) -> DataFrame:
    """Join the two result streams per window; ``seq`` names the columns that order repeated results.

    A result waits for its partner at most until the other side is ``delay`` further on.
    Each combination of repeated results is sent; ``newest_pairs`` keeps the last.
    """

    def side(feed: DataFrame, kind: str, name: str) -> DataFrame:
        return (
            read_results(feed)
            .where(F.col("kind") == kind)
            .withWatermark("win_start", delay)
            .select(*plan.group, F.struct(*RESULT_COLUMNS).alias(kind), order_of(seq).alias(name))
        )

    pairs = side(classifier_feed, CLASSIFIER, "classifier_seq").join(
        side(narrative_feed, NARRATIVE, "narrative_seq"), plan.group
    )
    return pairs.select(*plan.group, "classifier_seq", "narrative_seq", *comparison_columns())


def newest_pairs(pairs: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """The pair of the last result of each side, per window of a stored comparison."""
    columns = [c for c in pairs.columns if c not in (*plan.group, "classifier_seq", "narrative_seq", "batch_id")]
    last = F.max_by(F.struct(*columns), F.struct("classifier_seq", "narrative_seq")).alias("_last")
    return pairs.groupBy(*plan.group).agg(last).select(*plan.group, "_last.*")


def start_comparison(
    classifier_feed: DataFrame,
    narrative_feed: DataFrame,
    work_dir: str,
    sink: BatchSink,
    plan: WindowPlan = WindowPlan(),
    delay: str = "10 minutes",
    trigger: str | None = "10 seconds",
    name: str = "chat-comparison",
    partitions: int | None = None,
    seq: Order = "seq",
) -> StreamingQuery:
    pairs = compared_stream(classifier_feed, narrative_feed, plan, delay, seq)
    return start_batches(pairs, sink, name, work_dir, trigger, partitions)


def start_live(
    results: DataFrame,
    work_dir: str,
    sink: BatchSink,
    plan: WindowPlan = WindowPlan(),
    delay: str = "10 minutes",
    trigger: str | None = "10 seconds",
    name: str = "chat-live",
    partitions: int | None = None,
    seq: Order = "seq",
) -> StreamingQuery:
    """Send the changes of the comparison of a stream of parsed results; see ``merged_sides``."""
    return start_batches(merged_sides(results, plan, delay, seq), sink, name, work_dir, trigger, partitions)


def start_served(
    results: DataFrame,
    work_dir: str,
    table: ServingTable,
    writer: str = "main",
    trigger: str | None = "10 seconds",
    name: str = "chat-served",
) -> StreamingQuery:
    """Keep a keyed table of parsed results up to date; readers take ``table.read()``."""
    return start_batches(results, table.sink(writer), name, work_dir, trigger, None)


def start_serving(
    feed: DataFrame, work_dir: str, serving_path: str, trigger: str | None = "10 seconds", name: str = "chat-serving"
) -> StreamingQuery:
    """Store every incoming result for readers; they take ``latest_per_window`` of the table."""
    return start_batches(feed, table_sink(serving_path), name, work_dir, trigger, None)
