
from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatpulse.config import EnrichSettings, WindowPlan
from chatpulse.functions.clock import london_text
from chatpulse.functions.sentiment import lexicon_scorer
from chatpulse.operators.comparison import (
    compare_windows,
    latest_per_window,
    read_results,
    union_feeds,
    unmatched_windows,
)
from chatpulse.operators.enrichment import (
    PROMPT_FORMAT,
    SYSTEM_PROMPT,
    answered,
    extract_content,
    window_prompts,
    window_requests,
)
from chatpulse.operators.lines import channel_events, format_lines, parse_lines, quarantine_lines
from chatpulse.operators.loads import heavy_windows, keep_newest_by_load
from chatpulse.operators.placement import place_results
from chatpulse.operators.results import NO_MESSAGE, result_json
from chatpulse.operators.rollups import merge_states, state_histogram, state_summary, window_states
from chatpulse.operators.scoring import (
    class_histogram,
    score_messages,
    score_stats,
    score_with_lexicon_table,
    sentence_rows,
)
from chatpulse.operators.summary import rollup_windows
from chatpulse.operators.windows import assign_windows, tumbling_count
from chatpulse.plans.branches import (
    kept_messages,
    narrative_requests,
    sentiment_branch,
    stored_replies,
    summarise_kept,
    unlimited_summary,
)
from chatpulse.session import fresh_folder, pin_zone, store_once
from chatpulse.sources.offline import offline_client_factory
from chatpulse.sources.readers import KAFKA_ORDER
from chatpulse.sources.tables import (
    TABLE_LEXICON,
    document_messages,
    event_feed,
    event_lines,
    event_messages,
    lexicon_table,
    table,
    turn_messages,
)
from chatpulse.streaming.lines import split_lines
from chatpulse.streaming.replay import (
    replay_clock,
    replay_comparison,
    replay_live,
    replay_model,
    replay_published,
    replay_served,
    replay_summary,
    replay_unlimited,
)

SMOKE_DIR = "/root/testdata/sf0.001"

MINUTE = WindowPlan()
DAY = WindowPlan(duration="1 day")
SCORER = lexicon_scorer(TABLE_LEXICON)

MODEL = "offline-model"
#: Of every five windows, the offline model is down for the third and answers in no known form for the fifth.
EVERY, DOWN_AT, UNUSABLE_AT = 5, 2, 4


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_messages(table(pin_zone(spark), sf_dir, "documents"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(pin_zone(spark), sf_dir, "events")


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment_branch(documents(spark, sf_dir), SCORER, MINUTE)


def entry(spark: SparkSession) -> DataFrame:
    return summaries(spark, SMOKE_DIR)


# --- sources, lines ---------------------------------------------------------------


def q_source_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_messages(events(spark, sf_dir))


def q_format_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_lines(event_feed(events(spark, sf_dir))).select("seq", "value")


def q_parse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(event_lines(events(spark, sf_dir)))


def q_quarantine_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_lines(event_lines(events(spark, sf_dir)))


def q_split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and damaged lines from one stored pass, put together again."""
    good, damaged = split_lines(event_lines(events(spark, sf_dir)), fresh_folder(spark, "lines"))
    return good.unionByName(damaged, allowMissingColumns=True)


def q_channel_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = event_feed(events(spark, sf_dir))
    return channel_events(feed, "click").select("seq", "channel", "ts", "user", "text")


# --- windows, scoring, summaries --------------------------------------------------


def q_tumbling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_count(event_messages(events(spark, sf_dir)), MINUTE)


def q_tumbling_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_count(documents(spark, sf_dir), MINUTE.with_(offset="30 seconds"))


def q_london_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(pin_zone(spark), sf_dir, "orders")
    placed = F.timestamp_seconds(
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")
    )
    return orders.select("o_orderkey", london_text(placed).alias("london"))


def q_evict_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_messages(event_messages(events(spark, sf_dir)), DAY)
    return kept.select("win_start", "win_end", "arrival", "seq", "user", "message")


def q_evict_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest rows again, with only the fuller days dealt to several tasks."""
    windowed = assign_windows(event_messages(events(spark, sf_dir)), DAY)
    mean = windowed.count() // 30
    kept = keep_newest_by_load(windowed, heavy_windows(windowed, DAY, max(1, mean)), DAY)
    return kept.select("win_start", "win_end", "arrival", "seq", "user", "message")


def q_sentence_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_messages(documents(spark, sf_dir), SCORER)
    return sentence_rows(scored).select("seq", "sentence", "score", "class")


def q_message_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = score_stats(documents(spark, sf_dir), SCORER)
    return stats.select("seq", "sentence_count", "score_sum", "max_score", "min_score")


def q_lexicon_table_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_with_lexicon_table(documents(spark, sf_dir), lexicon_table(spark, TABLE_LEXICON))


def q_class_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_messages(documents(spark, sf_dir), MINUTE)
    return class_histogram(score_messages(kept, SCORER), MINUTE.group)


def q_window_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries(spark, sf_dir)


def q_window_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries(spark, sf_dir).select(*MINUTE.group, "sentence_count", "score_sum", "average_score")


def q_window_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One window per source and minute, so that averages vary more than over all sources."""
    plan = MINUTE.with_(keys=("user",))
    labelled = sentiment_branch(documents(spark, sf_dir), SCORER, plan)
    return labelled.select(*plan.group, "average_score", "overall_sentiment")


def q_window_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries(spark, sf_dir).select(
        *MINUTE.group, "max_score", "min_score", "most_positive", "most_negative"
    )


def q_window_extremes_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_messages(documents(spark, sf_dir), MINUTE)
    return summarise_kept(kept, SCORER, MINUTE, true_extremes=True).select(
        *MINUTE.group, "max_score", "min_score", "most_positive", "most_negative"
    )


def q_unlimited_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unlimited_summary(documents(spark, sf_dir), SCORER, MINUTE)


def q_rollup_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup_windows(summaries(spark, sf_dir), "5 minutes", MINUTE)


def _minute_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = kept_messages(documents(spark, sf_dir), MINUTE)
    return store_once(window_states(kept, SCORER, MINUTE), "states")


def q_sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fifteen minutes every five minutes from minute states, with the median sentence."""
    sliding = merge_states(_minute_states(spark, sf_dir), "15 minutes", "5 minutes", MINUTE)
    return state_summary(sliding, MINUTE, {"median_score": 0.5})


def q_hourly_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of an hour's sentences, merged from minutes by way of five minutes."""
    fives = merge_states(_minute_states(spark, sf_dir), "5 minutes", plan=MINUTE)
    return state_histogram(merge_states(fives, "1 hour", plan=MINUTE), MINUTE)


def q_conversation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = MINUTE.with_(keys=("conv_id",))
    turns = turn_messages(table(pin_zone(spark), sf_dir, "conversations"))
    return sentiment_branch(turns, SCORER, plan)


# --- results, narrative branch ----------------------------------------------------


def q_result_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = read_results(result_json(summaries(spark, sf_dir), MINUTE))
    return parsed.drop("descriptive_paragraph")


def _kept_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_messages(documents(spark, sf_dir), MINUTE)


def q_llm_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_prompts(_kept_documents(spark, sf_dir), MINUTE)


def q_llm_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = window_requests(window_prompts(_kept_documents(spark, sf_dir), MINUTE), MODEL, MINUTE)
    body = F.from_json("request", "model string, messages array<struct<role string, content string>>")
    return requests.withColumn("_b", body).select(
        *MINUTE.group,
        F.col("_b.model").alias("model"),
        F.size("_b.messages").alias("messages"),
        F.col("_b.messages")[0]["role"].alias("first_role"),
        F.col("_b.messages")[0]["content"].alias("first_content"),
        F.col("_b.messages")[1]["role"].alias("second_role"),
        F.col("_b.messages")[1]["content"].alias("second_content"),
    )


def q_llm_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = EnrichSettings(model=MODEL, wait_ms=0)
    requests = narrative_requests(_kept_documents(spark, sf_dir), settings, MINUTE)
    return _told(stored_replies(requests, offline_client_factory(EVERY, DOWN_AT, UNUSABLE_AT), settings, MINUTE))


def _told(replies: DataFrame) -> DataFrame:
    content = F.get_json_object("response", "$.choices[0].message.content")
    return replies.select(
        *MINUTE.group,
        "attempts",
        "error",
        F.get_json_object(content, "$.start").alias("start_text"),
        F.get_json_object(content, "$.messageCount").try_cast("bigint").alias("message_count"),
    )


def narrative_replies(summary: DataFrame) -> DataFrame:
    """Model replies made from window rows; of every five windows, the third has none."""
    content = F.to_json(
        F.struct(
            london_text("win_start").alias("start"),
            london_text("win_end").alias("end"),
            F.col("overall_sentiment").alias("overallSentiment"),
            F.coalesce("most_positive", F.lit(NO_MESSAGE)).alias("mostPositiveMessage"),
            F.coalesce("most_negative", F.lit("")).alias("mostNegativeMessage"),
            F.col("message_count").alias("messageCount"),
            F.format_string("%d messages were %s.", "message_count", "overall_sentiment").alias(
                "descriptiveParagraph"
            ),
        )
    )
    message = F.struct(F.lit("assistant").alias("role"), content.alias("content"))
    response = F.to_json(F.struct(F.array(F.struct(message.alias("message"))).alias("choices")))
    minute = F.floor(F.unix_seconds("win_start") / 60)
    return summary.where(minute % EVERY != DOWN_AT).select(
        *MINUTE.group, response.alias("response")
    )


def q_llm_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = read_results(extract_content(narrative_replies(summaries(spark, sf_dir))))
    return parsed.drop("average_score")


# --- comparison -------------------------------------------------------------------


def result_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both result kinds. Each classifier result is preceded by an empty one (seq 0) that
    the real one (seq 1) replaces."""
    summary = store_once(summaries(spark, sf_dir), "summaries")
    opened = summary.select(
        *summary.columns, F.explode(F.array(F.lit(0), F.lit(1))).alias("seq")
    )
    empty = F.col("seq") == 0
    staged = (
        opened.withColumn("message_count", F.when(empty, 0).otherwise(F.col("message_count")))
        .withColumn("average_score", F.when(empty, 0.0).otherwise(F.col("average_score")))
        .withColumn("overall_sentiment", F.when(empty, "very negative").otherwise(F.col("overall_sentiment")))
        .withColumn("most_positive", F.when(~empty, F.col("most_positive")))
        .withColumn("most_negative", F.when(~empty, F.col("most_negative")))
    )
    keyed = MINUTE.with_(keys=("seq",))
    classifier = result_json(staged, keyed)
    narrative = extract_content(narrative_replies(summary)).withColumn("seq", F.lit(1))
    return union_feeds(classifier, narrative)


def q_union_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_results(result_feed(spark, sf_dir))


def q_latest_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_window(read_results(result_feed(spark, sf_dir)), MINUTE)


def q_compare_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_windows(read_results(result_feed(spark, sf_dir)), MINUTE)


def q_unmatched_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched_windows(read_results(result_feed(spark, sf_dir)), MINUTE)


def q_compare_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same results as rows of topics: JSON, arrival, partition and offset, and no bounds."""
    feed = result_feed(spark, sf_dir)
    arrival = F.timestamp_seconds(F.unix_seconds("win_end") + F.col("seq"))
    rows = feed.select("value", arrival.alias("arrival"), F.lit(0).alias("partition"), F.col("seq").alias("offset"))
    return compare_windows(read_results(rows), MINUTE, KAFKA_ORDER)


#: Documents fifty seconds apart through the night in which London's clocks go back: 01:00 to 02:00 is printed twice.
AUTUMN_NIGHT = "2024-10-26 23:30:00"
AUTUMN_STEP = 50


def q_placed_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of an autumn night as rows of a topic, without bounds and read back days later.

    Classifier results lie in partition 0 in window order. In partition 1 every result is sent again after the next one, so
    that its order proves nothing: the doubled hours of that partition can't be placed and come out without bounds.
    """
    messages = document_messages(table(pin_zone(spark), sf_dir, "documents"), AUTUMN_NIGHT, AUTUMN_STEP)
    feed = result_json(sentiment_branch(messages, SCORER, MINUTE), MINUTE)
    minute = F.floor(F.unix_seconds("win_start") / 60)
    sent = F.explode(F.array(
        F.struct(F.lit(0).alias("partition"), minute.alias("offset")),
        F.struct(F.lit(1).alias("partition"), (2 * minute).alias("offset")),
        F.struct(F.lit(1).alias("partition"), (2 * minute + 3).alias("offset")),
    ))
    rows = feed.select("value", (F.col("win_end") + F.expr("INTERVAL 3 DAYS")).alias("arrival"), sent.alias("_s"))
    placed = place_results(read_results(rows.select("value", "arrival", "_s.partition", "_s.offset")))
    return placed.select("partition", "offset", "win_start", "win_end", "window_key", "message_count")


def q_served_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed through a serving table, a few micro-batches and compactions long."""
    return replay_served(result_feed(spark, sf_dir), MINUTE)


def enriched_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both branches over the same kept messages: summaries, and prompt, request, reply and content."""
    kept = store_once(_kept_documents(spark, sf_dir), "kept")
    classifier = result_json(summarise_kept(kept, SCORER, MINUTE), MINUTE)
    client = offline_client_factory(EVERY, DOWN_AT, UNUSABLE_AT)
    settings = EnrichSettings(model=MODEL, wait_ms=0)
    replies = stored_replies(narrative_requests(kept, settings, MINUTE), client, settings, MINUTE)
    narrative = extract_content(answered(replies)).select(*MINUTE.group, "value")
    return union_feeds(classifier, narrative).withColumn("seq", F.lit(0).cast("bigint"))


def q_compare_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_windows(read_results(enriched_feed(spark, sf_dir)), MINUTE)


def q_unmatched_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched_windows(read_results(enriched_feed(spark, sf_dir)), MINUTE)


# --- streams run to completion over the stored tables -----------------------------


def q_stream_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_summary(pin_zone(spark), f"{sf_dir}/documents.parquet", SCORER, MINUTE)


def q_stream_unlimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_unlimited(pin_zone(spark), f"{sf_dir}/documents.parquet", SCORER, MINUTE)


def q_stream_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both branches of the stream have published, compared as stored."""
    results = replay_published(
        pin_zone(spark), f"{sf_dir}/documents.parquet", SCORER, offline_client_factory(EVERY, DOWN_AT, UNUSABLE_AT),
        EnrichSettings(model=MODEL, wait_ms=0), MINUTE,
    )
    return compare_windows(read_results(results), MINUTE)


def q_stream_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay_comparison(result_feed(spark, sf_dir), MINUTE)


def q_stream_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both results of each window as the live comparison holds them, and the windows that waited in vain."""
    return replay_live(result_feed(spark, sf_dir), MINUTE)


def q_stream_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests through the model's own stream, with a model that fails for some windows."""
    settings = EnrichSettings(model=MODEL, wait_ms=0)
    requests = narrative_requests(_kept_documents(spark, sf_dir), settings, MINUTE)
    replies = replay_model(requests, offline_client_factory(EVERY, DOWN_AT, UNUSABLE_AT), settings, MINUTE)
    return _told(replies)


def q_clock_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows by the clock: rows are stamped as they are read, and all of them end without a later row."""
    counted = replay_clock(pin_zone(spark), f"{sf_dir}/documents.parquet", SCORER)
    return counted.agg(F.sum("message_count").alias("messages"), F.sum("sentence_count").alias("sentences"))


def _text_jobs():
    """The training-text subpackage and its pipeline; None for both where they are not installed."""
    try:
        import chatpulse.llm.queries as jobs
        import corpus_pipeline as pipeline
    except ModuleNotFoundError as missing:
        if missing.name not in ("chatpulse.llm", "chatpulse.llm.queries", "corpus_pipeline"):
            raise
        return None, None
    return jobs, pipeline


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
    jobs, pipeline = _text_jobs()
    return own | jobs.queries() | {"pipeline": pipeline.run} if jobs else own


# --- the same queries in SQL ------------------------------------------------------

_DOCS = """
msgs AS (
  SELECT TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS arrival, doc_id AS seq,
         source AS "user", text AS message
  FROM documents
)"""

_EVENT_MSGS = """
msgs AS (
  SELECT ts AS arrival, event_id AS seq, epoch_us(ts) // 1000000 AS event_time,
         'U' || user_id AS "user", event_type || ' ' || props AS message
  FROM events
)"""

_LINES = """
feed AS (
  SELECT event_id AS seq, event_type AS channel,
         (epoch_us(ts) // 1000000)::VARCHAR || '.' || lpad((epoch_us(ts) % 1000000)::VARCHAR, 6, '0') AS ts,
         'U' || user_id AS "user", event_type || ' ' || props AS text
  FROM events
),
whole AS (
  SELECT seq, channel, 'Timestamp: ' || ts || ', User: ' || "user" || ', Message: ' || text AS value FROM feed
),
lines AS (
  SELECT seq, CASE WHEN channel = 'error' THEN regexp_extract(value, '^(.*?, .*?), ', 1) ELSE value END AS value
  FROM whole
),
parsed AS (
  SELECT seq, value,
         regexp_extract(value, '(?s)^[^:]*: ([0-9.]+), [^:]*: ([^:]+?), [^:]*: (.*)$', ['s', 'u', 'm']) AS f
  FROM lines
)"""


def _windowed(width: str, keys: str = "", offset: str = "0 seconds") -> str:
    part = f"{keys}, " if keys else ""
    return f"""
windowed AS (
  SELECT *, time_bucket(INTERVAL '{width}', arrival, INTERVAL '{offset}') AS win_start,
         time_bucket(INTERVAL '{width}', arrival, INTERVAL '{offset}') + INTERVAL '{width}' AS win_end
  FROM msgs
),
kept AS (
  SELECT * FROM windowed
  QUALIFY row_number() OVER (PARTITION BY {part}win_start ORDER BY arrival DESC, seq DESC) <= 50
)"""


def _scored(source: str) -> str:
    weights = " ".join(f"WHEN '{word}' THEN {weight}" for word, weight in TABLE_LEXICON.items())
    return f"""
cut AS (
  SELECT *, CASE WHEN length(message) > 0 THEN
           list_filter(regexp_split_to_array(lower(message), '[.!?\\n]+'), lambda s: regexp_matches(s, '[\\p{{L}}\\p{{N}}]'))
         ELSE [] END AS sents
  FROM {source}
),
scored AS (
  SELECT * EXCLUDE (sents), list_transform(sents, lambda s: greatest(0, least(4, 2 + list_sum(
           list_transform(regexp_split_to_array(s, '[^\\p{{L}}]+'),
                          lambda t: CASE t {weights} ELSE 0 END)))))::INTEGER[] AS scores
  FROM cut
),
stats AS (
  SELECT *, len(scores) AS n, coalesce(list_sum(scores), 0) AS s, list_max(scores) AS mx, list_min(scores) AS mn
  FROM scored
)"""


_CLASS = (
    "['Very negative', 'Negative', 'Neutral', 'Positive', 'Very positive'][score + 1]"
)
_AVERAGE = """CASE WHEN sentence_count > 0
  THEN ((200 * score_sum + sentence_count) // (2 * sentence_count)) / 100.0 ELSE 0.0 END"""
_LABEL = """CASE WHEN sentence_count = 0 THEN 'very negative'
  WHEN 2 * score_sum >= 7 * sentence_count THEN 'very positive'
  WHEN 2 * score_sum >= 5 * sentence_count THEN 'positive'
  WHEN 2 * score_sum >= 3 * sentence_count THEN 'neutral'
  WHEN 2 * score_sum >= 1 * sentence_count THEN 'negative'
  ELSE 'very negative' END"""


def _summed(source: str = "stats", keys: str = "", true_extremes: bool = False) -> str:
    part = f"{keys}, " if keys else ""
    positive = "struct_pack(m := -mx, s := seq)" if true_extremes else "seq"
    negative = "struct_pack(m := mn, s := seq)" if true_extremes else "seq"
    return f"""
summed AS (
  SELECT {part}win_start, win_end, count(*) AS message_count, sum(n)::BIGINT AS sentence_count,
         sum(s)::BIGINT AS score_sum, max(mx) AS max_score, min(mn) AS min_score,
         arg_min(message, {positive}) FILTER (WHERE mx >= 2.5) AS most_positive,
         arg_min(message, {negative}) FILTER (WHERE mn < 1.5) AS most_negative
  FROM {source} GROUP BY {part}win_start, win_end
),
summary AS (
  SELECT *, {_AVERAGE} AS average_score, {_LABEL} AS overall_sentiment FROM summed
)"""


def _london(instant: str) -> str:
    return f"strftime(timezone('Europe/London', timezone('UTC', {instant})), '%d/%m/%Y %H:%M:%S')"


_SUMMARY = f"WITH {_DOCS}, {_windowed('1 minute')}, {_scored('kept')}, {_summed()}"
_SUMMARY_TRUE = f"WITH {_DOCS}, {_windowed('1 minute')}, {_scored('kept')}, {_summed(true_extremes=True)}"

_PARTS = [part.replace("'", "''") for part in re.split(r"%[sd]", PROMPT_FORMAT)]
_PROMPTS = f"""WITH {_DOCS}, {_windowed('1 minute')},
listed AS (
  SELECT win_start, win_end, count(*) AS message_count,
         string_agg('- ' || message, chr(10) ORDER BY arrival, seq) AS bullets
  FROM kept GROUP BY win_start, win_end
),
prompts AS (
  SELECT *, '{_PARTS[0]}' || {_london('win_start')} || '{_PARTS[1]}' || {_london('win_end')} || '{_PARTS[2]}'
         || message_count || '{_PARTS[3]}' || bullets || '{_PARTS[4]}' AS prompt
  FROM listed
)"""

_MINUTE = "(epoch_us(win_start) // 60000000)"

_ENRICH = f"""{_PROMPTS},
            turns AS (SELECT *, {_MINUTE} % {EVERY} AS turn FROM prompts)
            SELECT win_start, win_end, CASE WHEN turn = {DOWN_AT} THEN 3 ELSE 1 END AS attempts,
                   CASE WHEN turn = {DOWN_AT} THEN 'model unavailable' END AS error,
                   CASE WHEN turn NOT IN ({DOWN_AT}, {UNUSABLE_AT}) THEN {_london('win_start')} END AS start_text,
                   CASE WHEN turn NOT IN ({DOWN_AT}, {UNUSABLE_AT}) THEN message_count END AS message_count
            FROM turns"""

_RESULTS = f"""{_SUMMARY},
named AS (
  SELECT *, {_london('win_start')} || ' - ' || {_london('win_end')} AS window_key FROM summary
),
results AS (
  SELECT win_start, win_end, 1 AS seq, 'classifier' AS kind, window_key, overall_sentiment,
         coalesce(most_positive, 'N/A') AS most_positive, coalesce(most_negative, 'N/A') AS most_negative,
         message_count, average_score, NULL::VARCHAR AS descriptive_paragraph
  FROM named
  UNION ALL BY NAME
  SELECT win_start, win_end, 0 AS seq, 'classifier' AS kind, window_key, 'very negative' AS overall_sentiment,
         'N/A' AS most_positive, 'N/A' AS most_negative, 0 AS message_count, 0.0 AS average_score
  FROM named
  UNION ALL BY NAME
  SELECT win_start, win_end, 1 AS seq, 'narrative' AS kind, window_key, overall_sentiment,
         coalesce(most_positive, 'N/A') AS most_positive, coalesce(most_negative, '') AS most_negative,
         message_count, message_count || ' messages were ' || overall_sentiment || '.' AS descriptive_paragraph
  FROM named WHERE {_MINUTE} % {EVERY} <> {DOWN_AT}
),
latest AS (
  SELECT * FROM results
  QUALIFY row_number() OVER (PARTITION BY win_start, win_end, kind ORDER BY seq DESC) = 1
)"""

_COMPARED = """
  SELECT c.win_start, c.win_end, c.window_key,
         c.overall_sentiment AS classifier_sentiment, c.most_positive AS classifier_positive,
         coalesce(nullif(c.most_negative, ''), 'N/A') AS classifier_negative,
         c.message_count AS classifier_count, c.average_score,
         n.overall_sentiment AS narrative_sentiment, n.most_positive AS narrative_positive,
         coalesce(nullif(n.most_negative, ''), 'N/A') AS narrative_negative,
         n.message_count AS narrative_count, nullif(n.descriptive_paragraph, '') AS descriptive_paragraph
  FROM (SELECT * FROM latest WHERE kind = 'classifier') c
  JOIN (SELECT * FROM latest WHERE kind = 'narrative') n USING (win_start, win_end)"""


_ENRICHED = f"""
  SELECT win_start, win_end, window_key, overall_sentiment AS classifier_sentiment,
         coalesce(most_positive, 'N/A') AS classifier_positive,
         coalesce(nullif(most_negative, ''), 'N/A') AS classifier_negative,
         message_count AS classifier_count, average_score, 'neutral' AS narrative_sentiment,
         'N/A' AS narrative_positive, 'N/A' AS narrative_negative, message_count AS narrative_count,
         message_count || ' messages were read.' AS descriptive_paragraph
  FROM named WHERE {_MINUTE} % {EVERY} NOT IN ({DOWN_AT}, {UNUSABLE_AT})"""


def oracle_sql() -> dict[str, str]:
    jobs, _ = _text_jobs()
    return _own_sql() | (jobs.oracle_sql() if jobs else {})


def _own_sql() -> dict[str, str]:
    extremes = "SELECT win_start, win_end, max_score, min_score, most_positive, most_negative FROM summary"
    return {
        "source_messages": f'WITH {_EVENT_MSGS} SELECT arrival, seq, event_time, "user", message FROM msgs',
        "format_lines": f"WITH {_LINES} SELECT seq, value FROM whole",
        "parse_lines": f"""WITH {_LINES} SELECT seq, floor(f.s::DECIMAL(18, 6))::BIGINT AS event_time,
            f.u AS "user", f.m AS message FROM parsed WHERE f.s <> ''""",
        "quarantine_lines": f"""WITH {_LINES}
            SELECT seq, value, 'message' AS reason FROM parsed WHERE f.s = ''""",
        "split_lines": f"""WITH {_LINES} SELECT seq, CASE WHEN f.s = '' THEN value END AS value,
            CASE WHEN f.s = '' THEN 'message' END AS reason,
            floor(nullif(f.s, '')::DECIMAL(18, 6))::BIGINT AS event_time,
            CASE WHEN f.s <> '' THEN f.u END AS "user", CASE WHEN f.s <> '' THEN f.m END AS message FROM parsed""",
        "channel_filter": f"""WITH {_LINES}
            SELECT seq, channel, ts, "user", text FROM feed WHERE channel = 'click'""",
        "tumbling_count": f"""WITH {_EVENT_MSGS}, {_windowed('1 minute')}
            SELECT win_start, win_end, count(*) AS message_count FROM windowed GROUP BY ALL""",
        "tumbling_offset": f"""WITH {_DOCS}, {_windowed('1 minute', offset='30 seconds')}
            SELECT win_start, win_end, count(*) AS message_count FROM windowed GROUP BY ALL""",
        "london_time": f"""SELECT o_orderkey,
            {_london('o_orderdate::TIMESTAMP + to_seconds(o_orderkey)')} AS london FROM orders""",
        "evict_newest": f"""WITH {_EVENT_MSGS}, {_windowed('1 day')}
            SELECT win_start, win_end, arrival, seq, "user", message FROM kept""",
        "evict_by_load": f"""WITH {_EVENT_MSGS}, {_windowed('1 day')}
            SELECT win_start, win_end, arrival, seq, "user", message FROM kept""",
        "sentence_scores": f"""WITH {_DOCS}, {_scored('msgs')},
            rows AS (SELECT seq, generate_subscripts(scores, 1) - 1 AS sentence, unnest(scores) AS score FROM scored)
            SELECT seq, sentence, score, {_CLASS} AS class FROM rows""",
        "message_scores": f"""WITH {_DOCS}, {_scored('msgs')}
            SELECT seq, n AS sentence_count, s::BIGINT AS score_sum, mx AS max_score, mn AS min_score FROM stats""",
        "lexicon_table_scores": f"""WITH {_DOCS}, {_scored('msgs')}
            SELECT seq, n AS sentence_count, s::BIGINT AS score_sum, mx AS max_score, mn AS min_score FROM stats""",
        "class_histogram": f"""WITH {_DOCS}, {_windowed('1 minute')}, {_scored('kept')},
            rows AS (SELECT win_start, win_end, unnest(scores) AS score FROM scored)
            SELECT win_start, win_end, {_CLASS} AS class, count(*) AS sentences FROM rows GROUP BY ALL""",
        "window_summary": f"{_SUMMARY} SELECT * FROM summary",
        "window_average": f"""{_SUMMARY}
            SELECT win_start, win_end, sentence_count, score_sum, average_score FROM summary""",
        "window_label": f"""WITH {_DOCS}, {_windowed('1 minute', '"user"')}, {_scored('kept')},
            {_summed(keys='"user"')}
            SELECT "user", win_start, win_end, average_score, overall_sentiment FROM summary""",
        "window_extremes": f"{_SUMMARY} {extremes}",
        "window_extremes_true": f"{_SUMMARY_TRUE} {extremes}",
        "unlimited_summary": f"""WITH {_DOCS}, {_windowed('1 minute')}, {_scored('windowed')}, {_summed()}
            SELECT * FROM summary""",
        "rollup_windows": f"""WITH {_DOCS}, {_windowed('1 minute')},
            longer AS (SELECT * REPLACE (time_bucket(INTERVAL '5 minutes', arrival) AS win_start,
                time_bucket(INTERVAL '5 minutes', arrival) + INTERVAL '5 minutes' AS win_end) FROM kept),
            {_scored('longer')}, {_summed()} SELECT * FROM summary""",
        "sliding_windows": f"""WITH {_DOCS}, {_windowed('1 minute')},
            longer AS (SELECT * REPLACE (time_bucket(INTERVAL '5 minutes', arrival) - to_minutes(back) AS win_start,
                time_bucket(INTERVAL '5 minutes', arrival) - to_minutes(back) + INTERVAL '15 minutes' AS win_end)
              FROM kept, (VALUES (0), (5), (10)) AS b(back)),
            {_scored('longer')}, {_summed()},
            sentences AS (SELECT win_start, unnest(scores) AS score FROM scored),
            medians AS (SELECT win_start, quantile_disc(score, 0.5) AS median_score FROM sentences GROUP BY win_start)
            SELECT summary.*, median_score FROM summary LEFT JOIN medians USING (win_start)""",
        "hourly_histogram": f"""WITH {_DOCS}, {_windowed('1 minute')}, {_scored('kept')},
            rows AS (SELECT time_bucket(INTERVAL '1 hour', arrival) AS win_start, unnest(scores) AS score FROM scored)
            SELECT win_start, win_start + INTERVAL '1 hour' AS win_end, {_CLASS} AS class, count(*) AS sentences FROM rows GROUP BY ALL""",
        "conversation_summary": f"""WITH msgs AS (
              SELECT conv_id, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(turn * 10) AS arrival, turn AS seq,
                     role AS "user", text AS message FROM conversations),
            {_windowed('1 minute', 'conv_id')}, {_scored('kept')}, {_summed(keys='conv_id')}
            SELECT * FROM summary""",
        "result_json": f"""{_RESULTS} SELECT * EXCLUDE (seq, descriptive_paragraph) FROM results
            WHERE kind = 'classifier' AND seq = 1""",
        "llm_prompt": f"{_PROMPTS} SELECT * FROM prompts",
        "llm_request": f"""{_PROMPTS} SELECT win_start, win_end, '{MODEL}' AS model, 2 AS messages,
            'system' AS first_role, '{SYSTEM_PROMPT}' AS first_content,
            'user' AS second_role, prompt AS second_content FROM prompts""",
        "llm_enrich": _ENRICH,
        "llm_extract": f"""{_RESULTS} SELECT * EXCLUDE (seq, average_score) FROM results
            WHERE kind = 'narrative'""",
        "union_results": f"{_RESULTS} SELECT * FROM results",
        "latest_per_window": f"{_RESULTS} SELECT * FROM latest",
        "compare_windows": f"{_RESULTS} {_COMPARED}",
        "unmatched_windows": f"""{_RESULTS} SELECT win_start, win_end, 'narrative' AS missing FROM latest
            GROUP BY win_start, win_end HAVING count(*) = 1""",
        "stream_summary": f"{_SUMMARY} SELECT * FROM summary",
        "stream_unlimited": f"""WITH {_DOCS}, {_windowed('1 minute')}, {_scored('windowed')}, {_summed()}
            SELECT * FROM summary""",
        "stream_compare": f"{_RESULTS} {_COMPARED}",
        "stream_live": f"""{_RESULTS}, pairs AS ({_COMPARED})
            SELECT *, NULL::VARCHAR AS missing FROM pairs UNION ALL BY NAME
            SELECT win_start, win_end, 'narrative' AS missing FROM latest GROUP BY win_start, win_end HAVING count(*) = 1""",
        "stream_model": _ENRICH,
        "clock_windows": f"""WITH {_DOCS}, {_scored('msgs')}
            SELECT count(*)::BIGINT AS messages, sum(n)::BIGINT AS sentences FROM stats""",
        "served_windows": f"{_RESULTS} SELECT * FROM latest",
        "placed_topics": f"""WITH msgs AS (
              SELECT TIMESTAMP '{AUTUMN_NIGHT}' + to_seconds(doc_id * {AUTUMN_STEP}) AS arrival, doc_id AS seq FROM documents
            ), {_windowed('1 minute')},
            counted AS (SELECT win_start, win_end, count(*) AS message_count, {_MINUTE} AS minute FROM kept GROUP BY ALL),
            sent AS (
              SELECT *, 0 AS "partition", minute AS "offset" FROM counted UNION ALL
              SELECT counted.*, 1, 2 * minute + again FROM counted, (VALUES (0), (3)) AS s(again)
            ), told AS (
              SELECT *, "partition" = 1 AND win_start >= TIMESTAMP '2024-10-27 00:00:00' AND win_start < TIMESTAMP '2024-10-27 02:00:00'
                AND win_start <> TIMESTAMP '2024-10-27 00:59:00' AS lost FROM sent
            )
            SELECT "partition", "offset", CASE WHEN NOT lost THEN win_start END AS win_start, CASE WHEN NOT lost THEN win_end END AS win_end,
              {_london('win_start')} || ' - ' || {_london('win_end')} AS window_key, message_count FROM told""",
        "compare_topics": f"{_RESULTS} {_COMPARED}",
        "compare_enriched": f"{_RESULTS} {_ENRICHED}",
        "stream_published": f"{_RESULTS} {_ENRICHED}",
        "unmatched_enriched": f"""{_RESULTS} SELECT win_start, win_end, 'narrative' AS missing FROM named
            WHERE {_MINUTE} % {EVERY} IN ({DOWN_AT}, {UNUSABLE_AT})""",
    }
