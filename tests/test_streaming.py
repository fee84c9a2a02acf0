import json
import time

import pytest
from pyspark.sql import functions as F

from chatpulse.config import EnrichSettings, WindowPlan
from chatpulse.functions.sentiment import ENGLISH_LEXICON, lexicon_scorer
from chatpulse.operators.comparison import compare_windows, latest_per_window, read_results
from chatpulse.plans.branches import sentiment_branch, unlimited_summary
from chatpulse.schemas import RESULT_FEED
from chatpulse.sources.readers import line_table, result_table, stamped, text_lines
from chatpulse.sources.writers import table_sink, write_lines
from chatpulse.streaming.jobs import (
    NarrativeStep,
    newest_pairs,
    start_comparison,
    start_serving,
    start_unlimited,
    start_windows,
)
from chatpulse.streaming.newest import PROCESSING_TIME
from chatpulse.operators.lines import parse_lines
from tests.helpers import at, messages
from tests.test_comparison import classifier, feed, narrative

ENGLISH = lexicon_scorer(ENGLISH_LEXICON)
TEXTS = ["good", "bad. good", "plain", "", "awful", "Fantastic! bad"]


def store(frame, path):
    frame.coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, path):
    return line_table(spark, path, spark.read.parquet(path).schema, streaming=True)


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def rows(frame, *columns):
    return sorted(map(str, frame.select(*columns).collect() if columns else frame.collect()))


@pytest.fixture()
def many(spark):
    return messages(spark, [(i * 0.7, TEXTS[i % 6] + f" {i}") for i in range(400)])


def closed_part(spark, frame):
    return sentiment_branch(frame, ENGLISH).where("win_end <= timestamp'2024-01-01 00:04:00'")


def test_stream_gives_the_batch_result(spark, tmp_path, many):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    # Rows of every window spread over all files.
    for part in many.randomSplit([1.0, 1.0, 1.0], seed=3):
        store(part, source)
    run(start_windows(stream_of(spark, source), ENGLISH, work, summaries=table_sink(f"{work}/out"), trigger=None))
    found = spark.read.parquet(f"{work}/out").drop("batch_id")
    wanted = closed_part(spark, many)
    assert wanted.count() == 4
    assert rows(found, *wanted.columns) == rows(wanted)


def test_one_window_with_most_rows_in_keyed_streams(spark, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    plan = WindowPlan(limit=7, keys=("channel",), state_shards=3)
    texts = [(i / 60 if i % 3 else 60 + i, f"{TEXTS[i % 6]} {i}") for i in range(3000)]
    frame = messages(spark, texts).withColumn("channel", F.concat(F.lit("C"), F.col("seq") % 2)).repartition(4)
    frame.write.parquet(source)
    query = start_windows(
        stream_of(spark, source), ENGLISH, work, plan, summaries=table_sink(f"{work}/out"), trigger=None, partitions=4
    )
    run(query)
    wanted = sentiment_branch(frame, ENGLISH, plan).where("win_end <= timestamp'2024-01-01 00:50:00'")
    found = spark.read.parquet(f"{work}/out").drop("batch_id")
    assert wanted.where("win_start = timestamp'2024-01-01'").count() == 2
    assert rows(found, *wanted.columns) == rows(wanted)


def test_restart_goes_on_without_repeating_windows(spark, tmp_path, many):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    store(many.where("seq < 130"), source)
    for more in ("seq >= 130 AND seq < 300", "seq >= 300"):
        run(start_windows(stream_of(spark, source), ENGLISH, work, summaries=table_sink(f"{work}/out"), trigger=None))
        store(many.where(more), source)
    run(start_windows(stream_of(spark, source), ENGLISH, work, summaries=table_sink(f"{work}/out"), trigger=None))
    found = spark.read.parquet(f"{work}/out").drop("batch_id")
    wanted = closed_part(spark, many)
    assert rows(found, *wanted.columns) == rows(wanted)


def test_both_branches_see_the_same_messages(spark, tmp_path, many):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    store(many, source)

    def factory():
        def call(request):
            prompt = json.loads(request)["messages"][1]["content"]
            start = prompt.split("Window Start: ")[1].split("\n")[0]
            count = int(prompt.split("Messages Processed: ")[1].split("\n")[0])
            if start.endswith("00:02:00"):
                raise OSError("down")
            if start.endswith("00:03:00"):
                return "{}"
            fields = {"start": start, "messageCount": count, "descriptiveParagraph": "x"}
            return json.dumps({"choices": [{"message": {"content": json.dumps(fields)}}]})

        return call

    step = NarrativeStep(
        factory,
        EnrichSettings(model="m", wait_ms=0),
        sink=table_sink(f"{work}/narrative"),
        failures=table_sink(f"{work}/failures"),
        parallelism=3,
    )
    run(
        start_windows(
            stream_of(spark, source), ENGLISH, work, results=table_sink(f"{work}/classifier"), narrative=step, trigger=None
        )
    )
    one = {r.start: r for r in _json(spark, f"{work}/classifier")}
    two = {r.start: r for r in _json(spark, f"{work}/narrative")}
    assert sorted(two) == ["01/01/2024 00:00:00", "01/01/2024 00:01:00"]
    assert all(one[s].messageCount == two[s].messageCount == 50 for s in two)
    lost = spark.read.parquet(f"{work}/failures").collect()
    assert {(r.win_start, r.attempts, r.error) for r in lost} == {(at(120), 3, "down"), (at(180), 1, "unusable reply")}


def _json(spark, path):
    table = spark.read.parquet(path)
    return table.selectExpr("from_json(value, 'start string, messageCount int') AS r").select("r.*").collect()


def test_window_of_an_idle_stream_closes_by_the_clock(spark, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    texts = [(f"Timestamp: {i}, User: U1, Message: {text}",) for i, text in enumerate(["bad", "good", "plain", "Great!"])]
    write_lines(spark.createDataFrame(texts, "value string").coalesce(1), source)
    lines = stamped(parse_lines(text_lines(spark, source, streaming=True)))
    plan = WindowPlan(duration="4 seconds", order=("arrival", "event_time"), limit=3, state_shards=2)
    query = start_windows(
        lines, ENGLISH, work, plan, summaries=table_sink(f"{work}/out"), mode=PROCESSING_TIME, trigger="1 second"
    )
    try:
        deadline = time.time() + 60
        found = []
        while not found and time.time() < deadline and query.isActive:
            time.sleep(1)
            try:
                found = spark.read.parquet(f"{work}/out").collect()
            except Exception:
                found = []
    finally:
        query.stop()
    row, = found
    assert (row.message_count, row.most_positive, row.most_negative) == (3, "good", None)


def test_all_messages_stream_gives_the_batch_result(spark, tmp_path, many):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    store(many, source)
    run(start_unlimited(stream_of(spark, source), ENGLISH, work, table_sink(f"{work}/out"), trigger=None))
    wanted = unlimited_summary(many, ENGLISH).where("win_end <= timestamp'2024-01-01 00:04:00'")
    assert rows(spark.read.parquet(f"{work}/out").drop("batch_id"), *wanted.columns) == rows(wanted)


RESULTS = [
    (0, 0, classifier(count=1)), (0, 1, narrative(paragraph="early")), (1, 2, classifier()), (0, 3, classifier(count=8)),
    (2, 4, narrative()), (1, 5, narrative(paragraph="late")), (0, 6, narrative(paragraph="later")), (3, 7, "broken"),
]


def test_stream_comparison_over_several_batches_equals_the_batch_one(spark, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    store(feed(spark, RESULTS[:3]), source)
    for part in (RESULTS[3:6], RESULTS[6:]):
        sides = [result_table(spark, source, streaming=True) for _ in range(2)]
        run(start_comparison(*sides, work, table_sink(f"{work}/pairs"), trigger=None))
        store(feed(spark, part), source)
    sides = [result_table(spark, source, streaming=True) for _ in range(2)]
    run(start_comparison(*sides, work, table_sink(f"{work}/pairs"), trigger=None))
    wanted = compare_windows(read_results(feed(spark, RESULTS)))
    assert wanted.count() == 2
    assert rows(newest_pairs(spark.read.parquet(f"{work}/pairs")), *wanted.columns) == rows(wanted)


def test_serving_table_answers_with_the_latest_results(spark, tmp_path):
    source, work, table = (str(tmp_path / n) for n in ("in", "work", "serving"))
    store(feed(spark, RESULTS), source)
    run(start_serving(result_table(spark, source, streaming=True), work, table, trigger=None))
    stored = spark.read.schema(RESULT_FEED).parquet(table)
    latest = latest_per_window(read_results(stored))
    assert {(r.win_start, r.kind, r.seq) for r in latest.collect()} == {
        (at(0), "classifier", 3), (at(0), "narrative", 6), (at(60), "classifier", 2), (at(60), "narrative", 5),
        (at(120), "narrative", 4),
    }


def test_unknown_mode_is_refused(spark, tmp_path, many):
    with pytest.raises(ValueError, match="mode"):
        start_windows(many, ENGLISH, str(tmp_path), mode="Sometimes")
