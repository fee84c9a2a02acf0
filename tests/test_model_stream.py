"""The model's own stream: hand-off, retries on timers, restart."""

import json
import os
import time

from chatpulse.config import EnrichSettings, WindowPlan
from chatpulse.functions.sentiment import ENGLISH_LEXICON, lexicon_scorer
from chatpulse.operators.enrichment import window_prompts, window_requests
from chatpulse.plans.branches import kept_messages
from chatpulse.sources.writers import table_sink
from chatpulse.streaming.jobs import HandOff, start_model, start_windows
from chatpulse.streaming.replay import settled_windows
from tests.helpers import at, messages
from tests.test_streaming import stream_of

ENGLISH = lexicon_scorer(ENGLISH_LEXICON)


def until(check, seconds=120):
    end = time.monotonic() + seconds
    while not (found := check()):
        assert time.monotonic() < end, "took too long"
        time.sleep(0.2)
    return found


def counting_factory(folder, plan):
    """``plan(minute, call) -> "ok" | "down" | "odd" | "hang"``; each call leaves a file, since tasks are processes."""

    def factory():
        def call(request):
            start = json.loads(request)["messages"][1]["content"].split("Window Start: ")[1].split("\n")[0]
            minute = int(start.split(":")[1])
            calls = [n for n in os.listdir(folder) if n.startswith(f"{minute}-")]
            with open(f"{folder}/{minute}-{len(calls)}-{time.time_ns()}", "w"):
                pass
            kind = plan(minute, len(calls))
            while kind == "hang" and not os.path.exists(f"{folder}/go"):
                time.sleep(0.1)
            if kind == "down":
                raise OSError("down")
            if kind == "odd":
                return "{}"
            return json.dumps({"choices": [{"message": {"content": json.dumps({"start": start, "descriptiveParagraph": "x"})}}]})

        return call

    return factory


def calls_of(folder):
    found = {}
    for name in os.listdir(folder):
        if "-" in name:
            minute = int(name.split("-")[0])
            found[minute] = found.get(minute, 0) + 1
    return found


def stored_requests(spark, path, minutes):
    frame = messages(spark, [(60 * m + s, "good") for m in minutes for s in range(3)])
    plan = WindowPlan()
    requests = window_requests(window_prompts(kept_messages(frame, plan), plan), "m", plan)
    requests.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(requests.schema).parquet(path)


def test_every_window_is_answered_or_listed(spark, tmp_path):
    source, work, calls = (str(tmp_path / n) for n in ("in", "work", "calls"))
    os.makedirs(calls)

    def plan(minute, call):
        return {0: "ok", 1: "down", 2: "down" if call < 2 else "ok", 3: "odd"}[minute % 4]

    requests = stored_requests(spark, source, range(8))
    query = start_model(
        requests, counting_factory(calls, plan), EnrichSettings(model="m", attempts=3, wait_ms=20), work,
        table_sink(f"{work}/contents"), table_sink(f"{work}/failures"), trigger="0 seconds", partitions=4,
    )
    try:
        until(lambda: settled_windows(spark, work) == 8)
        # The same windows handed over once more, and a new one.
        stored_requests(spark, source, [0, 1, 12])
        until(lambda: settled_windows(spark, work) == 9)
        until(lambda: spark.read.parquet(f"{work}/contents").count() == 5 and spark.read.parquet(f"{work}/failures").count() == 4)
    finally:
        query.stop()
    assert query.exception() is None
    replies = spark.read.parquet(f"{work}/replies").collect()
    minute = lambda r: r.win_start.minute
    assert {minute(r): (r.attempts, r.error) for r in replies} == {
        0: (1, None), 1: (3, "down"), 2: (3, None), 3: (1, None), 4: (1, None), 5: (3, "down"), 6: (3, None), 7: (1, None), 12: (1, None),
    }
    assert calls_of(calls) == {minute(r): r.attempts for r in replies}
    contents = {minute(r) for r in spark.read.parquet(f"{work}/contents").collect()}
    reasons = {minute(r): r.error for r in spark.read.parquet(f"{work}/failures").collect()}
    assert contents == {0, 2, 4, 6, 12} and reasons == {1: "down", 5: "down", 3: "unusable reply", 7: "unusable reply"}


def test_waits_go_on_after_a_restart(spark, tmp_path):
    source, work, calls = (str(tmp_path / n) for n in ("in", "work", "calls"))
    os.makedirs(calls)
    requests = stored_requests(spark, source, [0, 1])
    settings = EnrichSettings(model="m", attempts=2, wait_ms=15000)
    plan = lambda minute, call: "down" if call == 0 or minute == 1 else "ok"

    def start():
        return start_model(requests, counting_factory(calls, plan), settings, work, table_sink(f"{work}/contents"), trigger="0 seconds", partitions=2)

    query = start()
    until(lambda: calls_of(calls) == {0: 1, 1: 1})
    until(lambda: query.lastProgress)
    query.stop()
    assert settled_windows(spark, work) == 0
    query = start()
    try:
        until(lambda: settled_windows(spark, work) == 2)
    finally:
        query.stop()
    replies = {r.win_start: (r.attempts, r.error) for r in spark.read.parquet(f"{work}/replies").collect()}
    assert replies == {at(0): (2, None), at(60): (2, "down")} and calls_of(calls) == {0: 2, 1: 2}


def test_a_hanging_model_does_not_hold_up_the_classifier(spark, tmp_path):
    source, work, calls = (str(tmp_path / n) for n in ("in", "work", "calls"))
    os.makedirs(calls)
    settings = EnrichSettings(model="m", wait_ms=0)
    hand_off = HandOff(settings, table_sink(f"{work}/requests"))

    def more(first, last):
        rows = messages(spark, [(60 * m + s, f"good {m}") for m in range(first, last) for s in range(5)])
        rows.coalesce(1).write.mode("append").parquet(source)

    def classify():
        query = start_windows(
            stream_of(spark, source), ENGLISH, f"{work}/windows", results=table_sink(f"{work}/results"),
            hand_off=hand_off, trigger=None, partitions=4,
        )
        query.awaitTermination()
        assert query.exception() is None

    more(0, 3)
    classify()
    schema = spark.read.parquet(f"{work}/requests").drop("batch_id").schema
    model = start_model(
        spark.readStream.schema(schema).parquet(f"{work}/requests"), counting_factory(calls, lambda m, c: "hang"),
        settings, f"{work}/model", table_sink(f"{work}/contents"), trigger="0 seconds", partitions=2,
    )
    try:
        until(lambda: calls_of(calls))
        more(3, 6)
        classify()  # while the first calls are still open
        assert settled_windows(spark, f"{work}/model") == 0
        assert spark.read.parquet(f"{work}/results").count() == 5
        open(f"{calls}/go", "w").close()
        until(lambda: settled_windows(spark, f"{work}/model") == 5)
    finally:
        open(f"{calls}/go", "w").close()
        model.stop()
    assert calls_of(calls) == {m: 1 for m in range(5)}
