"""Bounds of printed times, the autumn night included."""

import datetime as dt
import json

import pytest

from chatpulse.operators.comparison import compare_windows, latest_per_window, read_results, unplaced_results
from chatpulse.operators.placement import place_results
from chatpulse.sources.readers import KAFKA_ORDER

UTC = dt.datetime
SCHEMA = "value string, arrival timestamp, partition int, offset long, topic string"
LATER = UTC(2024, 11, 5)


def london(instant):
    summer = UTC(2024, 3, 31, 1) <= instant < UTC(2024, 10, 27, 1)
    return (instant + dt.timedelta(hours=1 if summer else 0)).strftime("%d/%m/%Y %H:%M:%S")


def row(start, offset, kind="classifier", minutes=10, arrival=LATER, partition=0, count=1):
    own = {"averageScore": 2.5} if kind == "classifier" else {"descriptiveParagraph": "d"}
    fields = {"start": london(start), "end": london(start + dt.timedelta(minutes=minutes)), "overallSentiment": "x", "messageCount": count}
    return (json.dumps(fields | own), arrival, partition, offset, kind)


def night(first, last, minutes=10):
    steps = int((last - first).total_seconds() // (60 * minutes))
    return [first + dt.timedelta(minutes=minutes * i) for i in range(steps)]


def placed(spark, rows, **settings):
    results = place_results(read_results(spark.createDataFrame(rows, SCHEMA)), **settings)
    return {(r.partition, r.offset): (r.win_start, r.win_end) for r in results.collect()}


ALL = night(UTC(2024, 10, 26, 23), UTC(2024, 10, 27, 3))


def test_both_hours_come_back(spark):
    rows = [row(start, i) for i, start in enumerate(ALL)]
    found = placed(spark, rows[::-1])
    assert found == {(0, i): (s, s + dt.timedelta(minutes=10)) for i, s in enumerate(ALL)}
    # Read one by one, the second hour passes for the first.
    assert len({r.win_start for r in read_results(spark.createDataFrame(rows, SCHEMA)).collect()}) == len(ALL) - 6


def test_partitions_kinds_and_comparisons(spark):
    # Each topic has two partitions that take turns.
    rows = [row(s, i // 2, kind, partition=i % 2, count=i) for kind in ("classifier", "narrative") for i, s in enumerate(ALL)]
    results = place_results(read_results(spark.createDataFrame(rows, SCHEMA)))
    assert unplaced_results(results).count() == 0
    pairs = compare_windows(results, seq=KAFKA_ORDER).collect()
    assert sorted((r.win_start, r.classifier_count, r.narrative_count) for r in pairs) == [(s, i, i) for i, s in enumerate(ALL)]
    assert latest_per_window(results, seq=KAFKA_ORDER).count() == 2 * len(ALL)


def test_results_sent_again_prove_nothing(spark):
    order = ALL[:8] + [ALL[7]] + ALL[7:]
    found = placed(spark, [row(s, i) for i, s in enumerate(order)])
    assert found == {(0, i): (s, s + dt.timedelta(minutes=10)) for i, s in enumerate(order)}  # the same again is no fall
    order = ALL[:9] + [ALL[7]] + ALL[9:]
    found = placed(spark, [row(s, i) for i, s in enumerate(order)])
    doubled = lambda s: UTC(2024, 10, 27) <= s < UTC(2024, 10, 27, 2)
    for i, s in enumerate(order):
        # 00:50 UTC ends at 01:00, printed 01:00 as well: its end lies after its start in one reading only.
        settled = not doubled(s) or s == UTC(2024, 10, 27, 0, 50)
        assert found[0, i] == ((s, s + dt.timedelta(minutes=10)) if settled else (None, None))


@pytest.mark.parametrize("gone", ["first", "second"])
def test_one_hour_alone(spark, gone):
    hour = (UTC(2024, 10, 27, 0), UTC(2024, 10, 27, 1)) if gone == "first" else (UTC(2024, 10, 27, 1), UTC(2024, 10, 27, 2))
    kept = [s for s in ALL if not hour[0] <= s < hour[1]]
    rows = [row(s, i) for i, s in enumerate(kept)]
    truth = {(0, i): (s, s + dt.timedelta(minutes=10)) for i, s in enumerate(kept)}
    found = placed(spark, rows)
    if gone == "second":
        assert found == truth  # the last one of the first hour is settled by its end, all before it follow
    else:
        assert {k for k in truth if found[k] != truth[k]} == {(0, i) for i, s in enumerate(kept) if UTC(2024, 10, 27, 1) <= s < UTC(2024, 10, 27, 2)}
        # 02:00 as an end has one reading, so the length settles the last window, but nothing before it.
        by_length = placed(spark, rows, length="10 minutes")
        assert sum(v == (None, None) for v in by_length.values()) == 5
    live = [row(s, i, arrival=s + dt.timedelta(minutes=11)) for i, s in enumerate(kept)]
    known = placed(spark, live)
    assert all(known[k] in (truth[k], (None, None)) for k in truth)
    assert gone == "first" or known == truth


def test_arrivals_settle_what_the_order_does_not(spark):
    order = ALL[:9] + [ALL[7]] + ALL[9:]
    rows = [row(s, i, arrival=s + dt.timedelta(minutes=11)) for i, s in enumerate(order)]
    found = placed(spark, rows)
    summer = [i for i, s in enumerate(order) if UTC(2024, 10, 27) <= s < UTC(2024, 10, 27, 1)]
    assert all(found[0, i][0] == order[i] for i in summer)


def test_long_windows_unreadable_ones_and_other_nights(spark):
    hours = night(UTC(2024, 10, 26, 22), UTC(2024, 10, 27, 4), 60)
    assert placed(spark, [row(s, i, minutes=60) for i, s in enumerate(hours)]) == {(0, i): (s, s + dt.timedelta(hours=1)) for i, s in enumerate(hours)}
    plain = [UTC(2024, 7, 1, 0, 30), UTC(2024, 7, 1, 0, 10), UTC(2024, 3, 31, 0, 50), UTC(2024, 3, 31, 1, 0), UTC(2023, 12, 1, 1, 10)]
    assert placed(spark, [row(s, i) for i, s in enumerate(plain[:4])]) == {(0, i): (s, s + dt.timedelta(minutes=10)) for i, s in enumerate(plain[:4])}
    odd = [('{"averageScore":1,"start":"soon","end":"later"}', LATER, 0, 1, "t"), (None, LATER, 0, 2, "t"), ("{}", LATER, 0, 3, "t")]
    assert placed(spark, odd) == {(0, 1): (None, None)}
    results = read_results(spark.createDataFrame(odd, SCHEMA).where("false"))
    assert place_results(results).count() == 0 and place_results(results).columns == results.columns
    nulls = [row(s, None) for s in ALL]
    lost = place_results(read_results(spark.createDataFrame(nulls, SCHEMA)))
    assert unplaced_results(lost).count() == 11  # the window that only ends after its start in summer is settled


def test_only_doubled_hours_are_moved(spark):
    results = place_results(read_results(spark.createDataFrame([row(s, i) for i, s in enumerate(ALL)], SCHEMA).drop("topic")))
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and results.count() == len(ALL)
