import datetime as dt
import json

from chatpulse.functions.clock import london_text
from chatpulse.functions.sentiment import ENGLISH_LEXICON, lexicon_scorer
from chatpulse.operators.comparison import (
    compare_windows,
    latest_per_window,
    read_results,
    union_feeds,
    unmatched_windows,
)
from chatpulse.operators.results import result_json
from chatpulse.plans.branches import sentiment_branch
from chatpulse.config import WindowPlan
from tests.helpers import at, messages, plan_text

FEED = "win_start timestamp, win_end timestamp, seq long, value string"


def classifier(count=5, negative="N/A", average=2.83):
    return json.dumps(
        {"start": "s", "end": "e", "overallSentiment": "positive", "mostPositiveMessage": "p",
         "mostNegativeMessage": negative, "messageCount": count, "averageScore": average}
    )


def narrative(paragraph="Nice.", negative="bad", count=5):
    return json.dumps(
        {"start": "s", "end": "e", "overallSentiment": "neutral", "mostPositiveMessage": "p",
         "mostNegativeMessage": negative, "messageCount": count, "descriptiveParagraph": paragraph}
    )


def feed(spark, rows):
    return spark.createDataFrame([(at(60 * w), at(60 * w + 60), s, v) for w, s, v in rows], FEED)


def test_result_json_has_the_published_layout(spark):
    plan = WindowPlan(offset="30 seconds")
    frame = messages(spark, [(40, "That was amazing!"), (50, "No."), (60, "Great? Plain.")])
    row = result_json(sentiment_branch(frame, lexicon_scorer(ENGLISH_LEXICON), plan), plan).first()
    assert row.value == (
        '{"start":"01/01/2024 00:00:30","end":"01/01/2024 00:01:30","overallSentiment":"positive",'
        '"mostPositiveMessage":"That was amazing!","mostNegativeMessage":"N/A","messageCount":3,"averageScore":2.75}'
    )


def test_bounds_are_printed_in_london_time(spark):
    rows = [(dt.datetime(2024, 7, 31, 14, 18, 30),), (dt.datetime(2024, 1, 31, 14, 18, 30),), (dt.datetime(2024, 10, 27, 1, 30),)]
    texts = [r.t for r in spark.createDataFrame(rows, "at timestamp").select(london_text("at").alias("t")).collect()]
    assert texts == ["31/07/2024 15:18:30", "31/01/2024 14:18:30", "27/10/2024 01:30:00"]


def test_kinds_are_told_by_their_own_field(spark):
    rows = [
        (0, 0, classifier()), (0, 1, narrative()), (0, 2, '{"start":"s"}'), (0, 3, "no json"), (0, 4, "7"),
        (0, 5, "null"), (0, 6, '{"averageScore":null}'), (0, 7, '{"averageScore":1,"descriptiveParagraph":"x"}'), (0, 8, None),
    ]
    found = {r.seq: r.kind for r in read_results(feed(spark, rows)).collect()}
    assert found == {0: "classifier", 1: "narrative", 6: "classifier", 7: "classifier"}


def test_quoted_numbers_are_read(spark):
    row = read_results(feed(spark, [(0, 0, narrative(count="12"))])).first()
    assert row.message_count == 12
    assert read_results(feed(spark, [(0, 0, narrative(count="many"))])).first().message_count is None


def test_last_result_of_a_kind_wins(spark):
    rows = [(0, 2, classifier(count=2)), (0, 9, classifier(count=9)), (0, 3, classifier(count=3)), (0, 1, narrative())]
    found = {(r.kind, r.seq, r.message_count) for r in latest_per_window(read_results(feed(spark, rows))).collect()}
    assert found == {("classifier", 9, 9), ("narrative", 1, 5)}


def test_only_complete_pairs_are_compared(spark):
    rows = [
        (0, 0, classifier(negative="")), (0, 1, narrative(paragraph="", negative="")), (0, 2, narrative(negative="worse", paragraph="")),
        (1, 3, classifier()), (2, 4, narrative()),
    ]
    results = read_results(feed(spark, rows))
    row, = compare_windows(results).collect()
    assert row.win_start == at(0)
    assert (row.classifier_negative, row.narrative_negative, row.descriptive_paragraph) == ("N/A", "worse", None)
    waiting = {(r.win_start, r.missing) for r in unmatched_windows(results).collect()}
    assert waiting == {(at(60), "narrative"), (at(120), "classifier")}


def test_comparison_takes_one_shuffle_and_no_join(spark):
    plan = plan_text(compare_windows(read_results(feed(spark, [(0, 0, classifier())]))))
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_feeds_with_different_columns_are_united(spark):
    a = feed(spark, [(0, 0, classifier())]).withColumnRenamed("seq", "offset")
    united = union_feeds(a, feed(spark, [(0, 1, narrative())]))
    assert united.count() == 2 and {"offset", "seq"} <= set(united.columns)
