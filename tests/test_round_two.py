"""Sentence and token rules, results without an order, uneven roll-ups, outages of any size."""

import json

import pytest

from chatpulse.functions.sentiment import lexicon_scorer
from chatpulse.operators.comparison import compare_windows, latest_per_window, unmatched_windows
from chatpulse.operators.scoring import score_stats
from chatpulse.operators.summary import rollup_windows
from chatpulse.sources.offline import offline_client_factory
from tests.helpers import at, messages

RESULT = "win_start timestamp, win_end timestamp, kind string, seq long, window_key string, overall_sentiment string, most_positive string, most_negative string, message_count long, average_score double, descriptive_paragraph string"


@pytest.mark.parametrize(
    "text, sentences, total",
    [("Good.\r\nBad.", 2, 4), ("a.\t\t.b", 2, 4), ('"Good." (yes)', 2, 5), (". . | ***", 0, 0), ("Été!", 1, 4), (" ", 0, 0), ("7.", 1, 2)],
)
def test_sentences_hold_a_letter_or_digit(spark, text, sentences, total):
    scorer = lexicon_scorer({"good": 1, "bad": -1, "été": 2})
    row = score_stats(messages(spark, [(0, text)]), scorer).first()
    assert (row["sentence_count"], row["score_sum"]) == (sentences, total)


def test_lexicons_of_any_size(spark):
    scorer = lexicon_scorer({f"w{'x' * (i % 7)}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}": 1 for i in range(6000)})
    assert score_stats(messages(spark, [(0, "none")]), scorer).first()["sentence_count"] == 1


def test_results_without_an_order_are_kept(spark):
    def row(kind, seq, label):
        return (at(0), at(60), kind, seq, "k", label, "p", "n", 1, 2.0 if kind == "classifier" else None, "d")

    rows = spark.createDataFrame([row("classifier", None, "old"), row("classifier", 1, "new"), row("narrative", None, "only")], RESULT)
    latest = {r["kind"]: r["overall_sentiment"] for r in latest_per_window(rows).collect()}
    assert latest == {"classifier": "new", "narrative": "only"}
    pair = compare_windows(rows).collect()
    assert [(r["classifier_sentiment"], r["narrative_sentiment"]) for r in pair] == [("new", "only")]
    assert unmatched_windows(rows).count() == 0


def test_uneven_rollups_raise(spark):
    columns = "win_start timestamp, win_end timestamp, message_count long, sentence_count long, score_sum long, max_score int, min_score int, most_positive string, most_negative string"
    rows = spark.createDataFrame([(at(60 * i), at(60 * i + 60), 1, 1, 2, 2, 2, None, None) for i in range(6)], columns)
    assert sorted(r["message_count"] for r in rollup_windows(rows, "3 minutes").collect()) == [3, 3]
    with pytest.raises(Exception, match="reaches over the end"):
        rollup_windows(rows, "90 seconds").collect()


def test_outages_follow_the_window_not_its_size():
    call = offline_client_factory()()

    def ask(minute, size=1):
        prompt = f"Window Start: 01/01/2024 00:{minute:02d}:00\nWindow End: x\nMessages Processed: 3\n" + "x" * size
        return json.loads(call(json.dumps({"messages": [{}, {"content": prompt}]})))["choices"][0]["message"]["content"]

    assert json.loads(ask(0, 1_000_000))["messageCount"] == 3 and not ask(4).startswith("{")
    with pytest.raises(OSError):
        ask(7)
