import pandas as pd
import pytest
from pyspark.sql import functions as F

from chatpulse.functions.sentiment import ENGLISH_LEXICON, label_of, lexicon_scorer
from chatpulse.operators.scoring import (
    class_histogram,
    message_stats,
    score_messages,
    score_stats,
    score_with_lexicon_table,
    sentence_rows,
)
from chatpulse.schemas import SENTENCE_SCORES
from chatpulse.sources.tables import lexicon_table
from tests.helpers import messages, plan_text

ENGLISH = lexicon_scorer(ENGLISH_LEXICON)


@pytest.mark.parametrize(
    "text, name",
    [
        ("Fantastic!", "Very positive"),
        ("Good job!", "Positive"),
        ("It's so-so.", "Neutral"),
        ("This is bad.", "Negative"),
        ("Terrible!", "Very negative"),
    ],
)
def test_class_of_one_sentence(spark, text, name):
    sentences = score_messages(messages(spark, [(0, text)]), ENGLISH).first().sentences
    assert [s["class"] for s in sentences] == [name]


@pytest.mark.parametrize("text", ["", None, "   ", "...", "\n"])
def test_blank_text_has_no_sentences(spark, text):
    row = message_stats(score_messages(messages(spark, [(0, text)]), ENGLISH)).first()
    assert (row.sentence_count, row.score_sum, row.max_score, row.min_score) == (0, 0, None, None)


def test_scorer_is_required(spark):
    with pytest.raises(ValueError, match="no scorer"):
        score_messages(messages(spark, [(0, "x")]), None)


def test_sentences_keep_their_order_and_stop_at_the_ends(spark):
    text = "good GOOD good good! bad, awful, terrible? plain\ngoodness"
    rows = sentence_rows(score_messages(messages(spark, [(0, text)]), ENGLISH)).orderBy("sentence").collect()
    assert [(r.sentence, r.score) for r in rows] == [(0, 4), (1, 0), (2, 2), (3, 2)]


def test_words_of_any_number_score_alike(spark):
    short = {"good": 1, "bad": -1, "awful": -2}
    filler = {f"filler{chr(97 + i)}": 1 for i in range(26)}
    frame = messages(spark, [(0, "good, bad. awful good"), (1, "goods. badly bad"), (2, "été good")])
    wanted = message_stats(score_messages(frame, lexicon_scorer(short))).orderBy("seq").collect()
    found = message_stats(score_messages(frame, lexicon_scorer({**short, **filler}))).orderBy("seq").collect()
    assert found == wanted


def test_stats_do_not_depend_on_the_way(spark):
    frame = messages(spark, [(0, "Good. bad! Terrible"), (1, ""), (2, None), (3, " .\n\t. x")])

    def plug_in(text):
        return ENGLISH(text)

    wanted = message_stats(score_messages(frame, ENGLISH)).orderBy("seq").collect()
    for scorer in (ENGLISH, plug_in):
        assert score_stats(frame, scorer).orderBy("seq").collect() == wanted
    with pytest.raises(ValueError, match="no scorer"):
        score_stats(frame, None)


@pytest.mark.parametrize("threshold, join", [("10MB", "BroadcastHashJoin"), ("-1", "SortMergeJoin")])
def test_lexicon_table_scores_like_the_literal_lexicon(spark, threshold, join):
    texts = ["Good. Bad good! Terrible", "", None, " . ", "nothing here", "!good", "awful awful. great", "12. 3"]
    frame = messages(spark, list(enumerate(texts)))
    columns = ["seq", "sentence_count", "score_sum", "max_score", "min_score"]
    wanted = message_stats(score_messages(frame, ENGLISH)).select(columns).orderBy("seq").collect()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = score_with_lexicon_table(frame, lexicon_table(spark, ENGLISH_LEXICON)).select(columns)
        assert join in plan_text(found)
        assert found.orderBy("seq").collect() == wanted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_model_as_pandas_udf_plugs_in(spark):
    @F.pandas_udf(SENTENCE_SCORES)
    def by_length(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"score": min(4, len(t)), "class": "x"}])

    rows = message_stats(score_messages(messages(spark, [(0, "a"), (1, "abcdef")]), by_length)).orderBy("seq").collect()
    assert [r.max_score for r in rows] == [1, 4]


def test_class_histogram(spark):
    frame = messages(spark, [(0, "Good. Good"), (1, "bad"), (2, "")]).withColumn("win_start", F.lit(1))
    rows = class_histogram(score_messages(frame, ENGLISH), ["win_start"]).collect()
    assert {(r["class"], r.sentences) for r in rows} == {("Positive", 2), ("Negative", 1)}


@pytest.mark.parametrize("weights", [{}, {"x": 0}])
def test_unusable_lexicons_are_refused(weights):
    with pytest.raises(ValueError):
        lexicon_scorer(weights)


@pytest.mark.parametrize(
    "average, label",
    [
        (0.0, "very negative"), (0.4999, "very negative"), (0.5, "negative"), (1.4999, "negative"),
        (1.5, "neutral"), (2.4999, "neutral"), (2.5, "positive"), (3.4999, "positive"), (3.5, "very positive"),
    ],
)
def test_label_floors(spark, average, label):
    assert spark.range(1).select(label_of(F.lit(average)).alias("l")).first().l == label
