"""States of windows merged to longer spans, against direct computation."""

import random

import pytest
from pyspark.sql import functions as F

from chatpulse.config import WindowPlan
from chatpulse.functions.sentiment import ENGLISH_LEXICON, lexicon_scorer
from chatpulse.operators.rollups import merge_states, state_histogram, state_summary, window_states
from chatpulse.operators.scoring import class_histogram, score_messages
from chatpulse.operators.windows import assign_windows
from chatpulse.plans.branches import unlimited_summary
from tests.helpers import at, messages

ENGLISH = lexicon_scorer(ENGLISH_LEXICON)
WORDS = ["good", "fantastic", "bad", "awful", "plain", ""]


def rows_of(frame, columns):
    return sorted(str(tuple(r)) for r in frame.select(*columns).collect())


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(4)
    rows = [(i * 7, ". ".join(rng.choice(WORDS) for _ in range(rng.randrange(5))) + f" {i}") for i in range(1500)]
    keyed = messages(spark, rows).withColumn("channel", F.when(F.col("seq") % 3 > 0, F.concat(F.lit("C"), F.col("seq") % 3)))
    return keyed.repartition(4)


@pytest.mark.parametrize("keys", [(), ("channel",)])
@pytest.mark.parametrize("span, slide", [("1 minute", None), ("1 hour", None), ("1 day", None), ("15 minutes", "5 minutes")])
def test_merged_states_equal_direct_windows(frame, keys, span, slide):
    plan = WindowPlan(keys=keys)
    merged = merge_states(window_states(assign_windows(frame, plan), ENGLISH, plan), span, slide, plan)
    long = WindowPlan(keys=keys, duration=span)
    if slide:
        windowed = frame.withColumn("_span", F.window("arrival", span, slide))
        windowed = windowed.withColumns({"win_start": F.col("_span.start"), "win_end": F.col("_span.end")}).drop("_span")
        direct = window_states(windowed, ENGLISH, long)
        wanted = state_summary(direct, long)
    else:
        windowed = assign_windows(frame, long)
        wanted = unlimited_summary(frame, ENGLISH, long)
    found = state_summary(merged, plan)
    assert dict(found.dtypes) == dict(wanted.dtypes)
    assert rows_of(found, wanted.columns) == rows_of(wanted, wanted.columns)
    histogram = class_histogram(score_messages(windowed, ENGLISH), long.group)
    assert rows_of(state_histogram(merged, plan), histogram.columns) == rows_of(histogram, histogram.columns)


def test_merging_in_steps_is_merging_at_once(frame):
    states = window_states(assign_windows(frame), ENGLISH)
    steps = merge_states(merge_states(merge_states(states, "5 minutes"), "30 minutes"), "2 hours")
    once = merge_states(states, "2 hours")
    assert rows_of(steps, once.columns) == rows_of(once, once.columns)


def test_quantiles_are_exact(spark):
    texts = {0: "awful. bad. plain. good. fantastic", 1: "awful. awful. bad", 2: "", 3: "good"}
    frame = messages(spark, [(60 * m, t) for m, t in texts.items()])
    states = window_states(assign_windows(frame), ENGLISH)
    shares = {"least": 0.0, "third": 1 / 3, "median": 0.5, "most": 1.0}
    found = {r.win_start: (r.least, r.third, r.median, r.most) for r in state_summary(states, quantiles=shares).collect()}
    assert found == {at(0): (0, 1, 2, 4), at(60): (0, 0, 0, 1), at(120): (None,) * 4, at(180): (3, 3, 3, 3)}
    with pytest.raises(ValueError):
        state_summary(states, quantiles={"x": 1.5})


def test_uneven_spans_wide_orders_and_empty_tables(spark, frame):
    states = window_states(assign_windows(frame, WindowPlan(duration="7 minutes")), ENGLISH)
    with pytest.raises(Exception, match="reaches over the end"):
        merge_states(states, "10 minutes").collect()
    with pytest.raises(ValueError):
        window_states(assign_windows(frame), ENGLISH, WindowPlan(order=("arrival", "user")))
    assert state_summary(merge_states(window_states(assign_windows(frame.where("false")), ENGLISH), "1 hour")).count() == 0
