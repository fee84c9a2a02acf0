import random

import pytest
from pyspark.sql import functions as F

from chatpulse.config import WindowPlan
from chatpulse.functions.packed import id_filter, packed_order
from chatpulse.functions.sentiment import ENGLISH_LEXICON, lexicon_scorer
from chatpulse.operators.scoring import message_stats, score_stats
from chatpulse.operators.summary import rollup_windows, summary_aggregates, window_summary, with_label
from chatpulse.operators.windows import assign_windows
from chatpulse.plans.branches import sentiment_branch, unlimited_numbers, unlimited_summary
from tests.helpers import at, messages, plan_text, scored

ENGLISH = lexicon_scorer(ENGLISH_LEXICON)


def summarise(spark, rows, **options):
    return window_summary(message_stats(assign_windows(scored(spark, rows))), **options)


@pytest.mark.parametrize(
    "rows, count, average, label, positive, negative",
    [
        ([("Fantastic!", [3])], 1, 3.0, "positive", "Fantastic!", None),
        ([("Fantastic!", [3]), ("Awful!", [1])], 2, 2.0, "neutral", "Fantastic!", "Awful!"),
        ([("Terrible!", [0]), ("Bad!", [1])], 2, 0.5, "negative", None, "Terrible!"),
        (
            [("This is okay.", [2]), ("It could be worse.", [2]), ("Awesome!", [4]), ("Terrible!", [1])],
            4, 2.25, "neutral", "Awesome!", "Terrible!",
        ),
        ([("This is confusing...", [2]), ("Great!", [4]), ("Terrible!", [1])], 3, 2.33, "neutral", "Great!", "Terrible!"),
        ([("first", [3]), ("higher", [4])], 2, 3.5, "very positive", "first", None),
        ([("", []), ("", [])], 2, 0.0, "very negative", None, None),
        ([("a", [4, 2, 3]), ("b", [3]), ("c", [4, 1])], 3, 2.83, "positive", "a", "c"),
    ],
)
def test_one_window(spark, rows, count, average, label, positive, negative):
    row = summarise(spark, [(i, text, scores) for i, (text, scores) in enumerate(rows)]).first()
    assert row.message_count == count
    assert row.average_score == average
    assert row.overall_sentiment == label
    assert (row.most_positive, row.most_negative) == (positive, negative)


def test_label_uses_the_exact_average(spark):
    rows = [(0, "x", [2] * 101 + [3] * 99)]
    row = summarise(spark, rows).first()
    assert (row.score_sum, row.average_score, row.overall_sentiment) == (499, 2.5, "neutral")


def test_true_extremes_pick_the_best_and_the_earliest_of_equals(spark):
    rows = [(0, "three", [3]), (1, "four", [4]), (2, "four again", [4]), (3, "one", [1]), (4, "zero", [0]), (5, "zero again", [0])]
    row = summarise(spark, rows, true_extremes=True).first()
    assert (row.most_positive, row.most_negative) == ("four", "zero")
    first = summarise(spark, rows).first()
    assert (first.most_positive, first.most_negative) == ("three", "one")


def test_no_messages_no_row(spark):
    assert sentiment_branch(messages(spark, []), ENGLISH).count() == 0


def test_single_message_window(spark):
    row = sentiment_branch(messages(spark, [(0, "Fantastic!")]), ENGLISH).first()
    assert (row.win_start, row.message_count, row.most_positive) == (at(0), 1, "Fantastic!")


def test_evicted_messages_do_not_count(spark):
    rows = [(0, "Fantastic!"), (0.5, "Terrible!")] + [(1 + i, "plain") for i in range(50)]
    row = sentiment_branch(messages(spark, rows), ENGLISH).first()
    assert (row.message_count, row.most_positive, row.most_negative) == (50, None, None)
    everything = unlimited_summary(messages(spark, rows), ENGLISH).first()
    assert (everything.message_count, everything.most_positive) == (52, "Fantastic!")


def brute_force(rows, width):
    windows = {}
    for second, text, scores in rows:
        windows.setdefault(int(second // width), []).append((second, text, scores))
    result = {}
    for start, members in windows.items():
        members.sort(key=lambda m: m[0])
        pooled = [s for _, _, scores in members for s in scores]
        positive = next((t for _, t, s in members if s and max(s) >= 2.5), None)
        negative = next((t for _, t, s in members if s and min(s) < 1.5), None)
        result[at(start * width)] = (len(members), len(pooled), sum(pooled), positive, negative)
    return result


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rolled_up_windows_equal_direct_ones(spark, seed):
    rng = random.Random(seed)
    rows = [
        (i * 2.5, f"m{i}", [rng.choice([0, 1, 2, 2, 2, 3, 4]) for _ in range(rng.randrange(4))]) for i in range(1500)
    ]
    minute = summarise(spark, rows)

    def plain(frame):
        return {
            r.win_start: (r.message_count, r.sentence_count, r.score_sum, r.most_positive, r.most_negative)
            for r in frame.collect()
        }

    assert plain(minute) == brute_force(rows, 60)
    hour = rollup_windows(minute, "1 hour")
    assert plain(hour) == brute_force(rows, 3600)
    direct = window_summary(message_stats(assign_windows(scored(spark, rows), WindowPlan(duration="1 hour"))))
    assert sorted(map(str, hour.collect())) == sorted(map(str, direct.select(hour.columns).collect()))


def test_keyed_windows(spark):
    plan = WindowPlan(keys=("channel",))
    frame = messages(spark, [(0, "good"), (1, "bad")]).withColumn("channel", F.concat(F.lit("C"), "seq"))
    rows = sentiment_branch(frame, ENGLISH, plan).orderBy("channel").collect()
    assert [(r.channel, r.average_score) for r in rows] == [("C0", 3.0), ("C1", 1.0)]


def test_aggregation_reuses_the_placement_of_the_limit(spark):
    plan = plan_text(sentiment_branch(messages(spark, [(0, "good")]), ENGLISH))
    assert plan.count("Exchange hashpartitioning") == 2


def test_unlimited_numbers_combine_before_their_only_shuffle(spark):
    frame, plan = messages(spark, [(0, "good")]), WindowPlan()
    text = plan_text(unlimited_numbers(frame, ENGLISH, plan, packed_order(frame, plan.order)))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text
    # No sort, and no text from the first combination on.
    assert "Sort" not in text and "ObjectHash" not in text and text.count("HashAggregate") == 2
    above = text[: text.rindex("HashAggregate")]
    assert "message#" not in above and "_scores" not in above


def test_unlimited_summary_equals_the_one_that_takes_texts_along(spark):
    rows = [(i * 1.5, f"{['good', 'bad. good', 'plain', '', 'awful', 'Fantastic! bad'][i % 6]} {i}") for i in range(500)]
    frame = messages(spark, rows).withColumn("channel", F.when(F.col("seq") % 3 > 0, F.concat(F.lit("C"), F.col("seq") % 3)))
    # The same arrivals and places in every channel.
    frame = frame.withColumn("seq", F.col("seq") - F.col("seq") % 3).withColumn("arrival", F.date_trunc("minute", "arrival"))
    for plan in (WindowPlan(keys=("channel",)), WindowPlan(keys=("channel",), order=("arrival", "user", "seq"))):
        found = unlimited_summary(frame, ENGLISH, plan)
        wanted = with_label(
            score_stats(assign_windows(frame, plan), ENGLISH).groupBy(*plan.group).agg(*summary_aggregates(plan))
        )
        assert found.columns == wanted.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect())) and wanted.count() > 30
    assert unlimited_summary(frame.where("false"), ENGLISH).count() == 0


def test_packed_places_sort_like_their_columns(spark):
    import datetime as dt

    instants = [dt.datetime(1950, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 1), dt.datetime(2024, 1, 1), dt.datetime(9999, 12, 31)]
    rows = [(t, n) for t in instants for n in (None, -(2**63), -1, 0, 5, 2**63 - 1)]
    frame = spark.createDataFrame(rows, "arrival timestamp, seq long")
    at = packed_order(frame, ("arrival", "seq"))
    found = frame.select("arrival", "seq", at.alias("at")).orderBy("at", "arrival", F.col("seq").asc_nulls_first()).collect()
    assert [(r.arrival, r.seq) for r in found] == sorted(rows, key=lambda r: (r[0], -(2**64) if r[1] is None else r[1]))
    assert packed_order(frame.withColumn("user", F.lit("x")), ("arrival", "user")) is None
    assert packed_order(frame, ("arrival", "arrival", "seq")) is None


def test_id_filter_holds_all_ids_and_few_others(spark):
    ids = spark.range(0, 300_000, 100)
    holds = id_filter(ids, "id")
    passed = spark.range(300_000).where(holds(F.col("id")))
    assert passed.join(ids, "id").count() == 3000 and passed.count() < 3100
    assert spark.range(1000).where(id_filter(ids.where("false"), "id")(F.col("id"))).count() == 0
    full = id_filter(ids, "id", bits=64)
    assert spark.range(1000).where(full(F.col("id"))).count() == 1000
