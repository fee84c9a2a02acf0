import random

import pytest
from pyspark.sql import functions as F

from chatpulse.config import SettingsError, WindowPlan
from chatpulse.operators.windows import assign_windows, keep_newest, tumbling_count
from chatpulse.plans.branches import kept_messages
from tests.helpers import at, messages, plan_text


def test_windows_are_aligned_and_half_open(spark):
    rows = assign_windows(messages(spark, [(0, "a"), (59.999, "b"), (60, "c")])).orderBy("seq").collect()
    assert [(r.win_start, r.win_end) for r in rows] == [(at(0), at(60)), (at(0), at(60)), (at(60), at(120))]


def test_offset_moves_the_bounds(spark):
    plan = WindowPlan(offset="30 seconds")
    rows = assign_windows(messages(spark, [(29, "a"), (30, "b")]), plan).orderBy("seq").collect()
    assert [r.win_start for r in rows] == [at(-30), at(30)]


def test_no_row_for_an_empty_window(spark):
    counts = tumbling_count(messages(spark, [(0, "a"), (1, "b"), (180, "c")])).orderBy("win_start").collect()
    assert [(r.win_start, r.message_count) for r in counts] == [(at(0), 2), (at(180), 1)]


@pytest.mark.parametrize("shards", [1, 5])
@pytest.mark.parametrize("size", [1, 49, 50, 51, 130])
def test_newest_fifty_of_a_window_stay(spark, size, shards):
    frame = messages(spark, [(i * 0.1, str(i)) for i in range(size)]).repartition(7)
    kept = kept_messages(frame, WindowPlan(shards=shards))
    assert sorted(r.seq for r in kept.collect()) == list(range(max(0, size - 50), size))


def test_equal_arrivals_are_ordered_by_sequence(spark):
    frame = messages(spark, [(1, str(i)) for i in range(9)]).repartition(4)
    kept = kept_messages(frame, WindowPlan(limit=3, shards=4))
    assert sorted(r.seq for r in kept.collect()) == [6, 7, 8]


def test_keys_split_the_windows(spark):
    frame = messages(spark, [(i, str(i)) for i in range(12)]).withColumn("channel", F.col("seq") % 2)
    kept = kept_messages(frame, WindowPlan(limit=2, keys=("channel",)))
    assert sorted((r.channel, r.seq) for r in kept.collect()) == [(0, 8), (0, 10), (1, 9), (1, 11)]


def test_one_window_with_most_rows_is_kept_exactly(spark):
    rng = random.Random(7)
    rows = [(rng.uniform(0, 60) if i % 3 else rng.uniform(60, 6000), str(i)) for i in range(6000)]
    frame = messages(spark, rows).repartition(16)
    kept = {r.seq for r in kept_messages(frame, WindowPlan(shards=4)).collect()}
    by_window = {}
    for seq, (second, _) in enumerate(rows):
        by_window.setdefault(int(second // 60), []).append((round(second, 6), seq))
    expected = {seq for members in by_window.values() for _, seq in sorted(members)[-50:]}
    assert kept == expected


def test_each_split_sends_at_most_the_limit(spark):
    plan = plan_text(kept_messages(messages(spark, [(1, "a")])))
    assert plan.count("WindowGroupLimit") == 4
    assert plan.count("Exchange hashpartitioning") == 2


def test_plan_settings_are_checked():
    for bad in ({"limit": 0}, {"shards": 0}, {"order": ()}):
        with pytest.raises(SettingsError):
            WindowPlan(**bad)


def test_rank_column_names_do_not_leak(spark):
    kept = keep_newest(assign_windows(messages(spark, [(1, "a")])))
    assert kept.columns == ["arrival", "seq", "user", "message", "win_start", "win_end"]
