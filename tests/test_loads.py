"""Full windows found in bounded space, and only they are dealt to several tasks."""

import random

import pandas as pd
from pyspark.sql import functions as F

from chatpulse.config import WindowPlan
from chatpulse.operators.loads import heavy_windows, keep_newest_by_load, trimmed
from chatpulse.operators.windows import assign_windows, keep_newest
from tests.helpers import at, messages, plan_text


def frame_of(spark, hot=3000, others=60, rows=10):
    data = [(i * 60 / hot, f"h{i}") for i in range(hot)] + [(60 * (1 + m) + s, f"m{s}") for m in range(others) for s in range(rows)]
    return messages(spark, data).withColumn("channel", F.when(F.col("seq") % 2 == 0, "C")).repartition(16)


def rows_of(frame):
    return sorted(str(tuple(r)) for r in frame.select(*sorted(frame.columns)).collect())


def test_full_windows_are_found(spark):
    windowed = assign_windows(frame_of(spark))
    found = heavy_windows(windowed, rows_per_shard=500).collect()
    assert [(r.win_start, r.shards) for r in found] == [(at(0), 6)]
    few = heavy_windows(windowed, rows_per_shard=200, counters=2).collect()
    assert [r.win_start for r in few] == [at(0)] and 8 <= few[0].shards <= 15
    assert heavy_windows(windowed, rows_per_shard=10_000).count() == 0
    assert heavy_windows(windowed.where("false")).count() == 0
    keyed = WindowPlan(keys=("channel",))
    assert {(r.channel, r.shards) for r in heavy_windows(windowed, keyed, 500).collect()} == {(None, 3), ("C", 3)}


def test_counts_are_lower_bounds_and_large_ones_stay():
    rng = random.Random(2)
    truth, held, seen = pd.Series(dtype="int64"), pd.Series(dtype="int64"), 0
    for _ in range(200):
        batch = pd.Series([rng.choice("abc") if rng.random() < 0.6 else rng.randrange(5000) for _ in range(50)]).value_counts()
        seen += 50
        truth = truth.add(batch, fill_value=0)
        held = trimmed(held.add(batch, fill_value=0).astype("int64"), 20)
        assert len(held) <= 20 and (held <= truth[held.index]).all()
    assert set("abc") <= set(held.index) and all(truth[k] - held[k] <= seen / 21 for k in "abc")


def test_the_same_rows_stay(spark):
    frame = frame_of(spark)
    for plan in (WindowPlan(limit=7), WindowPlan(limit=7, keys=("channel",))):
        windowed = assign_windows(frame, plan)
        wanted = rows_of(keep_newest(windowed, plan))
        for least in (100, 10_000):
            assert rows_of(keep_newest_by_load(windowed, heavy_windows(windowed, plan, least), plan)) == wanted


def test_small_windows_are_shuffled_once(spark):
    plan = WindowPlan(limit=5)
    windowed = assign_windows(frame_of(spark), plan)
    none = keep_newest_by_load(windowed, heavy_windows(windowed, plan, 10_000), plan)
    assert plan_text(none).count("Exchange hashpartitioning") == 1
    some = keep_newest_by_load(windowed, heavy_windows(windowed, plan, 500), plan)
    text = plan_text(some)
    assert text.count("Exchange hashpartitioning") == 2 and text.count("Exchange hashpartitioning(win_start") == 2
    assert text.count("_shard#") > 0 and "BroadcastExchange" in text
    # All windows dealt to shards: every small row is shuffled twice. Now only those of the full window are.
    assert plan_text(keep_newest(windowed, plan)).count("Exchange hashpartitioning") == 2
    shuffled_twice = windowed.join(heavy_windows(windowed, plan, 500), plan.group, "left_semi").count()
    assert shuffled_twice == 3000 and windowed.count() == 3600
