"""The live comparison against the one over tables, in any order of arrival."""

import random

import pytest
from pyspark.sql import functions as F

from chatpulse.config import WindowPlan
from chatpulse.functions.sentiment import ENGLISH_LEXICON, lexicon_scorer
from chatpulse.operators.comparison import compare_windows, read_results, unmatched_windows
from chatpulse.plans.branches import unlimited_summary
from chatpulse.sources.readers import KAFKA_ORDER, line_table, result_table
from chatpulse.sources.writers import table_sink
from chatpulse.streaming.jobs import start_live, start_unlimited
from chatpulse.streaming.merge import COMPARED, last_changes
from tests.helpers import at, messages
from tests.test_comparison import classifier, feed, narrative

ENGLISH = lexicon_scorer(ENGLISH_LEXICON)
END = (600, 0, classifier(count=0))


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def live(spark, tmp_path, batches, delay="300 minutes"):
    """Changes after one run per batch of ``(minute, seq, value)`` rows, each a restart."""
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    for batch in batches:
        feed(spark, batch).coalesce(1).write.mode("append").parquet(source)
        results = read_results(result_table(spark, source, streaming=True))
        run(start_live(results, work, table_sink(f"{work}/changes"), delay=delay, trigger=None, partitions=4))
    return spark.read.parquet(f"{work}/changes")


def texts(frame, columns):
    return sorted(str(tuple(r)) for r in frame.select(*columns).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_gives_what_the_tables_give(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = []
    for minute in range(40):
        for make in (classifier, narrative):
            for seq in rng.sample(range(50), rng.choice([0, 1, 1, 2, 4])):
                rows.append((minute, seq, make(count=seq, negative=rng.choice(["", "bad", "N/A"]))))
        if rng.random() < 0.2:
            rows.append((minute, 99, "no json"))
    rng.shuffle(rows)
    batches = [rows[i::3] for i in range(3)] + [[END]]
    found = last_changes(live(spark, tmp_path, batches))
    results = read_results(feed(spark, rows))
    bounds = ["win_start", "win_end"]
    assert texts(found.where("missing IS NULL"), [*bounds, *COMPARED]) == texts(compare_windows(results), [*bounds, *COMPARED])
    assert texts(found.where("missing IS NOT NULL"), [*bounds, "missing"]) == texts(unmatched_windows(results), [*bounds, "missing"])
    assert found.count() > 25


def test_a_change_is_sent_once(spark, tmp_path):
    batches = [
        [(0, 1, classifier(count=1))],
        [(0, 1, narrative())],  # both are there
        [(0, 1, narrative()), (0, 1, classifier(count=1))],  # once more
        [(0, 2, classifier(count=1))],  # newer, but the same
        [(0, 1, classifier(count=7))],  # older
        [(0, 3, classifier(count=3)), (0, 4, classifier(count=4))],
        [(1, 1, narrative())],
        [END],
    ]
    changes = live(spark, tmp_path, batches).orderBy("win_start", "change").collect()
    assert [(r.win_start, r.change, r.missing, r.classifier_count) for r in changes] == [
        (at(0), 0, None, 1), (at(0), 1, None, 4), (at(60), 0, "classifier", None),
    ]


def test_a_window_waits_for_so_long_and_is_closed(spark, tmp_path):
    batches = [
        [(0, 1, classifier()), (5, 1, classifier())],
        [(20, 1, narrative())],  # more than ten minutes on: both are told
        [(0, 1, narrative()), (20, 1, classifier())],  # too late for the first one
        [END],
    ]
    changes = live(spark, tmp_path, batches, delay="10 minutes").collect()
    assert sorted((r.win_start, r.missing) for r in changes if r.missing) == [(at(0), "narrative"), (at(300), "narrative")]
    assert [r.win_start for r in changes if not r.missing] == [at(1200)]


def test_keys_and_several_order_columns(spark, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    plan = WindowPlan(keys=("channel",))
    rows = [(0, 0, classifier(count=1)), (0, 1, classifier(count=2)), (0, 2, narrative()), (600, 0, classifier())]
    frame = feed(spark, rows).withColumns({"partition": F.lit(0), "offset": F.col("seq"), "arrival": F.col("win_end")})
    frame = frame.crossJoin(spark.createDataFrame([("a",), ("b",), (None,)], "channel string")).drop("seq")
    frame = frame.where("NOT (channel <=> 'b' AND value LIKE '%descriptive%')")
    frame.coalesce(1).write.parquet(source)
    results = read_results(line_table(spark, source, frame.schema, streaming=True))
    run(start_live(results, work, table_sink(f"{work}/out"), plan, "60 minutes", None, partitions=4, seq=KAFKA_ORDER))
    found = last_changes(spark.read.parquet(f"{work}/out"), plan).collect()
    assert sorted((str(r.channel), r.missing, r.classifier_count) for r in found if r.win_start == at(0)) == [
        ("None", None, 2), ("a", None, 2), ("b", "narrative", None),
    ]


def test_totals_of_a_keyed_stream_with_empty_keys(spark, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    plan = WindowPlan(keys=("channel",))
    rows = [(i * 0.4, f"{['good', 'bad. good', 'plain', None, 'awful', 'Fantastic! bad'][i % 6]} {i}" if i % 6 != 3 else None) for i in range(600)]
    frame = messages(spark, rows).withColumn("channel", F.when(F.col("seq") % 4 > 0, F.concat(F.lit("C"), F.col("seq") % 4)))
    for part in frame.randomSplit([1.0] * 3, seed=5):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(source)
    # Files come in no order of time, so a window has to wait for all of them.
    end = frame.where("seq = 0").withColumn("arrival", F.col("arrival") + F.expr("INTERVAL 3 HOURS")).withColumn("channel", F.lit("end"))
    end.coalesce(1).write.mode("append").parquet(source)
    run(start_unlimited(stream, ENGLISH, work, table_sink(f"{work}/out"), plan, delay="1 hour", trigger=None, partitions=4))
    wanted = unlimited_summary(frame, ENGLISH, plan)
    found = spark.read.parquet(f"{work}/out")
    assert wanted.count() == 16 and dict(found.drop("batch_id").dtypes) == dict(wanted.dtypes)
    assert texts(found, wanted.columns) == texts(wanted, wanted.columns)
