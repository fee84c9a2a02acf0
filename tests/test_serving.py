"""The keyed table of results: replaced rows, versions, compaction."""

import os

import pytest
from pyspark.sql import functions as F

from chatpulse.operators.comparison import read_results
from chatpulse.sources.files import child_names, publish_text, read_text
from chatpulse.sources.readers import result_table
from chatpulse.sources.serving import Conflict, ServingTable, Version
from chatpulse.streaming.jobs import start_served
from tests.helpers import at
from tests.test_comparison import classifier, feed, narrative

SCHEMA = "win_start timestamp, kind string, seq long, message_count long"


def rows(spark, *data):
    """``(minute, kind, seq, count)``"""
    return spark.createDataFrame([(at(60 * m) if m is not None else None, k, s, c) for m, k, s, c in data], SCHEMA)


def table_of(spark, path, **settings):
    return ServingTable(spark, str(path), rows(spark).schema, ["win_start", "kind"], **settings)


def content(table, version=None):
    return sorted(((r.win_start, r.kind), r.seq, r.message_count) for r in table.read(version).collect())


def files(path):
    return sum(len([n for n in names if n.endswith(".parquet")]) for _, _, names in os.walk(path))


def test_later_results_replace_earlier_ones_whenever_they_come(spark, tmp_path):
    table = table_of(spark, tmp_path, compact_after=2)
    write = table.sink()
    assert content(table) == []
    write(rows(spark, (0, "a", 5, 50), (0, "b", 1, 10), (1, "a", 2, 20)), 0)
    write(rows(spark, (0, "a", 3, 30), (1, "a", 9, 90), (1, "a", 8, 80)), 1)  # one comes late
    write(rows(spark), 2)
    write(rows(spark, (3000, "a", None, 1)), 3)
    write(rows(spark, (3000, "a", 0, 2), (None, "a", 1, 7)), 4)
    wanted = [((at(0), "a"), 5, 50), ((at(0), "b"), 1, 10), ((at(60), "a"), 9, 90), ((at(180_000), "a"), 0, 2)]
    assert [r for r in sorted(((r.win_start, r.kind), r.seq, r.message_count) for r in table.read().where("win_start IS NOT NULL").collect())] == wanted
    assert [(r.seq, r.message_count) for r in table.read().where("win_start IS NULL").collect()] == [(1, 7)]
    assert table.version().batches == {"main": 4}


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    table = table_of(spark, tmp_path, compact_after=2)
    write, other = table.sink(), table.sink("other")
    for batch in range(3):
        write(rows(spark, (batch, "a", batch, batch)), batch)
        before = table.version()
        write(rows(spark, (batch, "a", 99, 99)), batch)
        assert table.version() == before
    other(rows(spark, (0, "a", 7, 7)), 0)
    assert [r[1:] for r in content(table)] == [(7, 7), (1, 1), (2, 2)]
    # A folder that was written but never published is replaced when the batch runs again.
    rows(spark, (0, "a", 1000, 0)).write.parquet(f"{tmp_path}/delta/main-3")
    assert [r[1:] for r in content(table)] == [(7, 7), (1, 1), (2, 2)]
    write(rows(spark, (5, "a", 1, 1)), 3)
    assert [r[1:] for r in content(table)] == [(7, 7), (1, 1), (2, 2), (1, 1)]


def test_readers_see_one_version_while_it_is_compacted(spark, tmp_path):
    table = table_of(spark, tmp_path, compact_after=100)
    write = table.sink()
    for batch in range(3):
        write(rows(spark, (0, "a", batch, batch), (1500 * batch, "b", batch, batch)), batch)
    version = table.version()
    opened = table.read()
    table.compact()
    write(rows(spark, (0, "a", 50, 50)), 3)
    after = table.version()
    assert not version.segments and len(after.segments) == 3 and [name for name, _ in after.deltas] == ["main-3"]
    assert sorted((r.kind, r.seq) for r in opened.collect()) == [("a", 2), ("b", 0), ("b", 1), ("b", 2)]
    assert content(table, version)[0][1:] == (2, 2) and content(table)[0][1:] == (50, 50)
    # Untouched segments keep their folder.
    table.compact()
    now = table.version().segments
    assert {s for s in now if now[s] != after.segments[s]} == {"2024-01-01"}


def test_untouched_segments_are_read_without_a_shuffle(spark, tmp_path):
    table = table_of(spark, tmp_path, compact_after=1)
    table.sink()(rows(spark, (0, "a", 1, 1), (5000, "a", 1, 1)), 0)
    assert "Exchange" not in table.read()._jdf.queryExecution().executedPlan().toString()


def test_number_of_files_stays_bounded(spark, tmp_path):
    table = table_of(spark, tmp_path, compact_after=10, keep=3)
    write = table.sink()
    most = 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for batch in range(200):
            write(rows(spark, (batch % 7, "a", batch, batch), (batch % 11, "b", batch, batch)).coalesce(1), batch)
            if batch % 20 == 19:
                most = max(most, files(tmp_path))
                assert len(child_names(spark, f"{tmp_path}/manifest")) <= 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert most <= 40
    wanted = {(at(60 * (b % n)), k): b for n, k in ((7, "a"), (11, "b")) for b in range(200)}
    assert {key: seq for key, seq, _ in content(table)} == wanted


def test_writers_in_each_others_way(spark, tmp_path):
    table = table_of(spark, tmp_path)
    for batch in range(2):
        table.sink()(rows(spark, (0, "a", batch, batch)), batch)
    slow, numbers = table.version(), iter([True])

    def change(now):
        if next(numbers, False):  # another writer publishes first
            table.sink("other")(rows(spark, (9, "b", 1, 1)), 0)
        return Version(0, now.batches | {"slow": 1}, now.segments, now.deltas)

    published = table._publish(change)
    assert published.number == slow.number + 2 and published.batches == {"main": 1, "other": 0, "slow": 1}
    with pytest.raises(Conflict):
        table._publish(lambda now: publish_text(spark, table._manifest(now.number + 1), now.text()) and now, attempts=2)
    assert len(content(table)) == 2


def test_wrong_settings_and_small_files(spark, tmp_path):
    schema = rows(spark).schema
    for bad in ({"keys": ["kind"]}, {"keys": ["nothing", "win_start"]}, {"keys": ["win_start"], "compact_after": 0}):
        with pytest.raises(ValueError):
            ServingTable(spark, str(tmp_path), schema, **bad)
    path = f"{tmp_path}/x/é.json"
    assert publish_text(spark, path, "é" * 70_000) and not publish_text(spark, path, "other")
    assert read_text(spark, path) == "é" * 70_000 and child_names(spark, f"{tmp_path}/nothing") == []


def test_a_served_stream_goes_on_after_a_restart(spark, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    results = [(0, 0, classifier(count=1)), (0, 2, classifier(count=3)), (0, 1, classifier(count=2)), (0, 0, narrative()), (1, 5, narrative(count=8)), (2, 0, "no json")]
    table = None
    for i, row in enumerate(results):
        feed(spark, [row]).coalesce(1).write.mode("append").parquet(source)
        parsed = read_results(result_table(spark, source, streaming=True, files=1))
        table = ServingTable(spark, f"{work}/served", parsed.schema, ["win_start", "win_end", "kind"], compact_after=2)
        if i % 2:
            query = start_served(parsed, work, table, trigger=None)
            query.awaitTermination()
            assert query.exception() is None
    found = {(r.win_start, r.kind): (r.seq, r.message_count) for r in table.read().collect()}
    assert found == {(at(0), "classifier"): (2, 3), (at(0), "narrative"): (0, 5), (at(60), "narrative"): (5, 8)}
    assert table.read().columns == read_results(feed(spark, results)).columns
