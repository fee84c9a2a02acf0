"""Lines parsed once: both kinds, counts, the rule that stops a stream."""

import pytest

from chatpulse.operators.lines import parse_lines, quarantine_lines, tagged_lines
from chatpulse.sources.files import child_names, expire_batches
from chatpulse.sources.writers import table_sink
from chatpulse.streaming.lines import StopRule, TooManyDamagedLines, split_lines, start_lines
from tests.helpers import plan_text

LINES = [
    "Timestamp: 1721903155.837829, User: U1, Message: Fantastic!", "Timestamp: x, User: U1, Message: a", "Timestamp: 1, User: , Message: a",
    "Timestamp: 1, User: U2", "", None, "Timestamp: 2, User: U2, Message: a, b: c", "Timestamp: 3, User: U3, Message: ",
]


def lines_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "seq long, value string")


def texts(frame):
    return sorted(str(tuple(r)) for r in frame.select(*sorted(frame.columns)).collect())


def test_one_pass_gives_both_kinds(spark, tmp_path):
    frame = lines_of(spark, LINES)
    good, damaged = split_lines(frame, str(tmp_path / "lines"))
    assert texts(good) == texts(parse_lines(frame)) and texts(damaged) == texts(quarantine_lines(frame))
    assert good.count() + damaged.count() == len(LINES)
    frame.write.parquet(str(tmp_path / "stored"))
    plan = plan_text(tagged_lines(spark.read.parquet(str(tmp_path / "stored"))))
    assert plan.count("Scan parquet") == 1 and "Exchange" not in plan
    empty = split_lines(frame.where("false"), str(tmp_path / "none"), StopRule(0.0, 0))
    assert [f.count() for f in empty] == [0, 0]


def test_the_rule(spark, tmp_path):
    frame = lines_of(spark, LINES)
    with pytest.raises(TooManyDamagedLines, match="5 of 8 lines are damaged: timestamp 3, user 1, message 1"):
        split_lines(frame, str(tmp_path / "a"), StopRule(0.6, 8))
    split_lines(frame, str(tmp_path / "b"), StopRule(0.625, 8))
    split_lines(frame, str(tmp_path / "c"), StopRule(0.1, 9))


def test_a_stream_counts_and_stops(spark, tmp_path):
    source, work = str(tmp_path / "in"), str(tmp_path / "work")
    counts = {}

    def start(rule):
        stream = spark.readStream.schema("seq long, value string").option("maxFilesPerTrigger", 1).parquet(source)
        return start_lines(
            stream, work, table_sink(f"{work}/good"), table_sink(f"{work}/damaged"), rule,
            lambda found, batch: counts.update({batch: found}), trigger=None,
        )

    lines_of(spark, LINES[:1] * 10 + LINES[1:2]).coalesce(1).write.mode("append").parquet(source)
    lines_of(spark, LINES).coalesce(1).write.mode("append").parquet(source)
    query = start(StopRule(0.2, 5))
    with pytest.raises(Exception, match="5 of 8 lines are damaged"):
        query.awaitTermination()
    assert counts[0] == {"lines": 11, "timestamp": 1, "user": 0, "message": 0}
    assert counts[1] == {"lines": 8, "timestamp": 3, "user": 1, "message": 1}
    assert spark.read.parquet(f"{work}/good").count() == 10 and spark.read.parquet(f"{work}/damaged").count() == 6
    query = start(None)  # once the rule is lifted, the batch runs again
    query.awaitTermination()
    assert query.exception() is None
    assert spark.read.parquet(f"{work}/good").count() == 13 and spark.read.parquet(f"{work}/damaged").count() == 6


def test_old_batches_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in (0, 5, 9, 10):
        table_sink(path)(spark.range(1), batch)
    assert expire_batches(spark, path, 9) == 2 and expire_batches(spark, path, 9) == 0
    assert sorted(child_names(spark, path)) == ["batch_id=10", "batch_id=9"]
    assert expire_batches(spark, str(tmp_path / "nothing"), 5) == 0
