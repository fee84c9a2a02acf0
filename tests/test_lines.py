import datetime as dt

import pytest
from pyspark.sql import functions as F

from chatpulse.functions.lines import epoch_text, whole_seconds
from chatpulse.operators.lines import channel_events, format_lines, parse_lines, quarantine_lines

GOOD = [
    ("Timestamp: 1721903155.837829, User: U07DET2KZ2B, Message: Fantastic!", (1721903155, "U07DET2KZ2B", "Fantastic!")),
    ("Timestamp: 1.9, User: U1, Message: a, b: c, User: d", (1, "U1", "a, b: c, User: d")),
    ("Timestamp: -1.9, User: U1, Message: two\nlines\n", (-1, "U1", "two\nlines\n")),
    ("Timestamp: 1e3, User: U1, Message: ", (1000, "U1", "")),
    ("Timestamp: 5: x, User: U1: y, Message: z", (5, "U1", "z")),
    ("a: 5, b: U1, c: z", (5, "U1", "z")),
    ("Timestamp: 7, User: : U1, Message: z", (7, "", "z")),
    ("Timestamp: NaN, User: U1, Message: z", (0, "U1", "z")),
    ("Timestamp: Infinity, User: U1, Message: z", (9223372036854775807, "U1", "z")),
]
BAD = [
    ("", "timestamp"),
    ("no fields at all", "timestamp"),
    ("Timestamp: , User: U1, Message: z", "timestamp"),
    ("Timestamp: soon, User: U1, Message: z", "timestamp"),
    ("Timestamp: inf, User: U1, Message: z", "timestamp"),
    ("Timestamp: 5, User: , Message: z", "user"),
    ("Timestamp: 5, User: : : , Message: z", "user"),
    ("Timestamp: 5", "user"),
    ("Timestamp: 5, User: U1", "message"),
    ("Timestamp: 5, User: U1, Message", "message"),
    (None, "timestamp"),
]


def frame(spark, lines):
    return spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "seq long, value string")


def test_well_formed_lines(spark):
    lines = frame(spark, [line for line, _ in GOOD])
    rows = parse_lines(lines).orderBy("seq").collect()
    assert [(r.event_time, r.user, r.message) for r in rows] == [expected for _, expected in GOOD]
    assert quarantine_lines(lines).count() == 0


def test_malformed_lines_are_set_aside(spark):
    lines = frame(spark, [line for line, _ in BAD])
    assert parse_lines(lines).count() == 0
    rows = quarantine_lines(lines).orderBy("seq").collect()
    assert [(r.value, r.reason) for r in rows] == BAD


def test_strict_mode_fails_the_job(spark):
    assert parse_lines(frame(spark, [GOOD[0][0]]), strict=True).count() == 1
    with pytest.raises(Exception, match="malformed line: Timestamp: 5"):
        parse_lines(frame(spark, [GOOD[0][0], "Timestamp: 5"]), strict=True).collect()


def test_undecodable_bytes_become_replacement_characters(spark):
    raw = b"Timestamp: 5, User: U1, Message: caf\xc3\xa9 \xff!"
    lines = spark.createDataFrame([(bytearray(raw),)], "value binary")
    assert parse_lines(lines).first().message == "café �!"


def test_format_then_parse_gives_the_event_back(spark):
    when = dt.datetime(2024, 7, 25, 10, 25, 55, 37)
    events = spark.createDataFrame([(when, "U1", "a, b: c"), (when, None, None)], "at timestamp, user string, text string")
    lines = format_lines(events.withColumn("ts", epoch_text(F.col("at"))))
    values = [r.value for r in lines.collect()]
    assert values == [
        "Timestamp: 1721903155.000037, User: U1, Message: a, b: c",
        "Timestamp: 1721903155.000037, User: null, Message: null",
    ]
    assert parse_lines(lines).first().message == "a, b: c"


def test_only_messages_of_the_channel_pass(spark, tmp_path):
    rows = [("message", "C1", "x"), ("message", "C2", "y"), ("reaction", "C1", "z"), (None, "C1", "n")]
    path = str(tmp_path / "events")
    spark.createDataFrame(rows, "type string, channel string, text string").write.parquet(path)
    kept = channel_events(spark.read.parquet(path), "C1")
    assert [r.text for r in kept.collect()] == ["x"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(channel,C1)" in plan and "EqualTo(type,message)" in plan


def test_seconds_are_null_for_null(spark):
    assert spark.range(1).select(whole_seconds(F.lit(None).cast("string")).alias("s")).first().s is None
