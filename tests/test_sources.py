import json

from pyspark.sql import functions as F

from chatpulse.config import KafkaSettings
from chatpulse.operators.lines import channel_events, format_lines, parse_lines
from chatpulse.session import checkpoint_root, stream_settings
from chatpulse.sources import readers
from chatpulse.schemas import MESSAGE
from chatpulse.sources.readers import chat_events, message_table, text_lines
from chatpulse.sources.tables import event_messages
from chatpulse.sources.writers import both, table_sink, write_lines


def test_events_become_lines_and_messages_again(spark, tmp_path):
    events = [
        {"type": "message", "channel": "C1", "ts": "1721903155.837829", "user": "U1", "text": "Hi, all: there", "more": 1},
        {"type": "message", "channel": "C2", "ts": "2.0", "user": "U2", "text": "elsewhere"},
        {"type": "joined", "channel": "C1", "ts": "3.0", "user": "U3"},
    ]
    (tmp_path / "events.json").write_text("\n".join(map(json.dumps, events)))
    feed = chat_events(spark, str(tmp_path / "events.json"))
    lines = str(tmp_path / "lines")
    write_lines(format_lines(channel_events(feed, "C1")), lines)
    row, = parse_lines(text_lines(spark, lines)).collect()
    assert (row.event_time, row.user, row.message) == (1721903155, "U1", "Hi, all: there")


def test_other_line_separators_keep_line_breaks_in_messages(spark, tmp_path):
    (tmp_path / "lines").write_text("Timestamp: 1, User: U1, Message: a\nb\0Timestamp: 2, User: U1, Message: c")
    rows = parse_lines(text_lines(spark, str(tmp_path / "lines"), line_sep="\0")).orderBy("event_time").collect()
    assert [r.message for r in rows] == ["a\nb", "c"]


def test_stored_messages_have_the_declared_type(spark, tmp_path):
    path = str(tmp_path / "messages")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    event_messages(events).write.parquet(path)
    stored = message_table(spark, path)
    assert stored.schema == MESSAGE
    assert sorted(stored.collect()) == sorted(event_messages(events).collect())


def test_repeated_batch_replaces_its_rows(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    sink = both(table_sink(one), table_sink(two))
    sink(spark.range(3), 0)
    sink(spark.range(5), 1)
    sink(spark.range(5), 1)
    for path in (one, two):
        counts = spark.read.parquet(path).groupBy("batch_id").count().orderBy("batch_id").collect()
        assert [(r.batch_id, r["count"]) for r in counts] == [(0, 3), (1, 5)]


class RecordingReader:
    def __init__(self, frame):
        self.frame, self.options = frame, {}

    def format(self, name):
        self.options["format"] = name
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self.frame


def test_both_result_topics_are_read_from_the_start(spark, monkeypatch):
    records = spark.range(1).select(
        F.lit(b"{}").alias("value"), F.current_timestamp().alias("timestamp"), F.lit(0).alias("partition"),
        F.lit(0).alias("offset"), F.lit("t").alias("topic"),
    )
    reader = RecordingReader(records)
    monkeypatch.setattr(readers, "_reader", lambda spark, streaming: reader)
    feed = readers.result_topics(spark, KafkaSettings(classifier_topic="a", narrative_topic="b"))
    assert feed.columns == ["value", "arrival", "partition", "offset", "topic"]
    assert feed.schema["value"].dataType.simpleString() == "string"
    assert (reader.options["subscribe"], reader.options["startingOffsets"]) == ("a,b", "earliest")
    readers.kafka_lines(spark, KafkaSettings())
    assert reader.options["subscribe"] == "slack_messages"
    assert reader.options["kafka.bootstrap.servers"] == "kafka:9092"


def test_checkpoint_folder_comes_from_the_session(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stream_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with stream_settings(spark, 3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
