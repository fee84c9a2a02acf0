"""Session set-up shared by jobs, tests and the bench."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Every timestamp in this package is an instant; only formatting uses another zone.
SESSION_ZONE = "UTC"

#: What Spark hands a Python task at a time, in bytes, where whole messages or prompts go to one.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
SMALL_BATCH = 4 << 20

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "chatpulse", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs count on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": SESSION_ZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_zone(spark: SparkSession) -> SparkSession:
    if spark.conf.get("spark.sql.session.timeZone") != SESSION_ZONE:
        spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
    return spark


def _small_batch(spark: SparkSession) -> dict[str, str]:
    """``SMALL_BATCH``, or what the session has if that is less."""
    own = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ARROW_BYTES))
    return {ARROW_BYTES: f"{min(own, SMALL_BATCH) if own > 0 else SMALL_BATCH}b"}


@contextmanager
def _held(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """For what is run inside: Python tasks get a few megabytes at a time, however large the table is."""
    with _held(spark, _small_batch(spark)):
        yield


@contextmanager
def stream_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Settings a stream takes over when it starts; the session gets its own ones back.

    ``partitions`` is the number of state partitions. It is fixed with the first start of
    a checkpoint, so choose it for the load the stream will have. Its Python tasks get small batches.
    """
    wanted = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER} | _small_batch(spark)
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    with _held(spark, wanted):
        yield


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A session without that setting uses a folder
    in its warehouse, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def store_once(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, for frames that are used more than once."""
    path = fresh_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table folder holds a write that has come to its end."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)
