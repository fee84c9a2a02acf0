"""Small files and folders in whatever store Spark writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    store, place = _place(spark, path)
    return [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    store, place = _place(spark, path)
    size = store.getFileStatus(place).getLen()
    stream = store.open(place)
    try:
        data = bytearray()
        while len(data) < size and (part := stream.readNBytes(size - len(data))):
            data += bytes(part)
    finally:
        stream.close()
    return data.decode("utf-8")


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file appear whole; False if there is one of that name. It is written aside and renamed."""
    store, place = _place(spark, path)
    if store.exists(place):
        return False
    parent = place.getParent()
    store.mkdirs(parent)
    aside = spark._jvm.org.apache.hadoop.fs.Path(parent, f".{place.getName()}-{uuid.uuid4().hex}")
    stream = store.create(aside, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not store.exists(place) and store.rename(aside, place):
        return True
    store.delete(aside, False)
    return False


def delete(spark: SparkSession, path: str) -> None:
    store, place = _place(spark, path)
    store.delete(place, True)


def expire_batches(spark: SparkSession, path: str, before: int) -> int:
    """Delete the ``batch_id=`` folders of a table that are older than ``before``; returns how many."""
    old = [n for n in child_names(spark, path) if n.startswith("batch_id=") and int(n.split("=")[1]) < before]
    for name in old:
        delete(spark, f"{path}/{name}")
    return len(old)
