"""Helpers that the operators of this folder share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatpulse.session import checkpoint_root

#: ASCII only, as the word rule of the operators asks: letters A-Z become a-z.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the folder that all executors share."""
    return f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def write_once(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and go on from the file.

    Cuts the lineage: what follows is neither computed twice nor lost with an executor.
    """
    path = new_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def write_buckets(frame: DataFrame, name: str, key: str) -> DataFrame:
    """``write_once`` as a table in buckets by ``key``: a grouping by that key reads them where they lie, without a shuffle.

    The rows are not moved for it; a task writes a file for each bucket that it has rows of.
    """
    spark = frame.sparkSession
    folder = new_folder(spark, name)
    table = f"{name}_{uuid.uuid4().hex}"
    writer = frame.write.format("parquet").option("compression", "zstd").option("path", folder)
    writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).saveAsTable(table)
    return spark.table(table)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_bytes(column: str) -> Column:
    """The text in UTF-8; null counts as empty."""
    return text_or_empty(column).cast("binary")


def map_arrow(
    frame: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    return frame.mapInArrow(work, schema)


def words_of(text: bytes) -> list[bytes]:
    """Runs of bytes other than space, tab, line feed, VT, FF and CR, A-Z lower-cased."""
    return text.translate(LOWER).split()


def _stars(edges: DataFrame, upward: bool) -> DataFrame:
    """One half-step: every node hands its smallest neighbour (or itself) to its neighbours.

    ``edges`` holds (u, v) with u > v. Upward: to the larger neighbours, over edges in both
    directions; else: to the smaller ones and itself.
    """
    around = edges
    if upward:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = around.groupBy("u").agg(F.min("v").alias("m"))
    smallest = smallest.select("u", F.least("u", "m").alias("m"))
    joined = around.join(smallest, "u")
    if upward:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        pair = F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m")))
        moved = joined.select(pair.alias("p")).select(F.col("p.v").alias("u"), F.col("p.m").alias("v"))
    return moved.where(F.col("u") > F.col("v")).distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges`` (a, b) of one ordered type -> (node, root): the smallest node reachable.

    Alternates large-star and small-star steps until the edge set stays the same; each
    round is written to the shared folder. A node's edges are never gathered in one task:
    minima combine before the shuffle and joins leave hot keys to the skew-join split.
    Nodes without an edge are not in the result. Loops and repeated edges do no harm.
    """
    current = write_once(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        name,
    )
    seen = None
    while True:
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = mark
        if not mark[0]:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        current = write_once(_stars(_stars(current, True), False), name)
