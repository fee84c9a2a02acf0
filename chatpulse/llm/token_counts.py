"""Token counts through a cache keyed by content and tokenizer digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatpulse.llm.common import map_arrow, text_or_empty
from chatpulse.llm.tokens import TextTokens, in_slices


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_cache(spark: SparkSession, path: str) -> DataFrame | None:
    """(content, n_tokens), once per content even if two jobs stored the same text."""
    if not _exists(spark, path):
        return None
    stored = spark.read.schema("content binary, n_tokens long").parquet(path)
    return stored.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def _encode(texts: DataFrame, tokenizer_path: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextTokens(tokenizer_path)
        for batch in batches:
            values = batch.column(1).to_pylist()
            counts = [len(ids) // 4 for a, b in in_slices(values) for ids in encoder.ids(values[a:b])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64())], names=["content", "n_tokens"]
            )

    return map_arrow(texts, work, "content binary, n_tokens long")


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens.

    The cache is a folder of Parquet files below ``cache_path``, one sub-folder for each
    tokenizer digest, so another tokenizer file never meets old counts. Content is
    normalised as far as that can't change a count: a null text is the empty one, the
    rest is taken as it is. Texts whose digest is not stored are reduced to one copy each
    (copies combine before the shuffle), encoded, and appended; then every document takes
    its count by its digest. Of the documents only id, size and digest are shuffled for
    that, and a digest that a third of all rows share is left to the skew-join split.

    Null and repeated ids keep their rows; an empty table gives none and leaves the cache
    as it is; other columns are ignored.
    """
    spark = docs.sparkSession
    folder = f"{cache_path}/{tokenizer_digest(tokenizer_path)}"
    text = text_or_empty(text_column)
    content = F.unhex(F.sha2(text.cast("binary"), 256)).alias("content")
    texts = docs.select(content, text.alias("text"))
    stored = read_cache(spark, folder)
    if stored is not None:
        texts = texts.join(stored, "content", "left_anti")
    distinct = texts.groupBy("content").agg(F.first("text").alias("text"))
    _encode(distinct, tokenizer_path).write.mode("append").parquet(folder)
    narrow = docs.select(
        F.col(id_column).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), content
    )
    return narrow.join(read_cache(spark, folder), "content", "left").select("doc_id", "n_bytes", "n_tokens")
