"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatpulse.llm.common import connected_components, map_arrow, text_bytes, words_of, write_once

BITS = 64


def fingerprint(words: list[bytes], shingle: int, seed: int) -> int:
    """Bit i is 1 if set in over half of the shingles' hashes; 0 without words."""
    import xxhash

    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # keeps the bits of a very long text small
        pairs = zip(starts[at : min(n, at + (1 << 16))].tolist(), ends[at + shingle - 1 : at + shingle - 1 + (1 << 16)].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in pairs], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = 3, seed: int = 42, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(words_of(text.as_py()), shingle, seed) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "fp"]
            )

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_bytes(text_column).alias("text"))
    return map_arrow(narrow, work, "doc_id long, fp long")


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 masks; any ``radius`` bits all lie outside at least one of them.

    Every bit gets a non-zero vector of radius+1 binary digits. Mask v keeps the bits whose
    vector has an odd product with v. ``radius`` vectors don't span the space, so
    some v is orthogonal to all of them, and its mask holds none of those bits.
    """
    n = (1 << (radius + 1)) - 1
    return [sum(1 << bit for bit in range(BITS) if ((bit % n + 1) & v).bit_count() & 1) for v in range(1, n + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_links(fps: DataFrame, radius: int = 2, pairwise: int = 48) -> DataFrame:
    """Links (a, b) that join all ``fp`` values (distinct) within ``radius`` bits into components.

    Each value goes to one table for each mask, under its bits inside the mask. Buckets of up to
    ``pairwise`` values are compared pair by pair. In larger ones no pairs are made: each value
    goes to itself and to all values with one bit outside the mask flipped; two of them
    meet at some such value exactly if they differ in at most two bits, and all who meet are
    linked to the smallest of them. So the work of a bucket grows with its size, and no
    bucket is cut. The latter needs a radius of two; zero links nothing but equal values.
    """
    if radius not in (0, 2):
        raise ValueError("radius 0 or 2")
    if radius == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where(F.lit(False))
    masks = covering_masks(radius)
    rows = [F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)]
    tables = fps.select("fp", F.explode(F.array(*rows)).alias("x")).select("fp", "x.t", "x.key")
    sizes = tables.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    sized = write_once(tables.join(sizes, ["t", "key"]), "simhash-buckets")
    small = sized.where(F.col("n") <= pairwise)
    other = small.select("t", "key", F.col("fp").alias("b"))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= radius
    pairs = small.join(other, ["t", "key"]).where((F.col("fp") < F.col("b")) & close)
    pairs = pairs.select(F.col("fp").alias("a"), "b")

    outside = F.array(*[F.array(*[F.lit(_signed(1 << b)) for b in range(BITS) if not m >> b & 1] + [F.lit(0).cast("long")]) for m in masks])
    met = sized.where(F.col("n") > pairwise).select(
        "fp", F.explode(F.element_at(outside, F.col("t") + 1)).alias("flip")
    )
    met = met.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("hub")).distinct()
    least = met.groupBy("hub").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where(F.col("n") > 1)
    hubs = met.join(least, "hub").where(F.col("fp") != F.col("a")).select("a", F.col("fp").alias("b"))
    return pairs.unionByName(hubs).distinct()


def simhash_components(
    docs: DataFrame,
    radius: int = 2,
    shingle: int = 3,
    seed: int = 42,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents with equal fingerprints fall together before any comparison, so copies never
    make pairs. Null text counts as empty; texts without words have fingerprint zero and are
    linked like any other. Null ids keep their rows and never become a component's id
    unless all its ids are null; repeated rows fall into one component; an empty table gives
    none. Other columns are ignored.
    """
    fps = write_once(fingerprints(docs, shingle, seed, id_column, text_column), "simhash")
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = connected_components(near_links(distinct.select("fp"), radius), "simhash-components")
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def first_of_each(numbered: DataFrame, found: DataFrame) -> DataFrame:
    """The rows with the smallest doc_id of each component in ``found`` (_row, component_id); null ids come last."""
    ids = numbered.select("_row", F.col("doc_id").isNull().alias("none"), "doc_id")
    first = found.join(ids, "_row").groupBy("component_id").agg(F.min(F.struct("none", "doc_id", "_row")).alias("first"))
    return numbered.join(first.select("first._row"), "_row", "left_semi").drop("_row")


def keep_one_each(docs: DataFrame, **settings) -> DataFrame:
    """One document of each component, with all its columns: that with the smallest doc_id.

    Null ids come last; rows repeated under one id are one component, of which one row stays.
    Rows are told apart by their place in the stored table, so ``docs`` must be one.
    """
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    found = simhash_components(numbered, id_column="_row", **settings).select(F.col("doc_id").alias("_row"), "component_id")
    return first_of_each(numbered, found)
