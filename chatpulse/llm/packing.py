"""Harmonic packing of token sequences."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatpulse.llm.common import map_arrow, text_or_empty
from chatpulse.llm.tokens import TextTokens, in_slices

SEPARATOR = b"\x00\x00\x00\x00"
PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, tokens binary"
)


class HarmonicBins:
    """The open bins of one worker. ``add`` and ``close`` return finished pieces.

    Class k holds pieces longer than capacity/(k+1) and no longer than capacity/k; its bin
    is full with exactly k of them. A document is cut into whole sequences, then into
    powers of two down to ``grain`` (their bins fill without a gap), then one short rest,
    whose bin wastes less than a share of 1/(k+1) with k > capacity/grain - 1. When the worker
    ends, the pieces of its unfinished bins (fewer than k for each class) are laid end to
    end, longest first, and cut at the capacity; the last of these sequences is cut into
    powers of two, which need no padding.
    """

    def __init__(self, capacity: int, grain: int, first: int):
        self.capacity, self.grain, self.next = capacity, grain, first
        self.bins: dict[int, list] = {}

    def _lengths(self, n: int) -> list[int]:
        out = [self.capacity] * (n // self.capacity)
        rest, size = n % self.capacity, self.capacity // 2
        while size >= self.grain:
            if rest & size:
                out.append(size)
            size //= 2
        return out + [rest % self.grain] * (rest % self.grain > 0)

    def _sequence(self, pieces: list) -> list:
        """Pieces (doc, start, total, ids) laid from offset 0 of the next sequence."""
        number, self.next, offset, out = self.next, self.next + 1, 0, []
        for doc, start, total, ids in pieces:
            out.append((doc, start, len(ids) // 4, total, number, offset, ids))
            offset += len(ids) // 4
        return out

    def add(self, doc, ids: bytes) -> list:
        total, start, out = len(ids) // 4, 0, []
        for length in self._lengths(total):
            k = self.capacity // length
            held = self.bins.setdefault(k, [])
            held.append((doc, start, total, ids[4 * start : 4 * (start + length)]))
            start += length
            if len(held) == k:
                out += self._sequence(self.bins.pop(k))
        return out

    def close(self) -> list:
        left = sorted((p for held in self.bins.values() for p in held), key=lambda p: -len(p[3]))
        self.bins = {}
        room = sum(len(p[3]) for p in left) // 4
        sizes = [self.capacity] * (room // self.capacity)
        sizes += [1 << b for b in range(self.capacity.bit_length(), -1, -1) if (room % self.capacity) >> b & 1]
        out, at = [], 0
        for size in sizes:
            taken = []
            while size:
                doc, start, total, ids = left[at]
                n = min(size, len(ids) // 4)
                taken.append((doc, start, total, ids[: 4 * n]))
                left[at] = (doc, start + n, total, ids[4 * n :])
                at += not left[at][3]
                size -= n
            out += self._sequence(taken)
        return out


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 1024,
    grain: int = 64,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Cut documents into pieces and lay these into sequences of at most ``capacity`` tokens.

    A document's tokens are its ids and a closing 0. Returns one row per piece: the
    document, where in it the piece starts, its length, the document's number of tokens,
    the sequence, the offset there, and the ids as little-endian 32-bit ``tokens``.
    Every worker packs its own input partition: nothing is shuffled, and sequence ids
    carry the partition's number above bit 40, so a task that runs again gives the same
    ids as long as its partition holds the same rows in the same order (stored tables do).

    Null text counts as empty (one piece of one token); null and repeated ids are packed
    row by row; an empty table gives no rows; other columns are ignored. ``capacity`` and
    ``grain`` must be powers of two. A worker holds one bin's pieces for each class at a time.
    """
    if capacity & (capacity - 1) or grain & (grain - 1) or not 0 < grain <= capacity:
        raise ValueError("capacity and grain are powers of two, grain no larger than capacity")
    schema = pa.schema(
        [(n, pa.int64()) for n in "doc_id start length doc_tokens sequence_id offset".split()] + [("tokens", pa.binary())]
    )

    def frame_of(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextTokens(tokenizer_path)
        bins = HarmonicBins(capacity, grain, TaskContext.get().partitionId() << 40)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in in_slices(texts):
                rows = []
                for doc, tokens in zip(ids[a:b], encoder.ids(texts[a:b])):
                    rows += bins.add(doc, tokens + SEPARATOR)
                yield frame_of(rows)
        yield frame_of(bins.close())

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return map_arrow(narrow, work, PIECES)
