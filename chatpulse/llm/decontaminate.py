"""Find benchmark items inside documents up to a bounded edit distance.

Words are compared, not characters: A-Z lower-cased, ASCII punctuation taken as a blank; in scripts
written without blanks every character is a word. An item of n
words is found if some run of a document's words has at most ``floor(n * (1 - similarity))``
insertions, deletions and substitutions of whole words against it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatpulse.llm.common import map_arrow, text_bytes, write_once

#: ASCII letters lower-cased, ASCII punctuation and control characters blanked.
PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: Odd multipliers for mixing.
MIX, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
GROWTH = 1.15


def plain_words(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


#: Characters of scripts without blanks: Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han and what is written among them.
UNSPACED = re.compile(
    "([\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u2e80-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
    "\uf900-\ufaff\uff00-\uff0f\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff])"
)


def cut_words(text: bytes) -> list[bytes]:
    """Plain words, those in scripts without blanks cut into characters."""
    if text.isascii():
        return plain_words(text)
    return plain_words(UNSPACED.sub(r" \1 ", text.decode("utf-8", "surrogateescape")).encode("utf-8", "surrogateescape"))


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x * MIX
    x ^= x >> np.uint64(29)
    x *= MIX2
    return x ^ (x >> np.uint64(32))


def bigram_codes(codes: np.ndarray) -> np.ndarray:
    return mixed(codes[:-1] * MIX2 + codes[1:]) if len(codes) > 1 else np.zeros(0, np.uint64)


def class_codes(bigrams: np.ndarray, length: int) -> np.ndarray:
    return mixed(bigrams + np.uint64(length))


def bit_set(values: np.ndarray, bits: int) -> np.ndarray:
    """A fixed-size set: one bit for each of 2**bits residues, whatever the number of values."""
    held = np.zeros(1 << bits, bool)
    held[(values & np.uint64((1 << bits) - 1)).astype(np.int64)] = True
    return np.packbits(held)


def in_set(held: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    return held[(values & np.uint64((1 << bits) - 1)).astype(np.int64)]


def run_codes(codes: np.ndarray, size: int, length: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, for the class of items up to ``length`` words."""
    n = max(len(codes) - size + 1, 0)
    out = np.full(n, length, np.uint64)
    for k in range(size):
        out = mixed(out * MIX2 + codes[k : k + n])
    return out


def seed_size(low: int, high: int, similarity: float) -> int:
    """Words of a seed of items of ``low`` to ``high`` words.

    An item of n words falls into d + 1 pieces of n // (d + 1) words or more, d being the edits
    allowed. d edits touch at most d pieces, so a find holds one of them whole.
    """
    return min(n // (edits_allowed(n, similarity) + 1) for n in range(low, high + 1))


def seeds(codes: np.ndarray, size: int, length: int, similarity: float) -> np.ndarray:
    """Hashes of the first ``size`` words of each piece of an item."""
    pieces = edits_allowed(len(codes), similarity) + 1
    starts = np.arange(pieces) * len(codes) // pieces
    return run_codes(codes, size, length)[starts]


def length_classes(longest: int, shortest: int) -> list[tuple[int, int]]:
    """(smallest, largest) item length of each class; lengths in a class differ by about 15 %."""
    out, low = [], shortest
    while low <= longest:
        high = max(low, int(low * GROWTH))
        out.append((low, high))
        low = high + 1
    return out


def edits_allowed(n: int, similarity: float) -> int:
    return int(n * (1 - similarity) + 1e-9)


def words_missing(item: list, words: list) -> int:
    """Words of ``item``, counted as often as they occur, that ``words`` does not hold."""
    return (Counter(item) - Counter(words)).total()


def best_span(item: list, words: list) -> tuple[int, int, int]:
    """(edits, start, end) of the run of ``words`` nearest to ``item``; the earliest end on ties."""
    ids = {w: i for i, w in enumerate(dict.fromkeys(item))}
    x = np.array([ids.get(w, -1) for w in words], np.int64)
    m = len(words)
    cost, begin, steps = np.zeros(m + 1, np.int64), np.arange(m + 1), np.arange(m + 1)
    for i, w in enumerate(item, 1):
        up, diagonal = cost + 1, cost[:-1] + (x != ids[w])
        best, first = up.copy(), begin.copy()
        better = diagonal < best[1:]
        best[1:][better], first[1:][better] = diagonal[better], begin[:-1][better]
        shifted = best - steps  # a run of insertions: best[k] + (j - k)
        lowest = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == lowest, steps, 0))
        cost, begin = lowest + steps, first[source]
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


def _items(benchmark: DataFrame, similarity: float, shortest: int) -> DataFrame:
    """(item_id, words, n, keys, bigrams) of the items long enough to be searched."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = cut_words(text)
                if len(words) < shortest:
                    continue
                codes = word_codes(words)
                low, high = next(c for c in length_classes(len(words), shortest) if c[0] <= len(words) <= c[1])
                keys, pairs = seeds(codes, seed_size(low, high, similarity), high, similarity), bigram_codes(codes)
                rows.append((item, b" ".join(words), len(words), keys.view(np.int64).tolist(), np.concatenate([pairs, class_codes(pairs, high)]).view(np.int64).tolist()))
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["item_id", "words", "n", "keys", "bigrams"]
            )

    narrow = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_bytes("text").alias("text"))
    return map_arrow(narrow.distinct(), work, "item_id long, words binary, n long, keys array<long>, bigrams array<long>")


def _bits_of(frame: DataFrame, column: str, bits: int) -> bytes:
    """The fixed-size set of all values; at most 2**bits numbers reach the driver."""
    residue = F.col("x").bitwiseAND(F.lit((1 << bits) - 1))
    found = frame.select(F.explode(column).alias("x")).select(residue.alias("x")).distinct()
    values = np.array([row[0] for row in found.toLocalIterator()], np.uint64)
    return bit_set(values, bits).tobytes()


def candidate_regions(
    docs: DataFrame, classes: list, bigrams: bytes, keys: bytes, bits: int, similarity: float
) -> DataFrame:
    """(region, doc_id, first, words, keys): stretches of documents that share a seed with an item.

    A run of words within d edits of an item of n words keeps at least n - 1 - 2d of its
    bigrams. Windows with fewer benchmark bigrams than that hold no find and are left out;
    this loses nothing. (Bigrams are counted for each class of item lengths on its own.) Of all others,
    at every start, the hashes of seed size that are in the items' fixed-size set go on.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((bigrams, keys))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair_set, key_set = (np.unpackbits(np.frombuffer(b, np.uint8)).view(bool) for b in shared.value)
        number = TaskContext.get().partitionId() << 40
        limits = []
        for low, high in classes:
            need = min(max(0, n - 1 - 2 * edits_allowed(n, similarity)) for n in range(low, high + 1))
            limits.append((high, high + edits_allowed(high, similarity), need, seed_size(low, high, similarity)))
        least = min(need for _, _, need, _ in limits)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = cut_words(text.as_py())
                codes = word_codes(words)
                pairs = bigram_codes(codes)
                known = np.flatnonzero(in_set(pair_set, pairs, bits))
                if len(known) < least or not words:
                    continue
                for high, reach, need, size in limits:
                    own_pairs = known[in_set(pair_set, class_codes(pairs[known], high), bits)]
                    if len(own_pairs) < need:
                        continue
                    runs = run_codes(codes, size, high)
                    if edits_allowed(high, similarity):
                        total = np.zeros(len(words) + 1, np.int64)
                        total[own_pairs + 1] = 1
                        total = np.cumsum(total)
                        last = np.minimum(np.arange(len(words)) + reach - 1, len(words) - 1)
                        starts = np.flatnonzero(total[last] - total[: len(words)] >= need)
                    else:  # without edits a find starts with its seed
                        starts = np.flatnonzero(in_set(key_set, runs, bits))
                    if not len(starts):
                        continue
                    for part in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                        for cut in range(0, len(part), 4 * reach):  # a long stretch gives overlapping regions
                            own = part[cut : cut + 4 * reach]
                            first, end = int(own[0]), int(own[-1]) + reach
                            found = runs[first : max(end - size + 1, 0)]
                            found = np.unique(found[in_set(key_set, found, bits)])
                            if len(found):
                                number += 1
                                rows.append((number, doc, first, b" ".join(words[first:end]), found.view(np.int64).tolist()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["region", "doc_id", "first", "words", "keys"]
            )

    return map_arrow(docs, work, "region long, doc_id long, first long, words binary, keys array<long>")


def _verify(pairs: DataFrame, similarity: float) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                item, words = row["item_words"].split(), row["words"].split()
                if words_missing(item, words) > edits_allowed(len(item), similarity):
                    continue  # each of them costs an edit
                edits, start, end = best_span(item, words)
                if edits <= edits_allowed(len(item), similarity):
                    rows.append((row["doc_id"], row["item_id"], row["first"] + start, end - start, edits, len(item)))
            columns = list(zip(*rows)) if rows else [[]] * 6
            names = ["doc_id", "item_id", "first_word", "words", "edits", "item_words"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return map_arrow(
        pairs, work, "doc_id long, item_id long, first_word long, words long, edits long, item_words long"
    )


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = 0.8,
    shortest: int = 1,
    bits: int = 24,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Contaminated documents: doc_id, item_id, first_word, words, edits, item_words.

    One row per document and item, for the place with the fewest edits (the earliest on
    ties). Every find holds a piece of its item unchanged; what
    shares such a seed with an item is joined to it and aligned exactly, so all reported rows
    are right and none is missing, whatever the length. Items of under five words allow no edit
    and are their own seeds. Only two bit sets of 2**bits bits are broadcast, whatever the sizes.

    Items of fewer than ``shortest`` words are not searched; by default that is those without words. Null texts are empty; null ids keep their
    finds (null on either side); rows repeated under one id give one row; an empty
    table on either side gives none. Other columns are ignored.
    """
    items = write_once(_items(benchmark, similarity, shortest), "benchmark-items")
    longest = items.agg(F.max("n")).first()[0]
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_bytes(text_column).alias("text"))
    lengths = {row["n"] for row in items.select("n").distinct().collect()}
    classes = [(a, b) for a, b in length_classes(longest or 0, shortest) if any(a <= n <= b for n in lengths)]
    if not classes:
        classes = [(shortest, shortest)]
    regions = candidate_regions(
        narrow, classes, _bits_of(items, "bigrams", bits), _bits_of(items, "keys", bits), bits, similarity
    )
    regions = write_once(regions, "benchmark-regions")
    posted = items.select("item_id", F.col("words").alias("item_words"), F.explode("keys").alias("key")).distinct()
    met = regions.select("region", F.explode("keys").alias("key")).join(posted, "key")
    pairs = met.select("region", "item_id", "item_words").distinct().join(regions.drop("keys"), "region")
    found = _verify(pairs.select("doc_id", "item_id", "first", "words", "item_words"), similarity)
    place = F.min(F.struct("edits", "first_word", "words", "item_words")).alias("p")
    return found.groupBy("doc_id", "item_id").agg(place).select(
        "doc_id", "item_id", "p.first_word", "p.words", "p.edits", "p.item_words"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents in which no item is found, with all their columns. Null ids are never dropped."""
    bad = find_benchmark(docs, benchmark, **settings).select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    return docs.join(bad, "doc_id", "left_anti")
