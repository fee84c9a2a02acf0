"""Phrase collocations by Toivonen's sampling: proposals and their negative border, one exact pass, expansion until closed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatpulse.llm.common import LOWER, map_arrow, new_folder, text_bytes, write_buckets, write_once
from chatpulse.llm.vocabulary import LocalCodes, by_frequency, squeeze, unsqueeze

BREAK = b"\xff"  # no byte of UTF-8
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
#: A-Z to a-z, ends of pieces to BREAK, tab to blank.
PREPARED = bytes(BREAK[0] if b in ENDS else 32 if b == 9 else LOWER[b] for b in range(256))
BLOCK = "block long, lang string, places binary, words array<binary>, counts array<long>"
GRAMS = "gram binary, f long"
#: Phrases of a block that are hashed or sent at a time.
SLICE = 100_000
CODE = 4


def pieces_of(text: bytes) -> list[bytes]:
    """Words in order, with BREAK where a piece ends."""
    return text.translate(PREPARED).replace(BREAK, b" \xff ").split()


def word_blocks(docs: DataFrame, block_bytes: int, lang_column: str, text_column: str) -> DataFrame:
    """One row per block of a task's texts of one language: distinct words with counts, and the places of all words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, tuple[LocalCodes, list]] = {}
        size = 0

        def blocks() -> Iterator[pa.RecordBatch]:
            nonlocal number, held, size
            for lang, (table, places) in held.items():
                codes = np.concatenate(places)
                ranked, order, counts = by_frequency(codes, len(table))
                words = list(table)
                row = [number, lang, squeeze(ranked), [words[i] for i in order], counts.tolist()]
                types = [pa.int64(), pa.string(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=["block", "lang", "places", "words", "counts"])
            held, size = {}, 0

        for batch in batches:
            for lang, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                table, places = held.setdefault(lang, (LocalCodes(), []))
                places.append(table.of([BREAK, *pieces_of(text)]))
                size += len(text) + 1
                if size >= block_bytes:
                    yield from blocks()
        yield from blocks()

    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit("und"))
    return map_arrow(docs.select(lang.alias("lang"), text_bytes(text_column).alias("text")), work, BLOCK)


def gram_of(code: Column) -> Column:
    return F.unhex(F.lpad(F.hex(code), 2 * CODE, "0"))


def code_words(blocks: DataFrame, least: int) -> DataFrame:
    """(lang, word, f, code): words that occur at least ``least`` times, numbered from 1 without gaps.

    Numbers come from a row's place in its stored file part plus the sizes of the parts before.
    """
    counted = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("x")).select("lang", "x.words", "x.counts")
    words = counted.where(F.col("words") != F.lit(BREAK)).groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f"))
    numbered = write_once(words.where(F.col("f") >= least).withColumn("id", F.monotonically_increasing_id()), "phrase-words")
    part = F.shiftright("id", 33)
    sizes = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    code = F.col("start") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return write_once(numbered.withColumn("part", part).join(starts, "part").select("lang", "word", "f", code.alias("code")), "phrase-codes")


def _coded_block(block: pa.Table, words: pa.Table) -> pa.Table:
    """The block's places as word numbers of the whole corpus; 0 for breaks and rarer words."""
    codes = []
    if block.num_rows:
        places = unsqueeze(block["places"][0].as_py())
        number = np.zeros(int(places.max(initial=0)) + 1, np.uint32)
        number[words["place"].to_numpy()] = words["code"].to_numpy()
        codes = [number[places].tobytes()]
    return pa.table({"block": block["block"], "codes": pa.array(codes, pa.binary())})


def coded_blocks(blocks: DataFrame, codes: DataFrame) -> DataFrame:
    """(block, codes): stored, since every later pass reads it."""
    words = blocks.select(F.col("block").alias("of_block"), "lang", F.posexplode("words").alias("place", "word"))
    known = words.join(codes.select("lang", "word", "code"), ["lang", "word"]).select("of_block", "place", "code")
    joined = blocks.select("block", "places").groupBy("block").cogroup(known.groupBy("of_block"))
    folder = new_folder(blocks.sparkSession, "phrase-blocks")
    joined.applyInArrow(_coded_block, "block long, codes binary").write.option("compression", "zstd").parquet(folder)
    return blocks.sparkSession.read.schema("block long, codes binary").parquet(folder)


def _mixed(grams: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each row of word numbers."""
    h = np.full(len(grams), seed * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
    for at in range(grams.shape[1]):
        h ^= grams[:, at].astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) + (h << np.uint64(6)) + (h >> np.uint64(2))
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
    return h


class GramFilter:
    """A set of phrases as bits: holds all of them, and now and then another one.

    What it wrongly holds is counted in vain and changes no result, so its size is a bound and no cut.
    """

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 64 - 1)

    @staticmethod
    def places(grams: np.ndarray, n_bits: int) -> np.ndarray:
        a, b = _mixed(grams, 1), _mixed(grams, 2) | np.uint64(1)
        return np.concatenate([(a + np.uint64(k) * b) & np.uint64(n_bits - 1) for k in range(3)])

    def holds(self, grams: np.ndarray) -> np.ndarray:
        out = np.zeros(len(grams), bool)
        for a in range(0, len(grams), SLICE):
            at = self.places(grams[a : a + SLICE], len(self.bits) * 64).reshape(3, -1)
            out[a : a + SLICE] = (((self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)) == 1).all(axis=0)
        return out


def numbers_of(grams: pa.Array, size: int) -> np.ndarray:
    """Phrases of ``size`` words as rows of word numbers."""
    return np.frombuffer(b"".join(grams.to_pylist()), ">u4").reshape(-1, size)


def gram_filter(grams: DataFrame, n_bytes: int) -> GramFilter:
    """Tasks set the bits of their phrases; what comes to the driver is at most ``n_bytes`` and a number beside each eight."""
    n_bits = n_bytes * 8

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(n_bits // 64, np.uint64)
        for batch in batches:
            sizes = np.array([len(g) // CODE for g in batch.column(0).to_pylist()])
            for size in np.unique(sizes).tolist():
                at = GramFilter.places(numbers_of(batch.column(0).take(pa.array(np.flatnonzero(sizes == size))), size), n_bits)
                np.bitwise_or.at(bits, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        slots = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(bits[slots].view(np.int64))], names=["slot", "bits"])

    merged = map_arrow(grams.select("gram"), work, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    found = merged.toArrow()
    bits = np.zeros(n_bits // 64, np.uint64)
    bits[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return GramFilter(bits)


def grams_of(codes: np.ndarray, longest: int, filters: list[GramFilter | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrases of one length as rows of word numbers, counts) that this pass has to count in a run of codes.

    A phrase is counted by the first pass whose filter holds both its parts, that without the last word and that
    without the first. ``filters`` are those of all passes so far; None holds every word and nothing longer.
    """
    ids, shorter = codes.astype(np.uint64), None
    open_to = [codes != 0 for _ in filters]
    for size in range(2, longest + 1):
        if len(codes) < size:
            return
        both = [o[:-1] & o[1:] for o in open_to]
        at = np.flatnonzero(np.logical_or.reduce(both))
        if not len(at):
            return
        key = ids[at] << np.uint64(32) | codes[at + size - 1].astype(np.uint64)
        unique, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        del key
        lead = (unique >> np.uint64(32)).astype(np.int64)
        rows = lead[:, None].astype(np.uint32) if shorter is None else shorter[lead]
        rows = np.concatenate([rows, (unique & np.uint64(0xFFFFFFFF)).astype(np.uint32)[:, None]], axis=1)
        # The same at every place of a phrase.
        told = []
        for b in both:
            told.append(np.zeros(len(unique), bool))
            told[-1][inverse] = b[at]
        due = told[-1] & ~np.logical_or.reduce(told[:-1] or [np.zeros(len(unique), bool)])
        if due.any():
            yield rows[due], counts[due]
        ids = np.zeros(len(codes) - size + 1, np.uint64)
        ids[at] = inverse
        held = [np.zeros(len(unique), bool) if f is None else f.holds(rows) for f in filters]
        open_to = []
        for b, h in zip(both, held):
            o = np.zeros(len(ids), bool)
            o[at] = b[at] & h[inverse]
            open_to.append(o)
        shorter = rows


def count_grams(coded: DataFrame, longest: int, filters: list[GramFilter | None], least: int, share: float = 1.0) -> DataFrame:
    """(gram, f) of the phrases this pass counts, at least ``least`` times.

    With a ``share`` below 1 only a stretch of each block is looked at, at a place that depends on the
    block's number. Blocks count their phrases themselves, so a very common phrase moves once a block.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes = np.frombuffer(data, "<u4")
                if share < 1:
                    n = int(len(codes) * share) + 1
                    start = np.random.default_rng(block).integers(0, max(1, len(codes) - n + 1))
                    codes = codes[start : start + n]
                for rows, counts in grams_of(codes, longest, filters):
                    for a in range(0, len(rows), SLICE):
                        own = rows[a : a + SLICE]
                        ends = pa.array(np.arange(len(own) + 1, dtype=np.int32) * (CODE * own.shape[1]))
                        flat = pa.py_buffer(own.astype(">u4").tobytes())
                        grams = pa.Array.from_buffers(pa.binary(), len(own), [None, ends.buffers()[1], flat])
                        yield pa.RecordBatch.from_arrays([grams, pa.array(counts[a : a + SLICE].astype(np.int64))], names=["gram", "f"])

    counted = map_arrow(coded, work, GRAMS).groupBy("gram").agg(F.sum("f").alias("f"))
    return counted.where(F.col("f") >= least)


def lowered(least: int, share: float) -> int:
    """The count that proposes a phrase in a sample of that share: three deviations below the expected one, two at the least."""
    expected = least * share
    return max(2, int(expected - 3 * expected**0.5))


def frequent_phrases(
    coded: DataFrame, longest: int, least: int, n_words: int, sample_words: int, filter_bytes: int
) -> tuple[DataFrame, int]:
    """((gram, f) of all phrases of 2 to ``longest`` frequent words that occur ``least`` times, passes needed).

    The sample proposes phrases. A full pass counts these and their negative border: phrases not proposed, both of whose
    parts are (single words are all known exactly by then). Frequent phrases of the border mean
    that longer ones may have been left out, and a further pass counts those whose parts are
    known as frequent by now. No new frequent phrase that could be part of a longer one
    closes the search; nothing the sample missed is lost.
    """
    share = min(1.0, sample_words / max(n_words, 1))
    proposed = count_grams(coded, longest, [None], 1, share)  # pairs only: None holds nothing longer
    found: DataFrame | None = None
    filters: list[GramFilter | None] = []
    part = F.length("gram") < CODE * longest
    if longest > 2:
        enough = lowered(least, share)
        sample = write_once(proposed.where(F.col("f") >= enough), "phrase-sample")
        for size in range(3, longest):
            longer = count_grams(coded, size, [gram_filter(sample, filter_bytes)], enough, share)
            sample = write_once(sample.unionByName(longer.where(F.length("gram") == CODE * size)), "phrase-sample")
        known, first = sample, gram_filter(sample, filter_bytes)
    else:
        known, first = proposed, None
    filters.append(first)
    while True:
        new = write_once(count_grams(coded, longest, filters, least), "phrase-counts")
        found = new if found is None else found.unionByName(new)
        failed = new.where(part).join(known.select("gram"), "gram", "left_anti")
        if longest == 2 or failed.isEmpty():
            return found, len(filters)
        known = found
        filters.append(gram_filter(found.where(part), filter_bytes))


def with_cuts(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, a, l, r, score): the lowest-scoring cut, the first one of ties. Products are 38-digit decimals."""
    cuts = grams.select(
        "gram", F.col("f").alias("a"), F.explode(F.expr(f"sequence(1, cast(length(gram) / {CODE} as int) - 1)")).alias("k")
    )
    cuts = cuts.select(
        "gram", "a", "k", F.expr(f"substring(gram, 1, {CODE} * k)").alias("head"), F.expr(f"substring(gram, {CODE} * k + 1)").alias("tail")
    )
    left = counts.select(F.col("gram").alias("head"), F.col("f").alias("l"))
    right = counts.select(F.col("gram").alias("tail"), F.col("f").alias("r"))
    both = cuts.join(left, "head").join(right, "tail")
    exact = "(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)))"
    score = F.expr(f"{exact} div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    lowest = both.groupBy("gram").agg(F.min(F.struct(score.alias("score"), "k", "a", "l", "r")).alias("x"))
    return lowest.select("gram", "x.a", "x.l", "x.r", "x.score")


def inside_longer(grams: DataFrame, longest: int, share: int) -> DataFrame:
    """(gram) of phrases that a longer one holds in a run, which occurs in at least ``share`` hundredths of their places."""
    parts = F.expr(
        f"flatten(transform(sequence(2, cast(length(gram) / {CODE} as int) - 1), n -> "
        f"transform(sequence(0, cast(length(gram) / {CODE} as int) - n), i -> substring(gram, {CODE} * i + 1, {CODE} * n))))"
    )
    longer = grams.where(F.length("gram") > 2 * CODE).select(F.explode(parts).alias("gram"), F.col("f").alias("most"))
    most = longer.groupBy("gram").agg(F.max("most").alias("most"))
    return grams.join(most, "gram").where(100 * F.col("most") >= share * F.col("f")).select("gram")


def best_of_each(rows: DataFrame, top: int, order: list[Column], salts: int = 64) -> DataFrame:
    """``rank`` of the first ``top`` rows of each lang; a lang is thinned out in parts before its rows meet in one task."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    few = salted.withColumn("_n", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_n") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return few.withColumn("rank", rank).where(F.col("rank") <= top).drop("_salt", "_n")


def mine_phrases(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    inside: int = 50,
    top: int = 2000,
    sample_words: int = 1_000_000,
    block_bytes: int = 16_000_000,
    filter_bytes: int = 4 << 20,
    lang_column: str = "lang",
    text_column: str = "text",
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased, texts cut into pieces at ``.,;:!?`` and line ends, pieces into words at blanks and
    tabs. Candidates are phrases of 2 to ``longest`` words that occur ``a >= least`` times within pieces,
    overlaps included. A cut after the first k words gives l and r, the counts of both sides, and the score
    floor(1000000 a a / (l r)); the lowest one counts. A candidate goes if a longer one holds it in at least ``inside``
    hundredths of its places. ``n`` counts all words of the language.

    Blocks of texts are stored as places of their distinct words, and these get numbers that hold for the whole
    corpus by one join. ``sample_words`` bounds what proposes phrases, ``filter_bytes`` what tasks
    are given of them; both only move work between passes, and counts are exact over all texts.

    Null text counts as empty, a null language is ``und``; ids aren't needed, so that null and repeated ones make no
    difference; an empty table, or one without frequent phrases, gives no rows; other columns are ignored.
    """
    if longest < 2 or filter_bytes & (filter_bytes - 1) or filter_bytes < 8:
        raise ValueError("phrases have two words or more; filter_bytes is a power of two from 8 on")
    blocks = write_buckets(word_blocks(docs, block_bytes, lang_column, text_column), "phrase_texts", "block")
    in_words = F.expr("aggregate(filter(arrays_zip(words, counts), x -> x.words != X'FF'), 0L, (s, x) -> s + x.counts)")
    totals = write_once(blocks.groupBy("lang").agg(F.sum(in_words).alias("n")), "phrase-totals")
    codes = code_words(blocks, least)
    if (codes.agg(F.max("code")).first()[0] or 0) >> 8 * CODE:
        raise ValueError("more frequent words than four bytes can number")
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    grams, _ = frequent_phrases(coded_blocks(blocks, codes), longest, least, n_words, sample_words, filter_bytes)
    counts = grams.unionByName(codes.select(gram_of(F.col("code")).alias("gram"), "f"))
    kept = grams.join(inside_longer(grams, longest, inside), "gram", "left_anti")
    scored = with_cuts(kept, counts)
    codes_in = F.expr(f"transform(sequence(0, cast(length(gram) / {CODE} as int) - 1), i -> substring(gram, {CODE} * i + 1, {CODE}))")
    spelled = scored.select("gram", F.posexplode(codes_in).alias("at", "code"))
    named = spelled.join(codes.select(gram_of(F.col("code")).alias("code"), "lang", F.col("word").cast("string").alias("word")), "code")
    phrase = F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]))
    texts = named.groupBy("gram").agg(F.first("lang").alias("lang"), phrase.alias("phrase"))
    rows = scored.join(texts, "gram").drop("gram")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    return best_of_each(rows, top, order).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
