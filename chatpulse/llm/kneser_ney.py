"""Text quality from the perplexity of an interpolated modified Kneser-Ney model.

The model's tokens are characters: words of trusted text leave too many of another clean text's
words unseen. Characters that the training text holds more than once have codes of their own, all others
are written as their UTF-8 bytes, so none is unknown. Codes have 15 bits, so four of them are an exact 64-bit key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatpulse.llm.common import map_arrow, text_bytes, write_once

#: Code 0 pads, the next 256 are bytes, the rest are characters.
PAD, FIRST_BYTE, FIRST_CODE, MOST_CODES, WIDTH = 0, 1, 257, 1 << 15, 15
BY_BYTES = 0
POINTS = 0x110000
#: Codes that are looked at at a time, and distinct n-grams that a task holds.
PART, HELD_GRAMS = 1 << 20, 1 << 20
#: Rows of the model that tasks get as a table; what it doesn't hold is joined.
HEAD_ROWS = 1 << 20


def code_points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), "<u4")


def encoded(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Codes of characters; those without one give the codes of their UTF-8 bytes."""
    codes = table[points]
    rare = codes == BY_BYTES
    if not rare.any():
        return codes
    parts = [chr(p).encode("utf-8", "surrogatepass") for p in points[rare].tolist()]
    lengths = np.ones(len(points), np.int64)
    lengths[rare] = [len(p) for p in parts]
    out = np.repeat(codes, lengths)
    out[np.repeat(rare, lengths)] = np.frombuffer(b"".join(parts), np.uint8).astype(codes.dtype) + FIRST_BYTE
    return out


def gram_keys(codes: np.ndarray, order: int) -> np.ndarray:
    """Keys of the n-grams that end at each code; codes start with order-1 pads."""
    n = len(codes) - order + 1
    keys = np.zeros(n, np.int64)
    for k in range(order):
        keys = (keys << WIDTH) | codes[k : k + n].astype(np.int64)
    return keys


def padded(codes: np.ndarray, order: int) -> np.ndarray:
    return np.concatenate([np.zeros(order - 1, codes.dtype), codes])


def code_table(texts: DataFrame) -> np.ndarray:
    """Code of every code point: those that the training text holds twice or more get their own, the most frequent first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(POINTS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                points, n = np.unique(code_points(text.as_py()), return_counts=True)
                counts[points] += n
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["point", "n"])

    found = map_arrow(texts.select("text"), work, "point long, n long").groupBy("point").agg(F.sum("n").alias("n"))
    table = np.full(POINTS, BY_BYTES, np.int32)
    top = found.where(F.col("n") > 1).orderBy(F.desc("n"), "point").limit(MOST_CODES - FIRST_CODE).collect()
    for i, row in enumerate(top):
        table[row["point"]] = FIRST_CODE + i
    return table


def n_codes(table: np.ndarray) -> int:
    return max(int(table.max()) + 1, FIRST_CODE)


def top_counts(texts: DataFrame, table: np.ndarray, order: int) -> DataFrame:
    """(gram, c): n-grams of the highest order, those of a task added up before they are sent."""
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        grams, at = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
        return grams, np.bincount(at, np.concatenate([n for _, n in held]), len(grams)).astype(np.int64)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        """Keys of several short texts, or of a part of a long one."""
        keys, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                codes = padded(encoded(code_points(text.as_py()), shared.value), order)
                for at in range(0, len(codes) - order + 1, PART):
                    keys.append(gram_keys(codes[at : at + PART + order - 1], order))
                    size += len(keys[-1])
                    if size >= PART:
                        yield np.concatenate(keys)
                        keys, size = [], 0
        if keys:
            yield np.concatenate(keys)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for keys in parts(batches):
            held.append(np.unique(keys, return_counts=True))
            size += len(held[-1][0])
            if size >= HELD_GRAMS:
                held = [merged(held)]
                size = len(held[0][0])
            if size >= HELD_GRAMS // 2 and len(held) == 1:
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in held[0]], names=["gram", "c"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in merged(held)], names=["gram", "c"])

    return map_arrow(texts.select("text"), work, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """For counts of 1, 2, and 3 or more, from how many n-grams were seen once to four times."""
    row = counts.agg(*[F.count(F.when(F.col("c") == i, 1)) for i in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (max(x, 1) for x in row)
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(i - (i + 1) * y * b / a, 0.05), i - 0.05) for i, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1))


def probabilities(texts: DataFrame, table: np.ndarray, order: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """For each order 1..n: (gram, p, c) of the seen n-grams and (context, lam) of their contexts.

    Counts stay sharded by n-gram: lower orders count the distinct n-grams one longer
    (grouped by the gram without its first code), context sums are grouped by the gram
    without its last code and joined back, and the next lower order's p is joined on the gram
    without its first code.
    """
    counts = [write_once(top_counts(texts, table, order), "kn-counts")]
    for n in range(order - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << WIDTH * n) - 1))
        counts.insert(0, write_once(counts[0].groupBy(shorter.alias("gram")).agg(F.count("*").alias("c")), "kn-counts"))
    grams, contexts = [], []
    codes = n_codes(table)
    for n, seen in enumerate(counts, 1):
        d1, d2, d3 = discounts(seen)
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        rows = seen.select("gram", F.shiftright("gram", WIDTH).alias("context"), F.col("c").cast("double").alias("c"), cut.alias("cut"))
        sums = rows.groupBy("context").agg(F.sum("c").alias("total"), F.sum("cut").alias("held"))
        rows = rows.join(sums, "context")
        if n == 1:
            lower: Column = F.lit(1.0 / codes)
        else:
            rows = rows.withColumn("short", F.col("gram").bitwiseAND(F.lit((1 << WIDTH * (n - 1)) - 1)))
            rows = rows.join(grams[-1].select(F.col("gram").alias("short"), F.col("p").alias("low")), "short")
            lower = F.col("low")
        p = (F.col("c") - F.col("cut") + F.col("held") * lower) / F.col("total")
        grams.append(write_once(rows.select("gram", p.alias("p"), "c"), "kn-probabilities"))
        contexts.append(sums.select("context", (F.col("held") / F.col("total")).alias("lam")))
    return grams, contexts


@dataclass
class Model:
    order: int
    table: np.ndarray
    grams: list  # by order: sorted keys, log p
    contexts: list  # by order: sorted keys, log lambda

    def _find(self, pair, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        known, values = pair
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return known[at] == keys, values[at]

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        """Natural log of P(code | the order-1 codes before it), for padded codes."""
        keys = gram_keys(codes, self.order)
        out, left = np.zeros(len(keys)), np.arange(len(keys))
        for n in range(self.order, 0, -1):
            own = keys[left] & ((1 << WIDTH * n) - 1)
            hit, value = self._find(self.grams[n - 1], own)
            out[left[hit]] += value[hit]
            left, own = left[~hit], own[~hit]
            if not len(left):
                return out
            seen, weight = self._find(self.contexts[n - 1], own >> WIDTH)
            out[left[seen]] += weight[seen]
        out[left] -= np.log(n_codes(self.table))
        return out


def _arrays(frame: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    rows = frame.select(key, F.log(value).alias(value)).toArrow().sort_by(key)
    return rows.column(0).to_numpy(), rows.column(1).to_numpy()


def collected(grams: list[DataFrame], contexts: list[DataFrame], table: np.ndarray, order: int) -> Model:
    """The whole model as sorted arrays, for models known to be small."""
    return Model(order, table, [_arrays(g, "gram", "p") for g in grams], [_arrays(c, "context", "lam") for c in contexts])


def head_values(grams: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and log p of the most frequent n-grams, down to the last count class (sixteen to a doubling) that fits as a whole."""
    level = F.floor(F.log2("c") * 16).cast("int")
    floor = None
    for row in sorted(grams.groupBy(level.alias("k")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["k"]):
        most -= row["n"]
        if most < 0:
            break
        floor = row["k"]
    return _arrays(grams.where(F.lit(False) if floor is None else level >= floor), "gram", "p")


@dataclass
class Sharded:
    """A model of any size: its tables stay in Spark, tasks get a bounded part of them.

    ``small`` is the whole model where it has at most that many rows; else ``head`` holds that many of the
    n-grams of the highest order.
    """

    order: int
    table: np.ndarray
    grams: list[DataFrame]
    contexts: list[DataFrame]
    small: Model | None
    head: tuple[np.ndarray, np.ndarray] | None

    def tail_values(self, wanted: DataFrame) -> DataFrame:
        """(gram, logp) for each ``gram``: from the longest n-gram seen, with the weights of all contexts seen on the way.

        Tables of the two lowest orders of contexts and the lowest of n-grams have at most one row a code.
        """
        known = wanted.select("gram").distinct()
        for n in range(self.order, 0, -1):
            own = F.col("gram").bitwiseAND(F.lit((1 << WIDTH * n) - 1))
            seen = self.grams[n - 1].select(F.col("gram").alias("_own"), F.log("p").alias(f"p{n}"))
            around = self.contexts[n - 1].select(F.col("context").alias("_around"), F.log("lam").alias(f"lam{n}"))
            known = known.join(F.broadcast(seen) if n == 1 else seen, own == F.col("_own"), "left").drop("_own")
            near = F.shiftright(own, WIDTH) == F.col("_around")
            known = known.join(F.broadcast(around) if n <= 2 else around, near, "left").drop("_around")
        value = F.lit(-float(np.log(n_codes(self.table))))
        for n in range(1, self.order + 1):
            value = F.coalesce(F.col(f"p{n}"), F.coalesce(f"lam{n}", F.lit(0.0)) + value)
        return known.select("gram", value.alias("logp"))


def sharded(grams: list[DataFrame], contexts: list[DataFrame], table: np.ndarray, order: int, most: int | None = None) -> Sharded:
    most = HEAD_ROWS if most is None else most
    contexts = [write_once(c, "kn-contexts") for c in contexts]
    if sum(frame.count() for frame in [*grams, *contexts]) <= most:
        return Sharded(order, table, grams, contexts, collected(grams, contexts, table, order), None)
    return Sharded(order, table, grams, contexts, None, head_values(grams[-1], most))


def in_fitted_half() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.lit(3)) % 2 == 0


def trusted_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, fit): ids of documents whose labels all say good quality; ``fit`` is the half of them, by hash, that is fitted on."""
    trusted = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q")).where(F.col("q") == 1)
    return trusted.select("doc_id", in_fitted_half().alias("fit"))


def training_ids(labels: DataFrame) -> DataFrame:
    """(doc_id) of the trusted documents that are fitted on: all of one half of them; all of the other set the thresholds."""
    return write_once(trusted_labels(labels).where("fit").select("doc_id"), "kn-ids")


def fit_model(docs: DataFrame, chosen: DataFrame, order: int, longest: int | None = None, most: int | None = None) -> Sharded | None:
    """From the whole texts under the ``chosen`` ids; with ``longest``, from those of at most so many bytes."""
    size = F.octet_length("text")
    texts = docs.where(in_fitted_half() & (size > 0 if longest is None else size.between(1, longest))).select("doc_id", "text")
    texts = write_once(texts.join(chosen, "doc_id", "left_semi").select("text"), "kn-texts")
    if texts.isEmpty():
        return None
    table = code_table(texts)
    return sharded(*probabilities(texts, table, order), table, order, most)


def _scores(docs: DataFrame, model: Sharded) -> DataFrame:
    """(doc_id, lang, surprise, n_chars) of each text; n-grams that tasks have no value of are joined, each once a text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.order, model.table, model.small and vars(model.small), model.head))
    names = ["row", "doc_id", "lang", "surprise", "n_chars", "tail"]
    tail_type = pa.list_(pa.struct([("gram", pa.int64()), ("n", pa.int64())]))

    def tail_array(tails: list[np.ndarray]) -> pa.Array:
        found = [np.unique(keys, return_counts=True) for keys in tails]
        ends = np.cumsum([0, *[len(grams) for grams, _ in found]]).astype(np.int32)
        grams, counts = (np.concatenate([f[k] for f in found] or [np.zeros(0)]).astype(np.int64) for k in (0, 1))
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(grams), pa.array(counts)], ["gram", "n"])).cast(tail_type)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, table, small, head = shared.value
        whole = small and Model(**small)
        number = TaskContext.get().partitionId() << 40

        def known(codes: np.ndarray) -> tuple[float, np.ndarray]:
            if whole:
                return float(whole.log_probability(codes).sum()), np.zeros(0, np.int64)
            keys, (grams, values) = gram_keys(codes, order), head
            if not len(grams):
                return 0.0, keys
            at = np.minimum(np.searchsorted(grams, keys), len(grams) - 1)
            hit = grams[at] == keys
            return float(values[at[hit]].sum()), keys[~hit]

        for batch in batches:
            done, held = 0, 0
            sums, sizes, tails = [], [], []
            for i, text in enumerate(batch.column(2)):
                points = code_points(text.as_py())
                codes = padded(encoded(points, table), order)
                total, missing = 0.0, [np.zeros(0, np.int64)]
                for at in range(0, max(len(codes) - order + 1, 0), PART):  # long texts in parts
                    value, rest = known(codes[at : at + PART + order - 1])
                    total -= value
                    missing.append(rest)
                sums.append(total)
                sizes.append(len(points))
                tails.append(np.concatenate(missing))
                held += len(tails[-1])
                if held >= PART or i + 1 == batch.num_rows:
                    rows = np.arange(number, number + len(sums))
                    number += len(sums)
                    own = batch.slice(done, len(sums))
                    arrays = [pa.array(rows), own.column(0), own.column(1), pa.array(sums, pa.float64()), pa.array(sizes, pa.int64()), tail_array(tails)]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
                    done, held = i + 1, 0
                    sums, sizes, tails = [], [], []

    schema = "row long, doc_id long, lang string, surprise double, n_chars long, tail array<struct<gram: long, n: long>>"
    scored = map_arrow(docs.select("doc_id", "lang", "text"), work, schema)
    if model.small:
        return write_once(scored.drop("row", "tail"), "kn-scores")
    scored = write_once(scored, "kn-parts")
    tail = scored.select("row", F.inline("tail"))
    rest = tail.join(model.tail_values(tail), "gram").groupBy("row").agg(F.sum(F.col("n") * F.col("logp")).alias("rest"))
    surprise = F.col("surprise") - F.coalesce("rest", F.lit(0.0))
    whole = scored.drop("tail").join(rest, "row", "left").select("doc_id", "lang", surprise.alias("surprise"), "n_chars")
    return write_once(whole, "kn-scores")


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    order: int = 4,
    quantile: float = 0.99,
    margin: float = 1.0,
    prior: int = 60,
    head_rows: int | None = None,
) -> DataFrame:
    """One row per document: doc_id, lang, n_chars, perplexity, threshold, kept.

    Fitted on the whole texts of one half (by hash) of the documents labelled as good. The model stays in Spark's tables, tasks get ``head_rows`` rows of it, and n-grams beyond
    these are joined: no result depends on that number. A document's perplexity is that of its whole text, per character, drawn to the trusted mean as
    if ``prior`` average characters were added, so that a few odd characters don't condemn a short
    text. The threshold of a language comes from all other documents labelled as good in it:
    in logarithms, their ``quantile`` plus ``margin`` times its distance from their median.
    Languages without such documents (null as well) take those of all languages together.

    Null and empty texts have the mean perplexity and are kept; null ids keep their rows; rows
    repeated under one id are judged each; without trusted documents all are kept, with null
    figures; an empty table gives no rows. Other columns are ignored.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text_bytes("text").alias("text"))
    chosen = training_ids(labels)
    model = fit_model(narrow, chosen, order, most=head_rows)
    if model is None:
        nothing = F.lit(None).cast("double")
        length = F.char_length(F.col("text").cast("string")).cast("long")
        return narrow.select("doc_id", "lang", length.alias("n_chars"), nothing.alias("perplexity"), nothing.alias("threshold"), F.lit(True).alias("kept"))
    scored = _scores(narrow, model)
    unseen = trusted_labels(labels).join(chosen, "doc_id", "left_anti")
    judged = scored.join(unseen, "doc_id", "left_semi")
    mean = judged.agg(F.sum("surprise") / F.sum("n_chars")).first()[0]
    if mean is None:
        mean = scored.agg(F.sum("surprise") / F.greatest(F.sum("n_chars"), F.lit(1))).first()[0] or 0.0
    level = (F.col("surprise") + prior * float(mean)) / (F.col("n_chars") + prior)
    limit = lambda of: (of[1] + margin * (of[1] - of[0])).alias("limit")
    both = F.percentile_approx(level, [0.5, quantile], 10_000)
    by_lang = judged.where(F.col("lang").isNotNull()).groupBy("lang").agg(limit(both))
    overall = judged.agg(limit(both)).first()[0]
    limits = F.coalesce("limit", F.lit(overall).cast("double"))
    return scored.join(by_lang, "lang", "left").select(
        "doc_id",
        "lang",
        "n_chars",
        F.exp(level).alias("perplexity"),
        F.exp(limits).alias("threshold"),
        F.coalesce(level <= limits, F.lit(True)).alias("kept"),
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The documents that are kept, with all their columns; an id with a rejected row goes. Null ids stay."""
    bad = classify_quality(docs, labels, **settings).where(~F.col("kept") & F.col("doc_id").isNotNull())
    return docs.join(bad.select("doc_id").distinct(), "doc_id", "left_anti")
