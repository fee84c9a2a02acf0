"""Severity of toxic language by cumulative-link ordinal regression on words."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatpulse.functions.packed import id_filter
from chatpulse.llm.common import map_arrow, text_bytes, write_once
from chatpulse.llm.decontaminate import plain_words
from chatpulse.llm.vocabulary import squeeze, unsqueeze

GRADES = 4  # 0 none, 1 mild, 2 clear, 3 severe


#: Bytes of the word beginnings that count as features, so that inflected forms share what they tell.
STEMS = (4, 5, 6)
#: Features of texts that a task counts before it sends them.
COUNTED = 1 << 21


def features(text: bytes) -> np.ndarray:
    """Distinct words and word beginnings, hashed to 32 bits."""
    words = set(plain_words(text))
    found = set(map(crc32, words))
    for n in STEMS:
        found.update(map(crc32, {w[:n] + b"*" for w in words if len(w) > n}))
    return np.fromiter(found, np.int64, len(found))


@dataclass
class Model:
    features: np.ndarray  # sorted
    weights: np.ndarray  # of these, shared by all thresholds; all other features weigh nothing
    thresholds: np.ndarray  # ascending, GRADES - 1

    def expected(self, scores: np.ndarray) -> np.ndarray:
        """Sum over grades k >= 1 of P(grade >= k)."""
        return _sigmoid(scores[:, None] - self.thresholds).sum(1)

    def score(self, features: np.ndarray) -> float:
        at = np.minimum(np.searchsorted(self.features, features), len(self.features) - 1)
        return float(self.weights[at[self.features[at] == features]].sum())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def packed(found: np.ndarray) -> bytes:
    return squeeze(np.diff(np.sort(found), prepend=0))


def unpacked(data: bytes) -> np.ndarray:
    """Ascending features."""
    return np.cumsum(unsqueeze(data), dtype=np.int64)


def labelled_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic): all labelled ids; one is toxic if any of its labels says so."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    return marks.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def short(words: list[bytes]) -> bytes:
    """The distinct words in order, compressed: all that ``features`` takes from a text, in fewer bytes than its features."""
    return zlib.compress(b" ".join(sorted(set(words))), 3)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(toxic, n_words, features packed) of all labelled documents, whole; those that a small filter tells to have no label stay where they lie.

    Texts are made short where they lie. Only that moves: to the labels, then to its copies.
    """

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], []
            for text in batch.column(1):
                words = plain_words(text.as_py())
                sizes.append(len(words))
                found.append(short(words))
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "words"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [packed(features(zlib.decompress(x.as_py()))) for x in batch.column(2)]
            arrays = [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["toxic", "n_words", "features"])

    chosen = write_once(labelled_ids(labels), "toxicity-ids")
    near = docs.where(id_filter(chosen, "doc_id")(F.col("doc_id"))).select("doc_id", "text")
    texts = map_arrow(near, shortened, "doc_id long, n_words long, words binary")
    # Merged at every size: the labels grow with the documents, so no task should hold them all.
    marked = texts.join(chosen.hint("merge"), "doc_id").select("toxic", "n_words", "words")
    # Copies of one text count once.
    return write_once(map_arrow(marked.distinct(), work, "toxic long, n_words long, features binary"), "toxicity-rows")


def feature_counts(rows: DataFrame) -> DataFrame:
    """(f, t, c): toxic and other texts that hold a feature; those of a task are added up before they are sent."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held or [np.empty(0, np.int64)]), return_counts=True)
            toxic = keys & 1
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (keys >> 1, n * toxic, n * (1 - toxic))], names=["f", "t", "c"])

        for batch in batches:
            for toxic, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.append(unpacked(data.as_py()) << 1 | toxic)
                size += len(held[-1])
                if size >= COUNTED:
                    yield counted()
                    held, size = [], 0
        yield counted()

    parts = map_arrow(rows.select("toxic", "features"), work, "f long, t long, c long")
    return parts.groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def chance(t: np.ndarray, c: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Probability that a feature of t + c texts lies as unevenly in the n1 toxic and n0 other ones by chance.

    Twice the smaller tail of the hypergeometric distribution, exact however rare the feature is.
    """
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n1 + n0 + 1)))])
    choose = lambda n, k: logs[n] - logs[k] - logs[n - k]
    out = np.ones(len(t))
    for i, (own, m) in enumerate(zip(t.tolist(), (t + c).tolist())):
        low, high = max(0, m - n0), min(m, n1)
        k = np.arange(own, high + 1) if own * (n1 + n0) >= m * n1 else np.arange(low, own + 1)
        out[i] = min(1.0, 2 * np.exp(choose(n1, k) + choose(n0, m - k) - choose(n1 + n0, m)).sum())
    return out


def telling_features(rows: DataFrame, least_z: float, by_chance: float, least_docs: int) -> dict[int, float]:
    """Features whose share of toxic and of other documents differs clearly, with their log odds ratio.

    Clearly: the two-proportion z is at least ``least_z``, and by the exact test less than ``by_chance``
    such features are to be expected among all those tried. No feature sets a bar for
    others, so the words of a frequent language don't hide those of a rare one.
    """
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return {}
    n1, n0 = sizes[1], sizes[0]
    seen = feature_counts(rows)
    t, c = F.col("t"), F.col("c")
    odds = F.log((t + 0.5) / (n1 + 0.5 - t)) - F.log((c + 0.5) / (n0 + 0.5 - c))
    p = (t + c) / (n1 + n0)
    z = F.abs(t / n1 - c / n0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / n1 + 1 / n0))
    tried = write_once(seen.where(t + c >= least_docs).select("f", "t", "c", odds.alias("odds"), z.alias("z")), "toxicity-features")
    among = tried.count()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clear = chance(batch.column(1).to_numpy(), batch.column(2).to_numpy(), n1, n0) * among < by_chance
            yield batch.select(["f", "odds"]).filter(pa.array(clear, pa.bool_()))

    clear = map_arrow(tried.where(F.col("z") >= least_z).select("f", "t", "c", "odds"), work, "f long, odds double")
    return {r["f"]: r["odds"] for r in clear.collect()}  # the model's own features


def graded(rows: DataFrame, odds: dict[int, float]) -> DataFrame:
    """(grade, features, weight): toxic documents are graded by how densely telling words stand in them.

    The labels tell toxic from not. Toxic documents fall into thirds of (telling toxic words
    per word), which gives the ordered grades 1 to 3; the others have grade 0. All rows weigh
    the same, so a text without telling words gets the severity of such texts among the labelled.
    Features are places among the telling ones in ascending order; all others are left out.
    """
    kept = np.array(sorted(odds), np.int64)
    shared = rows.sparkSession.sparkContext.broadcast((kept, np.array([odds[f] > 0 for f in kept.tolist()], bool)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, telling = shared.value
        for batch in batches:
            marks, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = [np.flatnonzero(np.isin(kept, unpacked(x.as_py()), assume_unique=True)) for x in batch.column(2)]
            density = [int(telling[own].sum()) / np.sqrt(max(n, 1)) if mark == 1 else None for mark, n, own in zip(marks, sizes, found)]
            arrays = [batch.column(0), pa.array(density, pa.float64()), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["toxic", "density", "features"])

    rows = write_once(map_arrow(rows.select("toxic", "n_words", "features"), work, "toxic long, density double, features array<int>"), "toxicity-grades")
    cuts = rows.agg(F.percentile_approx("density", [1 / 3, 2 / 3])).first()[0] or [0.0, 0.0]
    grade = F.when(F.col("toxic") == 0, 0).when(F.col("density") <= cuts[0], 1).when(F.col("density") <= cuts[1], 2).otherwise(3)
    return rows.select(grade.alias("grade"), "features", F.lit(1.0 / max(rows.count(), 1)).alias("weight"))


def gradient(model: Model, grades: np.ndarray, scores: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(loss, d loss / d score, d loss / d thresholds) of the cumulative logit."""
    cuts = np.concatenate([[-np.inf], model.thresholds, [np.inf]])
    over = _sigmoid(scores[:, None] - cuts[None, 1:-1])
    over = np.concatenate([np.ones((len(scores), 1)), over, np.zeros((len(scores), 1))], axis=1)
    at = np.arange(len(scores))
    low, high = over[at, grades], over[at, grades + 1]
    p = np.maximum(low - high, 1e-12)
    slope_low, slope_high = low * (1 - low), high * (1 - high)
    d_score = -weights * (slope_low - slope_high) / p
    d_cuts = np.zeros(len(model.thresholds) + 2)
    np.add.at(d_cuts, grades, weights * slope_low / p)
    np.add.at(d_cuts, grades + 1, -weights * slope_high / p)
    return float(-(weights * np.log(p)).sum()), d_score, d_cuts[1:-1]


def fit_model(rows: DataFrame, odds: dict[int, float], rounds: int = 40, rate: float = 0.4, ridge: float = 1e-4) -> Model:
    """Adam on full gradients, each summed over the partitions of the rows by parameter."""
    kept = np.array(sorted(odds), np.int64)
    size, cuts = len(kept), GRADES - 1
    training = graded(rows, odds)
    values = np.concatenate([np.array([0.5 * odds[f] for f in kept.tolist()]), [0.0, 1.0, 1.0]])
    first, second = np.zeros(size + cuts), np.zeros(size + cuts)

    def of(values: np.ndarray) -> Model:
        steps = np.concatenate([values[size : size + 1], np.exp(values[size + 1 :])])
        return Model(kept, values[:size], np.cumsum(steps))

    for t in range(1, rounds + 1):
        model = of(values)

        def work(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size + cuts)
            for batch in batches:
                grades, weights = batch.column(0).to_numpy().astype(np.int64), batch.column(2).to_numpy()
                lengths, at = batch.column(1).value_lengths().to_numpy(), batch.column(1).flatten().to_numpy()
                scores = np.bincount(np.repeat(np.arange(len(lengths)), lengths), model.weights[at], len(lengths))
                _, d_score, d_cuts = gradient(model, grades, scores, weights)
                total[size:] += d_cuts
                total += np.bincount(at, np.repeat(d_score, lengths), size + cuts)
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["at", "value"])

        parts = map_arrow(training, work, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
        total = np.zeros(size + cuts)
        for row in parts.collect():
            total[row["at"]] = row["value"]
        # A threshold is the first one plus exponentials of the steps between them.
        tail = np.cumsum(total[size:][::-1])[::-1]
        slope = np.concatenate([total[:size] + ridge * values[:size], tail[:1], tail[1:] * np.exp(values[size + 1 :])])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        values = values - rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8) / np.sqrt(t)
    return of(values)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    reject_at: float = 0.3,
    least_z: float = 4.0,
    by_chance: float = 0.05,
    least_docs: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, severity (expected grade, 0 to 3), toxic (severity >= ``reject_at``
    and more than that of a text without telling words).

    Fitted on the whole texts of all labelled documents, copies once. Every word and word beginning of a whole text counts once. Null and empty texts have the
    lowest severity; null ids keep their rows; rows repeated under one id are scored
    each; if the labels hold only one kind, or no word tells them apart, severity is 0
    throughout; an empty table gives no rows. Other columns are ignored.
    """
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_bytes(text_column).alias("text"))
    rows = training_rows(narrow, labels)
    odds = telling_features(rows, least_z, by_chance, least_docs)
    if not odds:
        return narrow.select("doc_id", F.lit(0.0).alias("severity"), F.lit(False).alias("toxic"))
    shared = docs.sparkSession.sparkContext.broadcast(vars(fit_model(rows, odds)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for batch in batches:
            scores = np.array([model.score(features(t.as_py())) for t in batch.column(1)])
            severity = model.expected(scores)
            toxic = (severity >= reject_at) & (scores > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(severity), pa.array(toxic, pa.bool_())], names=["doc_id", "severity", "toxic"]
            )

    return map_arrow(narrow, work, "doc_id long, severity double, toxic boolean")


def drop_toxic(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The documents that aren't toxic, with all their columns; an id with a toxic row goes. Null ids stay."""
    bad = score_toxicity(docs, labels, **settings).where(F.col("toxic") & F.col("doc_id").isNotNull())
    return docs.join(bad.select("doc_id").distinct(), "doc_id", "left_anti")
