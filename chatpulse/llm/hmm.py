"""Language-model scores from a hidden Markov model trained over the whole corpus.

A text is its words (see ``words_of``) and one closing token. Frequent words are symbols of
their own; all others fall into classes by their last byte, and a word's share of its class is
its smoothed corpus count. The model is a proper distribution over texts:
P(text) = sum over state paths of start * transitions * emissions * shares.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatpulse.llm.common import map_arrow, text_bytes, words_of, write_once
from chatpulse.session import small_batches

CLASSES = 256
LOG10 = np.log(10.0)
#: Distinct words that a task counts before it sends them; symbols that it runs its recursions over at a time.
COUNTED_WORDS, STEPPED = 250_000, 200_000


def held_out_id(doc_id, folds: int = 5, fold: int = 1) -> bool:
    return doc_id is not None and crc32(str(doc_id).encode()) % folds == fold


@dataclass
class Corpus:
    """Training counts: tokens and distinct tokens, closing tokens included, and those of each class."""

    tokens: int
    distinct: int
    texts: int
    head: dict  # word -> (rank, count)
    symbols: int  # so many of the head are symbols of their own
    class_tokens: np.ndarray
    class_words: np.ndarray

    def log_base(self, count):
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


@dataclass
class Model:
    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray  # symbols x states, columns sum to 1


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over the training texts; every task sends a word once for each of its slices."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"]
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not held_out_id(doc_id):
                    counts.update(words_of(text.as_py()))
                if len(counts) > COUNTED_WORDS:
                    yield flush()
                    counts.clear()
        yield flush()

    return map_arrow(docs, work, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def corpus_counts(counts: DataFrame, texts: int, head_words: int, symbols: int) -> Corpus:
    """``head_words`` bounds what is collected: all words of the highest counts, down to the last
    count class (sixteen to a doubling) that still fits as a whole. Ties need no rule."""
    total = counts.agg(F.sum("c"), F.count("*")).first()
    level = F.floor(F.log2("c") * 16).cast("int")
    floor, room = None, head_words
    for row in sorted(counts.groupBy(level.alias("k")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["k"]):
        room -= row["n"]
        if room < 0:
            break
        floor = row["k"]
    head = [] if floor is None else counts.where(level >= floor).collect()
    head.sort(key=lambda row: (-row["c"], bytes(row["word"])))
    known = {bytes(row["word"]): (i, row["c"]) for i, row in enumerate(head)}
    last = F.conv(F.hex(F.substring("word", -1, 1)), 16, 10).cast("int")
    per_class = np.zeros((2, CLASSES), np.int64)
    for row in counts.groupBy(last.alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        per_class[:, row["k"]] = row["c"], row["n"]
    symbols = min(symbols, len(known))
    for word, (rank, c) in known.items():
        if rank < symbols:
            per_class[:, word[-1]] -= (c, 1)
    return Corpus((total[0] or 0) + texts, total[1] + (texts > 0), texts, known, symbols, per_class[0], per_class[1])


def encode(docs: DataFrame, corpus: Corpus) -> DataFrame:
    """One row per text: symbols, tokens, and what the counts of head words tell.

    row, doc_id, held_out, n_tokens, symbols (32-bit), known, base (both over head words and the
    closing token), class_share (log10 of the words' shares of their classes, summed; of tail words
    the denominators only), tail (the words outside the head).
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(corpus))
    names = "row doc_id held_out n_tokens known base class_share symbols tail".split()
    tail = pa.list_(pa.struct([("word", pa.binary()), ("tf", pa.int32())]))
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), tail]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus = Corpus(**shared.value)
        size = corpus.symbols
        head = np.array([c for _, c in corpus.head.values()], float)
        log_base, log_count = corpus.log_base(head), np.log10(head + 0.5)
        closing = corpus.log_base(float(corpus.texts))
        rank = {w: i for w, (i, _) in corpus.head.items()}
        share = -np.log10(corpus.class_tokens + 0.5 * (corpus.class_words + 1))
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                symbols = np.fromiter((rank.get(w, -1) for w in words), np.int32, len(words))
                classed = np.flatnonzero((symbols < 0) | (symbols >= size))
                kinds_of = np.fromiter((words[i][-1] for i in classed.tolist()), np.int32, len(classed))
                counted = symbols[symbols >= 0]
                rest = Counter(words[i] for i in np.flatnonzero(symbols < 0).tolist())
                shares = share[kinds_of].sum() + log_count[counted[counted >= size]].sum()
                symbols[classed] = size + kinds_of
                number += 1
                rows.append((
                    number, doc_id, held_out_id(doc_id), len(words) + 1, len(counted) + (corpus.texts > 0),
                    float(log_base[counted].sum() + closing), float(shares),
                    np.append(symbols, np.int32(size + CLASSES)).astype("<i4").tobytes(),
                    [{"word": w, "tf": n} for w, n in rest.items()],
                ))
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return map_arrow(
        docs, work,
        "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, class_share double, "
        "symbols binary, tail array<struct<word: binary, tf: int>>",
    )


def by_step(texts: list[np.ndarray], budget: int = STEPPED) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of texts of like length, laid out step by step: (which texts, symbols, offsets of the steps)."""
    lengths = np.array([len(t) for t in texts])
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        end = at + 1
        total = lengths[order[at]]
        while end < len(order) and total + lengths[order[end]] <= budget and 2 * lengths[order[end]] + 64 >= lengths[order[at]]:
            total += lengths[order[end]]
            end += 1
        group = order[at:end]
        own = lengths[group]
        steps = np.arange(total) - np.repeat(np.cumsum(own) - own, own)
        symbols = np.concatenate([texts[i] for i in group])[np.argsort(steps, kind="stable")]
        yield group, symbols, np.concatenate([[0], np.cumsum(np.bincount(steps))])
        at = end


def forward(model: Model, symbols: np.ndarray, offsets: np.ndarray, texts: int, keep: bool):
    """Scaled forward recursion: (log likelihoods, scaled alphas, scales); alphas only if asked for."""
    alphas = model.emit[symbols]  # becomes them in place
    scales = np.empty(len(symbols))
    ones = np.ones(len(model.start))
    before = None
    for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        a = alphas[s:e]
        a *= model.start if before is None else before[: e - s] @ model.step
        c = np.matmul(a, ones, out=scales[s:e])
        a /= c[:, None]
        before = a
    logs = np.log(scales)
    likelihood = np.zeros(texts)
    widths = np.diff(offsets)
    likelihood += np.bincount(np.arange(len(symbols)) - np.repeat(offsets[:-1], widths), logs, texts)
    return likelihood, alphas if keep else None, scales


def expected_counts(model: Model, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, step and emission counts expected under the model."""
    states = len(model.start)
    start, step, emit = np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit)
    for group, symbols, offsets in by_step(texts):
        _, alphas, scales = forward(model, symbols, offsets, len(group), keep=True)
        ahead = model.emit[symbols]
        ahead /= scales[:, None]
        betas = np.ones_like(alphas)
        back = np.ascontiguousarray(model.step.T)
        bounds = offsets.tolist()
        for s, m, e in zip(bounds[-3::-1], bounds[-2:0:-1], bounds[:1:-1]):
            ahead[m:e] *= betas[m:e]
            np.matmul(ahead[m:e], back, out=betas[s : s + e - m])
        widths = np.diff(offsets)
        step += alphas[np.arange(bounds[1], bounds[-1]) - np.repeat(widths[:-1], widths[1:])].T @ ahead[bounds[1] :]
        gamma = np.multiply(alphas, betas, out=betas)
        start += gamma[: offsets[1]].sum(0)
        for k in range(states):
            emit[:, k] += np.bincount(symbols, gamma[:, k], len(emit))
    return start, step * model.step, emit


def first_model(corpus: Corpus, states: int, seed: int = 11) -> Model:
    """Sticky transitions; each state's emissions are the corpus shares tilted at random."""
    random = np.random.default_rng(seed)
    share = np.concatenate([[c for _, c in corpus.head.values()][: corpus.symbols], corpus.class_tokens + 0.5, [corpus.texts + 0.5]]).astype(float)
    emit = share[:, None] * random.dirichlet(np.full(states, 2.0), len(share))
    emit[-1] = share[-1] / states
    step = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
    return Model(np.full(states, 1 / states), step, emit / emit.sum(0))


def trained(encoded: DataFrame, corpus: Corpus, states: int, rounds: int) -> Model:
    """Baum-Welch over all training texts.

    Each round a task adds up the counts expected from its texts and sends one row for each
    symbol it has seen; rows are summed by symbol, so the driver gets one row per symbol.
    The number of symbols is bounded by a parameter.
    """
    model = first_model(corpus, states)
    spark = encoded.sparkSession
    training = encoded.where(~F.col("held_out")).select("symbols")
    size = len(model.emit)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(vars(model))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            model = Model(**shared.value)
            start, step, emit = np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit)
            for batch in batches:
                texts = [np.frombuffer(x.as_py(), "<i4") for x in batch.column(0)]
                found = expected_counts(model, texts)
                start += found[0]
                step += found[1]
                emit += found[2]
            seen = np.flatnonzero(emit.any(1))
            at = np.concatenate([seen, np.arange(size, size + states + 1)])
            values = np.concatenate([emit[seen], step, start[None]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(at)] + [pa.array(values[:, k]) for k in range(states)], names=["at"] + [f"s{k}" for k in range(states)]
            )

        parts = map_arrow(training, work, "at long, " + ", ".join(f"s{k} double" for k in range(states)))
        sums = parts.groupBy("at").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(states)])
        table = np.zeros((size + states + 1, states))
        for row in sums.collect():
            table[row[0]] = row[1:]
        shared.unpersist()
        emit, step, start = table[:size] + model.emit * 0.1, table[size:-1] + 0.1, table[-1] + 0.1
        emit[-1] += 1e-3
        model = Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0))
    return model


def _likelihoods(encoded: DataFrame, model: Model) -> DataFrame:
    shared = encoded.sparkSession.sparkContext.broadcast(vars(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for batch in batches:
            texts = [np.frombuffer(x.as_py(), "<i4") for x in batch.column(1)]
            out = np.zeros(len(texts))
            for group, symbols, offsets in by_step(texts):
                out[group] = forward(model, symbols, offsets, len(group), keep=False)[0] / LOG10
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["row", "hmm"])

    return map_arrow(encoded.select("row", "symbols"), work, "row long, hmm double")


def score_texts(
    docs: DataFrame,
    states: int = 8,
    symbols: int = 20_000,
    head_words: int = 100_000,
    rounds: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per text: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from all texts whose crc32(id as text) mod 5 is not 1. ``base_score`` is the smoothed
    unigram's log10 probability, ``score`` the hidden Markov model's by the scaled forward
    recursion, exact for texts of any length. Counts of frequent words travel as a table of
    ``head_words`` words; the others' counts are joined to the texts that hold them.

    Null and empty texts are the closing token alone; null ids count as training rows; rows
    repeated under one id are scored each; an empty table gives none. With no training text
    every count is zero and the model is the uniform start.
    """
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_bytes(text_column).alias("text"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id")).where(F.coalesce(fold, F.lit(True))).count()
    with small_batches(docs.sparkSession):
        counts = write_once(word_counts(narrow), "hmm-counts")
        corpus = corpus_counts(counts, texts, head_words, symbols)
        encoded = write_once(encode(narrow, corpus), "hmm-symbols")
        model = trained(encoded, corpus, states, rounds)
        likelihoods = write_once(_likelihoods(encoded, model), "hmm-likelihoods")
    tail = encoded.select("row", F.explode("tail").alias("w")).select("row", "w.word", "w.tf")
    joined = tail.join(counts, "word", "left").select("row", "tf", F.coalesce("c", F.lit(0)).alias("c"))
    sums = joined.groupBy("row").agg(
        F.sum(F.col("tf") * F.log10(F.col("c") + 0.5)).alias("logs"),
        F.sum("tf").alias("n"),
        F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("seen"),
    )
    logs = F.coalesce("logs", F.lit(0.0))
    spread = float(np.log10(corpus.tokens + 0.5 * (corpus.distinct + 1)))
    whole = encoded.drop("symbols", "tail").join(likelihoods, "row").join(sums, "row", "left")
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.coalesce("n", F.lit(0)) * spread).alias("base_score"),
        (F.col("hmm") + F.col("class_share") + logs).alias("score"),
    )
