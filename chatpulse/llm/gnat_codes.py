"""Vector code compression: integer codebooks per part, nearest entries found through a GNAT."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatpulse.llm.common import map_arrow, write_once

SCALE = 4096
LIMB = 32
#: Largest magnitude of a component whose squared distances fit 62 bits, before the part's length is taken in.
NARROW = 1 << 30


def quantised(value: float) -> int:
    """floor(4096 * value), also where 4096 * value is no double any more."""
    return math.floor(value * SCALE) if abs(value) < 2.0**52 else int(value) * SCALE


def usable_vectors(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """Whether a row's vector and all its components are there and finite."""
    column = batch.column(batch.schema.get_field_index(name))
    there = np.array(column.is_valid().to_numpy(zero_copy_only=False))
    lengths = column.value_lengths().fill_null(0).to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes nan
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    ends = np.cumsum(lengths)
    return there & (bad[ends] == bad[ends - lengths])


def part_length(entries: list[list[int]]) -> int:
    return len(entries[0]) if entries else 0


class Gnat:
    """Entries of one codebook in a tree of split points (geometric near-neighbour access).

    A node's split points are entries far apart; every other entry of the node hangs below its nearest
    split point. For each split point and each child the node keeps the least and the largest distance
    from that point to the child's entries, rounded outward. A query knows its distances
    to the split points; a child whose whole range lies strictly farther away than the best
    entry so far, seen from any split point, can hold neither a nearer entry nor one as
    near, so its subtree is left out. Distances are compared as whole numbers, ties go
    to the lower index; rounded roots only ever decide what is surely too far.
    """

    def __init__(self, entries: list[list[int]], degree: int = 4):
        self.entries, self.degree = entries, degree
        self.reach = max((abs(x) for e in entries for x in e), default=0)
        self.narrow = NARROW >> (max(part_length(entries), 1).bit_length() + 1) // 2
        self.points = np.array(entries, np.int64) if self.reach < self.narrow else None
        self.root = self._node(list(range(len(entries)))) if self.points is not None else None
        self.compared = self.possible = 0

    def _exact(self, a: int, b: int) -> int:
        return sum((x - y) ** 2 for x, y in zip(self.entries[a], self.entries[b]))

    def _node(self, members: list[int]):
        splits = members[:1]
        while len(splits) < min(self.degree, len(members)):
            splits.append(max((m for m in members if m not in splits), key=lambda m: (min(self._exact(m, s) for s in splits), -m)))
        below: list[list[int]] = [[] for _ in splits]
        for m in members:
            if m not in splits:
                below[min(range(len(splits)), key=lambda i: (self._exact(m, splits[i]), i))].append(m)
        ranges = [
            [
                (math.nextafter(math.sqrt(min(d)), -math.inf), math.nextafter(math.sqrt(max(d)), math.inf)) if d else None
                for d in ([self._exact(s, m) for m in child] for child in below)
            ]
            for s in splits
        ]
        return splits, [self._node(child) if child else None for child in below], ranges

    def _visit(self, node, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, which: np.ndarray) -> None:
        splits, children, ranges = node
        roots = []
        for s in splits:
            gap = queries[rows] - self.points[s]
            far = np.einsum("ij,ij->i", gap, gap)
            self.compared += len(rows)
            better = (far < best[rows]) | ((far == best[rows]) & (s < which[rows]))
            best[rows[better]], which[rows[better]] = far[better], s
            roots.append(np.sqrt(far.astype(np.float64)))
        # Converting and taking the root round by less than one part in 2**51 together.
        low, high = [r * (1 - 2.0**-50) for r in roots], [r * (1 + 2.0**-50) for r in roots]
        for j, child in enumerate(children):
            if child is None:
                continue
            radius = np.sqrt(best[rows].astype(np.float64)) * (1 + 2.0**-50)
            alive = np.ones(len(rows), bool)
            for i in range(len(splits)):
                least, most = ranges[i][j]
                gone = np.maximum(low[i] - most, least - high[i])
                alive &= ~(gone * (1 - 2.0**-50) > radius)
            if alive.any():
                self._visit(child, queries, rows[alive], best, which)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each query; whole numbers, int64 or Python's."""
        self.possible += len(queries) * len(self.entries)
        if self.root is not None and queries.dtype != object:
            best = np.full(len(queries), np.iinfo(np.int64).max)
            which = np.full(len(queries), len(self.entries), np.int64)
            self._visit(self.root, queries, np.arange(len(queries)), best, which)
            return which, best
        # Numbers too large for 64 bits: every entry is compared, in whole numbers of any size.
        self.compared += len(queries) * len(self.entries)
        found = [
            min((sum((int(x) - y) ** 2 for x, y in zip(q, e)), i) for i, e in enumerate(self.entries)) for q in queries
        ]
        return np.array([i for _, i in found], np.int64), np.array([d for d, _ in found] + [None], object)[:-1]


def whole_numbers(flat: np.ndarray, narrow: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of quantised components: (row numbers, int64 matrix) and, for rows with large ones, (row numbers, object matrix)."""
    wide = (np.abs(flat) >= narrow / SCALE).any(axis=1)
    out = []
    if not wide.all():
        rows = np.flatnonzero(~wide)
        out.append((rows, np.floor(flat[rows] * SCALE).astype(np.int64)))
    if wide.any():
        rows = np.flatnonzero(wide)
        out.append((rows, np.array([[quantised(x) for x in v] for v in flat[rows].tolist()] + [None], object)[:-1]))
    return out


def _columns(values: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Some components of each row; rows of large numbers are lists."""
    if values.dtype != object:
        return values[:, start:stop]
    return np.array([list(v)[start:stop] for v in values] + [None], object)[:-1]


class Codebooks:
    """One list of entries for each part of the vector."""

    def __init__(self, entries: list[list[list[int]]]):
        self.entries = entries
        self.parts, self.length = len(entries), part_length(entries[0]) if entries else 0
        self.trees = [Gnat(e) for e in entries]
        self.narrow = min((t.narrow for t in self.trees), default=NARROW)

    def assign(self, batch: pa.RecordBatch, name: str):
        """Yields (row numbers, quantised rows, entry of each part, squared distance of each part) of the vectors that fit."""
        column = batch.column(batch.schema.get_field_index(name))
        lengths = column.value_lengths().fill_null(0).to_numpy()
        fit = usable_vectors(batch, name) & (lengths == self.parts * self.length)
        rows = np.flatnonzero(fit)
        if not len(rows) or not self.length:
            return
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        for some, values in whole_numbers(flat.reshape(len(rows), -1), self.narrow):
            spans = [(k * self.length, (k + 1) * self.length) for k in range(self.parts)]
            found = [tree.nearest(_columns(values, a, b)) for tree, (a, b) in zip(self.trees, spans)]
            yield rows[some], values, np.stack([f[0] for f in found], 1), [f[1] for f in found]

    def digest(self) -> str:
        listed = ",".join(str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(listed.encode()).hexdigest()


def limbs(value: int) -> list[int]:
    """Digits to the base 2^32, lowest first; only the last one carries the sign."""
    out = []
    while not -(1 << LIMB - 1) <= value < 1 << LIMB - 1:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def first_entries(vectors: DataFrame, parts: int, entries: int, id_column: str, vector_column: str) -> Codebooks:
    """The parts of the ``entries`` usable vectors with the smallest ids, whose length the first of them sets."""
    vector = F.col(vector_column).cast("array<double>")
    sound = vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    known = vectors.select(F.col(id_column).cast("long").alias("id"), vector.alias("v")).where(sound & (F.size(vector) % parts == 0))
    order = (F.col("id").asc_nulls_last(), "v")
    first = known.orderBy(*order).limit(1).collect()
    if not first:
        return Codebooks([[] for _ in range(parts)])
    rows = known.where(F.size("v") == len(first[0]["v"])).orderBy(*order).limit(entries).collect()
    whole = [[quantised(x) for x in r["v"]] for r in rows]
    length = len(whole[0]) // parts
    return Codebooks([[v[k * length : (k + 1) * length] for v in whole] for k in range(parts)])


def improved(vectors: DataFrame, books: Codebooks, vector_column: str) -> Codebooks:
    """Each entry replaced by the floored mean of the parts it is nearest to; entries without parts stay.

    Tasks add their parts up by entry; what is shuffled and comes back is bounded by the codebooks. Sums
    travel as 32-bit digits, so that they stay whole numbers whatever the size of the table.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for _, values, codes, _ in books.assign(batch, vector_column):
                for part in range(books.parts):
                    span = _columns(values, part * books.length, (part + 1) * books.length)
                    for entry in np.unique(codes[:, part]).tolist():
                        own = span[codes[:, part] == entry]
                        added = own.sum(0).tolist() if own.dtype != object else [sum(x) for x in zip(*own)]
                        total = sums.setdefault((part, entry), [0] * (books.length + 1))
                        sums[part, entry] = [a + b for a, b in zip(total, [*added, len(own)])]
        out = [(p, e, at, k, d) for (p, e), s in sums.items() for at, x in enumerate(s) for k, d in enumerate(limbs(x))]
        columns = list(zip(*out)) or [()] * 5
        types = [pa.int32()] * 4 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["part", "entry", "at", "limb", "digits"])

    sums = map_arrow(vectors.select(vector_column), work, "part int, entry int, at int, limb int, digits long")
    totals: dict[tuple[int, int, int], int] = {}
    for r in sums.groupBy("part", "entry", "at", "limb").agg(F.sum("digits").alias("digits")).collect():
        key = (r["part"], r["entry"], r["at"])
        totals[key] = totals.get(key, 0) + (r["digits"] << LIMB * r["limb"])
    return Codebooks([
        [
            [totals[p, e, at] // totals[p, e, books.length] for at in range(books.length)] if (p, e, 0) in totals else old
            for e, old in enumerate(entries)
        ]
        for p, entries in enumerate(books.entries)
    ])


def fit_codebooks(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> Codebooks:
    """Codebooks after ``rounds`` rounds over all vectors; a round that changes nothing ends them, as all others would."""
    books = first_entries(vectors, parts, entries, id_column, vector_column)
    for _ in range(rounds if books.length else 0):
        better = improved(vectors, books, vector_column)
        if better.entries == books.entries:
            break
        books = better
    return books


def compress_vectors(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256.

    A component x becomes floor(4096 x); vectors are cut into ``parts`` equal parts. A part's code is the index of its
    nearest codebook entry (two hex digits), the lower one of ties; ``error`` adds the squared
    distances, ``label_error`` adds the errors of a label. All of it is whole-number arithmetic,
    so that neither the order of rows nor their partitions matter.

    Every round is one pass without a shuffle of vectors. The codebooks are the only thing tasks are
    given, and parts times entries rows the only thing that comes back. Errors combine by label
    before they move, so a label of any share of the rows is one row a task.

    Left out: vectors that are null, empty, or hold null or non-finite components, and those whose length isn't
    that of the usable one with the smallest id (which must be a multiple of ``parts``). Null ids come last among the first
    entries; repeated ids keep their rows; fewer vectors than ``entries`` give fewer entries; null
    labels are one label; an empty table gives no rows; other columns are ignored. Components too
    large for 64-bit distances are compared in whole numbers of any size; an error beyond a
    long is null then, as is the error of its label.
    """
    if not 0 < entries <= 256:
        raise ValueError("two hex digits number at most 256 entries")
    books = fit_codebooks(vectors, parts, entries, rounds, id_column, vector_column)
    narrow = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).alias("label"), F.col(vector_column).alias("embedding")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, codes, far in books.assign(batch, "embedding"):
                kept = batch.take(pa.array(rows))
                errors = [sum(map(int, x)) for x in zip(*(f.tolist() for f in far))]
                columns = [
                    kept.column(0), kept.column(1),
                    pa.array([bytes(c).hex() for c in codes.astype(np.uint8)]),
                    pa.array([e if e < 1 << 63 else None for e in errors], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    label_type = narrow.schema["label"].dataType.simpleString()
    coded = write_once(map_arrow(narrow, work, f"vec_id long, label {label_type}, code string, error long"), "vector-codes")
    whole = F.sum(F.col("error").cast("decimal(38,0)"))
    of_label = coded.groupBy(F.col("label").alias("same")).agg(
        F.when(F.count("error") == F.count("*"), whole).alias("total")
    )
    fits = F.col("total") <= F.lit((1 << 63) - 1).cast("decimal(38,0)")
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("same")), "left").select(
        "vec_id",
        "code",
        "error",
        F.when(fits, F.col("total").cast("long")).alias("label_error"),
        F.lit(books.digest()).alias("codebooks_sha256"),
    )
