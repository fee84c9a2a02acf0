"""Near-duplicate vectors by an epsilon grid order join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatpulse.llm.common import connected_components, map_arrow, write_once

#: Vectors compared at once inside a pair of blocks.
TILE = 256
#: Added to the pruning radius, so that rounding never skips a pair.
SLACK = 1e-6


def _unit(blob: bytes) -> np.ndarray:
    """The unit vector in doubles. A blob's first byte is the width of its numbers."""
    v = np.frombuffer(blob, f"<f{blob[0]}", offset=1).astype("<f8")
    with np.errstate(over="ignore"):
        norm = float(v @ v)
    if not 1e-200 < norm < math.inf:  # very large or small numbers, whose squares don't fit
        v = v / np.abs(v).max()
        norm = float(v @ v)
    return v / math.sqrt(norm)


def usable_vectors(frame: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, width, blob): the vector's own numbers packed; null where it can link with nothing."""
    kind = frame.schema[vector_column].dataType.elementType.simpleString()
    bits = 4 if kind == "float" else 8
    mark = bytes([bits])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = []
            for values in batch.column(1).to_pylist():
                v = None
                if values and None not in values:
                    v = np.array(values, "<f8")
                    if not np.isfinite(v).all() or not v.any():
                        v = None
                blobs.append(None if v is None else mark + v.astype(f"<f{bits}").tobytes())
            widths = [None if b is None else (len(b) - 1) // bits for b in blobs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(widths, pa.int64()), pa.array(blobs, pa.binary())], names=["vec_id", "width", "blob"]
            )

    narrow = frame.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast(f"array<{'float' if bits == 4 else 'double'}>").alias("v"))
    return map_arrow(narrow, work, "vec_id long, width long, blob binary")


def principal_axes(distinct: DataFrame, width: int, axes: int) -> np.ndarray:
    """Leading eigenvectors (width x axes) of the unit vectors' second moments, over all rows.

    Each task adds up its own moments; sums are combined by entry, so the driver gets
    width * width numbers however many rows there are.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            units = [u for u in map(_unit, batch.column(0).to_pylist()) if len(u) == width]
            if units:
                x = np.array(units)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], names=["at", "value"])

    sums = map_arrow(distinct.select("blob"), work, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    moments = np.zeros(width * width)
    for row in sums.collect():
        moments[row["at"]] = row["value"]
    return np.linalg.eigh(moments.reshape(width, width))[1][:, ::-1][:, :axes]


def _blocks(distinct: DataFrame, axes: np.ndarray, epsilon: float, block: int, grid: int) -> DataFrame:
    """Vectors in grid order as blocks of up to ``block``: pid, n, rows packed as bytes, bounding box."""
    width, k = axes.shape

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(0).to_pylist()
            low = np.zeros((len(blobs), k))
            for i, blob in enumerate(blobs):
                u = _unit(blob)
                low[i] = u @ axes if len(u) == width else 0.0
            cells = np.floor(low[:, :grid] / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)] + [pa.array(cells[:, j]) for j in range(grid)],
                names=["blob", "weight"] + [f"c{j}" for j in range(grid)],
            )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count, blobs, weights = TaskContext.get().partitionId(), 0, [], []

        def full(blobs, weights):
            units = map(_unit, blobs)
            low = np.array([u @ axes if len(u) == width else np.zeros(k) for u in units])
            names = ["pid", "local", "n", "blobs", "weights", "lo", "hi"]
            row = [task, count, len(blobs), blobs, weights, low.min(0).tolist(), low.max(0).tolist()]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names=names)

        for batch in batches:
            blobs += batch.column(0).to_pylist()
            weights += batch.column(1).to_pylist()
            while len(blobs) >= block:
                yield full(blobs[:block], weights[:block])
                blobs, weights, count = blobs[block:], weights[block:], count + 1
        if blobs:
            yield full(blobs, weights)

    cells = [f"c{j}" for j in range(grid)]
    placed = map_arrow(distinct, place, "blob binary, weight long, " + ", ".join(f"{c} int" for c in cells))
    ordered = placed.repartitionByRange(*cells, "blob").sortWithinPartitions(*cells, "blob").select("blob", "weight")
    return map_arrow(
        ordered, gather, "pid long, local long, n long, blobs array<binary>, weights array<long>, lo array<double>, hi array<double>"
    )


def _near(a: str, b: str, k: int, radius: float):
    """Squared gap between two boxes is within the radius: projected distance never exceeds the real one."""
    gap = None
    for j in range(k):
        lo_a, hi_a = F.col(f"{a}lo")[j], F.col(f"{a}hi")[j]
        lo_b, hi_b = F.col(f"{b}lo")[j], F.col(f"{b}hi")[j]
        d = F.greatest(F.lit(0.0), lo_b - hi_a, lo_a - hi_b)
        gap = d * d if gap is None else gap + d * d
    return gap <= radius * radius


def block_pairs(boxes: DataFrame, blocks: int, k: int, radius: float, fan: int = 4) -> DataFrame:
    """(a, b), a <= b: pairs of sequence intervals that may hold a link.

    Starts with the pair of the whole sequence with itself; each level cuts both intervals
    into ``fan`` parts and drops pairs whose boxes are too far apart.
    """
    levels = max(0, math.ceil(math.log(max(blocks, 1), fan) - 1e-9))
    spark = boxes.sparkSession
    pairs = spark.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    for level in range(levels - 1, -1, -1):
        size = fan**level
        node = F.floor(F.col("seq") / size).cast("long")
        lows = [F.min(F.col("lo")[j]) for j in range(k)]
        highs = [F.max(F.col("hi")[j]) for j in range(k)]
        at = boxes.groupBy(node.alias("node")).agg(F.array(*lows).alias("lo"), F.array(*highs).alias("hi"))
        for side, other in ("ab", "ba"):
            parts = F.array(*[F.col(side) * fan + i for i in range(fan)])
            pairs = pairs.select(F.explode(parts).alias(side), other)
        pairs = pairs.where(F.col("a") <= F.col("b"))
        for side in "ab":
            pairs = pairs.join(at.select(F.col("node").alias(side), F.col("lo").alias(f"{side}lo"), F.col("hi").alias(f"{side}hi")), side)
        pairs = pairs.where(_near("a", "b", k, radius)).select("a", "b")
    return pairs


def _roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable over the links i-j."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        root = root[root]
        if (root == before).all():
            return root


def _tiles(x: np.ndarray, low: np.ndarray) -> list:
    return [(s, low[s : s + TILE].min(0), low[s : s + TILE].max(0)) for s in range(0, len(x), TILE)]


def _compare(pairs: DataFrame, axes: np.ndarray, threshold: float, radius: float) -> DataFrame:
    """(node, links, root): for each vector with links in a pair of blocks, their number and one linked vector.

    ``root`` is a vector it is joined with through links of this pair of blocks. Blocks are
    cut into tiles, and tiles whose boxes are too far apart are skipped as well.
    """
    width = axes.shape[0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                same = row["a"] == row["b"]
                sides = []
                for s in "ab":
                    units = [_unit(b) for b in row[f"{s}blobs"]]
                    sizes = np.array([len(u) for u in units])
                    x = np.zeros((len(sizes), sizes.max()))
                    for i, u in enumerate(units):
                        x[i, : len(u)] = u
                    low = x[:, :width] @ axes[: x.shape[1]] if x.shape[1] <= width else x[:, :width] @ axes
                    sides.append((x, low, sizes, np.array(row[f"{s}weights"]), np.arange(len(x)) + (row[s] << 20)))
                (xa, la, na, wa, ida), (xb, lb, nb, wb, idb) = sides
                dims = max(xa.shape[1], xb.shape[1])
                xa, xb = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (xa, xb))
                even = bool((na == na[0]).all() and (nb == na[0]).all())
                links_a, links_b = np.zeros(len(xa), np.int64), np.zeros(len(xb), np.int64)
                found_i, found_j = [], []
                for sa, lo_a, hi_a in _tiles(xa, la):
                    for sb, lo_b, hi_b in _tiles(xb, lb):
                        if same and sb < sa:
                            continue
                        gap = np.maximum(0, np.maximum(lo_b - hi_a, lo_a - hi_b))
                        if even and gap @ gap > radius * radius:
                            continue
                        a, b = slice(sa, sa + TILE), slice(sb, sb + TILE)
                        near = xa[a] @ xb[b].T >= threshold
                        if not even:
                            near &= na[a][:, None] == nb[b][None, :]
                        if same and sa == sb:
                            near &= ~np.tri(*near.shape, dtype=bool)
                        i, j = np.nonzero(near)
                        if len(i):
                            links_a[a] += near @ wb[b]
                            links_b[b] += near.T @ wa[a]
                            found_i.append(i + sa)
                            found_j.append(j + sb)
                if not found_i:
                    continue
                i, j = np.concatenate(found_i), np.concatenate(found_j)
                if same:
                    ids, links = ida, links_a + links_b
                else:
                    ids, links, j = np.concatenate([ida, idb]), np.concatenate([links_a, links_b]), j + len(xa)
                root = _roots(i, j, len(ids))
                some = links > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[some]), pa.array(links[some]), pa.array(ids[root[some]])], names=["node", "links", "root"]
                )

    return map_arrow(pairs, work, "node long, links long, root long")


def embedding_links(
    frame: DataFrame,
    threshold: float = 0.95,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    axes: int = 12,
    grid: int = 4,
    block: int = 2048,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Two vectors link if their cosine in double precision is at least ``threshold``, that is, if
    their unit vectors lie within epsilon = sqrt(2 - 2 * threshold). Equal vectors are one point with
    a weight, so copies make no pairs. Points are sorted by grid cells of side epsilon on
    ``grid`` leading principal axes, cut into blocks, and pairs of sequence intervals
    whose boxes (on ``axes`` leading axes) lie further apart than epsilon are skipped, level by
    level; what is left is compared exactly. Links leave a task as a count and one
    joined vector for each vector, never as pairs.

    Null vectors, zero vectors and those with null or non-finite components link with
    nothing, nor do vectors of different lengths. Null ids keep their rows; a component's
    id is the smallest id in it (null only if all are). Rows repeated under one id count as
    vectors of their own. An empty table gives no rows.
    """
    epsilon = math.sqrt(max(0.0, 2 - 2 * threshold))
    radius = epsilon + SLACK
    vectors = write_once(usable_vectors(frame, id_column, vector_column), "vectors")
    distinct = vectors.where(F.col("blob").isNotNull()).groupBy("blob").agg(F.count("*").alias("weight"))
    common = vectors.where(F.col("blob").isNotNull()).groupBy("width").count().orderBy(F.desc("count"), "width").first()
    alone = vectors.where(F.col("blob").isNull()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if common is None:
        return alone
    width = common["width"]
    base = principal_axes(distinct, width, min(axes, width))
    k = base.shape[1]
    laid = write_once(_blocks(distinct, base, epsilon, block, min(grid, k)), "vector-blocks")
    # One row for each range partition, to number the blocks through.
    first, total = {}, 0
    for row in laid.groupBy("pid").count().orderBy("pid").collect():
        first[row["pid"]], total = total, total + row["count"]
    offsets = frame.sparkSession.createDataFrame(list(first.items()), "pid long, base long")
    blocks = write_once(
        laid.join(offsets, "pid").select((F.col("base") + F.col("local")).alias("seq"), "blobs", "weights", "lo", "hi"), "vector-sequence"
    )
    pairs = write_once(block_pairs(blocks.select("seq", "lo", "hi"), total, k, radius), "block-pairs")
    for side in "ab":
        other = blocks.select(F.col("seq").alias(side), F.col("blobs").alias(f"{side}blobs"), F.col("weights").alias(f"{side}weights"))
        pairs = pairs.join(other, side)
    found = write_once(_compare(pairs, base, threshold, radius), "vector-links")
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-components")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    points = blocks.select("seq", F.posexplode(F.arrays_zip("blobs", "weights")).alias("at", "p")).select(
        (F.shiftleft("seq", 20) + F.col("at")).alias("node"), F.col("p.blobs").alias("blob"), F.col("p.weights").alias("weight")
    )
    points = points.join(counted, "node", "left").join(roots, "node", "left").select(
        "blob", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    placed = write_once(vectors.where(F.col("blob").isNotNull()).join(points, "blob").select("vec_id", "root", "n_links"), "vector-placed")
    lowest = placed.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    linked = placed.join(lowest, "root").select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
    return linked.unionByName(alone)
