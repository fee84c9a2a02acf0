"""Codebooks and codes against plain whole-number arithmetic."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from chatpulse.llm import gnat_codes as g

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error long"


def brute(rows, parts=8, entries=16, rounds=6):
    """(vec_id, label, code, error) of every usable row, and the digest of the codebooks."""
    sound = [(i, v, lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    sound.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = next((len(v) for _, v, _ in sound if len(v) % parts == 0), None)
    if length is None:
        return [], hashlib.sha256(b"").hexdigest()
    whole = [(i, [math.floor(Fraction(x) * 4096) for x in v], lab) for i, v, lab in sound if len(v) == length]
    size = length // parts
    books = [[v[p * size : p * size + size] for _, v, _ in whole[:entries]] for p in range(parts)]

    def nearest(part, p):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = [[[] for _ in b] for b in books]
        for _, v, _ in whole:
            for p in range(parts):
                part = v[p * size : p * size + size]
                groups[p][nearest(part, p)[1]].append(part)
        books = [[[sum(x) // len(own) for x in zip(*own)] if own else e for e, own in zip(b, gs)] for b, gs in zip(books, groups)]
    out = []
    for i, v, lab in whole:
        found = [nearest(v[p * size : p * size + size], p) for p in range(parts)]
        out.append((i, lab, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    listed = ",".join(str(x) for b in books for e in b for x in e)
    return out, hashlib.sha256(listed.encode()).hexdigest()


def check(spark, rows, **settings):
    frame = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], SCHEMA).repartition(3)
    found = [tuple(r) for r in g.compress_vectors(frame, **settings).collect()]
    wanted, digest = brute(rows, **settings)
    of_label = {}
    for _, lab, _, error in wanted:
        of_label[lab] = of_label.get(lab, 0) + error
    long = lambda x: x if x < 1 << 63 else None
    expected = [(i, code, long(e), long(of_label[lab]), digest) for i, lab, code, e in wanted]
    assert sorted(found, key=str) == sorted(expected, key=str)
    return found


def test_codes_equal_plain_arithmetic(spark):
    random = np.random.default_rng(5)
    rows = [(int(i), random.normal(0, 1, 16).tolist(), int(random.integers(0, 3))) for i in random.permutation(300)]
    rows += [(i, list(v), None) for i, v, _ in rows[:40]]  # repeated ids and vectors, null labels
    rows += [(400 + i, [float(x) for x in random.integers(-1, 2, 16) / 4096], 9) for i in range(60)]  # many ties
    rows += [(None, [0.5] * 16, 1), (501, None, 1), (502, [], 1), (503, [0.1] * 15 + [None], 1), (504, [math.nan] * 16, 1),
             (505, [math.inf] + [0.0] * 15, 1), (506, [1.0] * 8, 1), (507, [1.0] * 12, 1)]
    assert len(check(spark, rows)) == 401
    assert len(check(spark, rows[:5], entries=16)) == 5
    check(spark, rows, parts=4, entries=5, rounds=2)


def test_equal_vectors_and_empty_tables(spark):
    check(spark, [(i, [1.0, 2.0] * 4, 1) for i in range(20)])
    check(spark, [(i, [i / 4096] * 8, 1) for i in range(20, 0, -1)])
    empty = spark.createDataFrame([], SCHEMA)
    assert g.compress_vectors(empty).count() == 0
    assert g.compress_vectors(spark.createDataFrame([(1, None, 1, "x", 1)], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        g.compress_vectors(empty, entries=300)


def test_very_large_components(spark):
    random = np.random.default_rng(6)
    rows = [(i, random.normal(0, 10.0 ** (i % 9), 8).tolist(), i % 2) for i in range(60)]
    check(spark, rows, rounds=2)
    check(spark, rows + [(100, [1.7e308, -1.7e308, 2.0**52, -0.5, 3.0**30, 0.0, 1e-300, -1e-300], 5)], rounds=2)


def test_search_leaves_subtrees_out_and_finds_the_nearest():
    random = np.random.default_rng(7)
    for spread, size in ((3, 2), (5000, 8), (40_000, 3)):
        centres = random.integers(-spread, spread + 1, (5, size))
        entries = [(centres[i % 5] + random.integers(-spread // 20 - 1, spread // 20 + 2, size)).tolist() for i in range(40)]
        queries = np.concatenate([np.array(entries), centres[random.integers(0, 5, 400)] + random.integers(-spread // 10 - 1, spread // 10 + 2, (400, size))])
        tree = g.Gnat(entries)
        which, far = tree.nearest(queries)
        for q, k, d in zip(queries.tolist(), which.tolist(), far.tolist()):
            assert (d, k) == min((sum((x - y) ** 2 for x, y in zip(q, e)), i) for i, e in enumerate(entries))
        assert tree.compared < 0.8 * tree.possible


def test_digits_of_sums():
    for x in (0, 1, -1, 2**31, -(2**31), 2**32 - 1, -(2**63), 2**200 + 5, -(2**200) - 5):
        assert sum(d << 32 * k for k, d in enumerate(g.limbs(x))) == x and all(-(2**31) <= d < 2**32 for d in g.limbs(x))
