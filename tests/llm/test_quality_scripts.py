"""The quality model by hand, and in scripts other than Latin."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatpulse.llm import kneser_ney as kn


def by_hand(texts, order):
    """Interpolated modified Kneser-Ney over single-byte characters, from its definition: text -> log P."""
    bos = "\0" * (order - 1)
    top = Counter(g for t in texts for g in ((bos + t)[i : i + order] for i in range(len(t))))
    counts = {order: top}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    own = {c for c, n in Counter("".join(texts)).items() if n > 1}
    codes = kn.FIRST_CODE + len(own)
    cut = {}
    for n, seen in counts.items():
        n1, n2, n3, n4 = (max(sum(c == i for c in seen.values()), 1) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        cut[n] = [min(max(i - (i + 1) * y * b / a, 0.05), i - 0.05) for i, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]

    def p(gram):
        n = len(gram)
        lower = 1 / codes if n == 1 else p(gram[1:])
        own = {g: c for g, c in counts[n].items() if g[:-1] == gram[:-1]}
        if not own:
            return lower
        total, c = sum(own.values()), own.get(gram, 0)
        held = sum(cut[n][min(c, 3) - 1] for c in own.values())
        return ((c - cut[n][min(c, 3) - 1] if c else 0) + held * lower) / total

    return lambda t: sum(math.log(p((bos + t)[i : i + order])) for i in range(len(t)))


def test_log_probability_by_hand(spark):
    texts = ["abracadabra", "cabbage abba", "a cab", "abaca baca"]
    frame = spark.createDataFrame([(t.encode(),) for t in texts], "text binary")
    table = kn.code_table(frame)
    model = kn.collected(*kn.probabilities(frame, table, 3), table, 3)
    score = by_hand(texts, 3)
    for text in ["abracab", "bacab", "cc  bb", texts[0]]:
        codes = kn.padded(kn.encoded(kn.code_points(text.encode()), table), 3)
        assert model.log_probability(codes).sum() == pytest.approx(score(text), abs=1e-9)


def test_no_character_is_unknown():
    table = np.full(kn.POINTS, kn.BY_BYTES, np.int32)
    table[[ord(c) for c in "ab漢"]] = [kn.FIRST_CODE, kn.FIRST_CODE + 1, kn.FIRST_CODE + 2]
    points = kn.code_points("a字b漢é😀".encode())
    wanted = [kn.FIRST_CODE, *[kn.FIRST_BYTE + b for b in "字".encode()], kn.FIRST_CODE + 1, kn.FIRST_CODE + 2]
    wanted += [kn.FIRST_BYTE + b for b in "é😀".encode()]
    assert kn.encoded(points, table).tolist() == wanted
    assert kn.encoded(kn.code_points(b""), table).tolist() == []


@pytest.mark.parametrize("first, size", [(0x4E00, 1500), (0x0430, 32)])
def test_junk_in_other_scripts(spark, first, size):
    """Han and Cyrillic texts of a made-up language with preferred successors; junk has the same characters in any order."""
    random = np.random.default_rng(first)
    after = random.integers(0, size, (size, 4))

    def text(n):
        at, out = int(random.integers(size)), []
        for _ in range(n):
            out.append(chr(first + at))
            at = int(after[at, random.integers(4)]) if random.random() < 0.9 else int(random.integers(size))
        return "".join(out)

    good = [(i, text(300), "zz") for i in range(240)]
    junk = [(1000 + i, "".join(chr(first + k) for k in random.integers(0, size, 300)), "zz") for i in range(40)]
    docs = spark.createDataFrame(good + junk, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in range(160)], "doc_id long, quality int")
    kept = {r["doc_id"]: r["kept"] for r in kn.classify_quality(docs, labels).collect()}
    assert not any(kept[i] for i, _, _ in junk) and sum(kept[i] for i, _, _ in good) >= 236


def test_thresholds_come_from_all_documents_not_fitted_on(spark):
    labels = spark.createDataFrame([(i, 1) for i in range(200)], "doc_id long, quality int")
    chosen = kn.training_ids(labels, 20)
    assert chosen.count() == 20
    assert kn.trusted_labels(labels).join(chosen, "doc_id", "left_anti").count() == 180
    assert kn.training_ids(labels, 10**6).count() == kn.trusted_labels(labels).where("fit").count() < 200
    assert kn.training_ids(labels.where(F.lit(False)), 5).count() == 0


def test_every_trusted_text_of_the_fitted_half_counts(spark):
    """Also long ones, and with parts of texts smaller than a text."""
    labels = spark.createDataFrame([(i, 1) for i in range(9000)], "doc_id long, quality int")
    chosen = kn.training_ids(labels)
    assert chosen.count() == kn.trusted_labels(labels).where("fit").count() > 4000
    first = chosen.agg(F.min("doc_id")).first()[0]
    docs = spark.createDataFrame([(first, "ab" * 15_000)], "doc_id long, text string").select("doc_id", F.col("text").cast("binary").alias("text"))
    model = kn.fit_model(docs, chosen, 4)
    assert model is not None and model.grams[0].count() == 2


@pytest.mark.parametrize("most", [0, 40, 400])
def test_scores_do_not_depend_on_the_head(spark, monkeypatch, most):
    """Some, few or no n-grams in the tasks' table: the others are joined, unseen ones and contexts included."""
    random = np.random.default_rng(2)
    rows = [(i, "".join(random.choice(list("abcdé字 "), 60, p=[0.3, 0.2, 0.2, 0.1, 0.1, 0.05, 0.05])), "en") for i in range(120)]
    rows += [(500, "zzz é漢😀 zz" * 5, "xx"), (501, None, "en"), (502, "", None), (None, "abc" * 30, "en"), (3, "dcba" * 9, "en"), (503, "abcd" * 300_000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in range(90)], "doc_id long, quality int")

    def judged(**settings):
        found = kn.classify_quality(docs, labels, **settings).collect()
        return sorted((r["doc_id"] or -1, r["n_chars"], round(r["perplexity"], 6), round(r["threshold"], 6), r["kept"]) for r in found)

    whole = judged()
    assert len(whole) == len(rows)
    assert judged(head_rows=most) == whole


def test_counts_of_parts_add_up(spark, monkeypatch):
    texts = spark.createDataFrame([(t.encode(),) for t in ["abracadabra" * 40, "a", "cabbage abba"]], "text binary")
    table = kn.code_table(texts)
    counts = lambda: sorted(map(tuple, kn.top_counts(texts, table, 3).collect()))
    whole = counts()
    top = kn.top_counts(texts, table, 3).agg(F.sum("c")).first()[0]
    assert top == 40 * 11 + 1 + 12
    monkeypatch.setattr(kn, "PART", 7)
    monkeypatch.setattr(kn, "HELD_GRAMS", 10)
    assert counts() == whole
