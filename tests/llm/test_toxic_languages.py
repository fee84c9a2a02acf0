"""The telling words of a rare language beside those of a frequent one."""

import zlib
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatpulse.llm import toxicity
from tests.helpers import plan_text


def test_chance_is_the_hypergeometric_tail():
    for t, c, n1, n0 in ((5, 0, 30, 200), (0, 9, 40, 60), (3, 4, 10, 12)):
        m = t + c
        p = lambda k: comb(n1, k) * comb(n0, m - k) / comb(n1 + n0, m)
        ks = range(t, min(m, n1) + 1) if t / m >= n1 / (n1 + n0) else range(max(0, m - n0), t + 1)
        assert toxicity.chance(np.array([t]), np.array([c]), n1, n0)[0] == pytest.approx(min(1, 2 * sum(map(p, ks))))


def test_words_of_a_rare_language_count(spark):
    """Each rare telling word stands in ten toxic texts; those of the frequent language in all of its toxic ones."""
    random = np.random.default_rng(12)
    rows = []
    for i in range(2000):
        rare, toxic = i % 10 == 0, i % 50 == 0 or i % 5 == 1
        words = [f"{'r' if rare else 'w'}{k}x" for k in random.integers(0, 200, 30)]
        if toxic:
            words[0] = ("bocoos", "mentec", "terrib", "zopenc")[i // 50 % 4] if rare else "vile"
        rows.append((i, " ".join(words), 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    found = {r["doc_id"]: r["toxic"] for r in toxicity.score_toxicity(docs.select("doc_id", "text"), docs.select("doc_id", "quality", "toxic")).collect()}
    missed = [i for i, _, _, t in rows if t and not found[i]]
    flagged = [i for i, _, _, t in rows if found[i] and not t]
    assert len(missed) <= 2 and len(flagged) <= 2


def test_all_labelled_texts_are_fitted_on_whole(spark):
    """A telling word at the end of long texts only, and in five times as many labelled documents as were once taken."""
    rows = [(i, f"n{i} " + "calm day " * (3000 if i < 60 else 1) + ("foulest" if i < 30 else ""), int(i < 30)) for i in range(21_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    kept = toxicity.training_rows(docs.select("doc_id", F.col("text").cast("binary").alias("text")), docs.select("doc_id", "toxic"))
    assert {r["toxic"]: r["count"] for r in kept.groupBy("toxic").count().collect()} == {1: 30, 0: 20_970}
    found = {r["doc_id"]: r["toxic"] for r in toxicity.score_toxicity(docs.select("doc_id", "text"), docs.select("doc_id", "toxic")).collect()}
    assert all(found[i] == (i < 30) for i, _, _ in rows)


def test_packed_features_come_back():
    for text in (b"", b"one", b"Several words, several wordings; " * 50):
        assert toxicity.unpacked(toxicity.packed(toxicity.features(text))).tolist() == sorted(toxicity.features(text).tolist())


def test_what_moves_of_a_text_is_short():
    random = np.random.default_rng(5)
    for n in (0, 1, 40, 3000):
        text = " ".join(f"{'Ab'[k % 2]}{'cdefgh'[k % 6]}ing{k}," for k in random.integers(0, 500, n)).encode()
        short = toxicity.short(toxicity.plain_words(text))
        assert np.array_equal(np.sort(toxicity.features(zlib.decompress(short))), np.sort(toxicity.features(text)))
        assert n < 40 or len(short) < 0.8 * len(toxicity.packed(toxicity.features(text)))


def test_texts_do_not_move_and_few_labels_move_like_many(spark, monkeypatch):
    """Below the size of a broadcast, too, the labels come by a merge; no exchange holds texts."""
    plans, write_once = [], toxicity.write_once

    def seen(frame, name):
        if name == "toxicity-rows":
            plans.append(plan_text(frame))
        return write_once(frame, name)

    monkeypatch.setattr(toxicity, "write_once", seen)
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.lit(b"some vile words").alias("text"))
    rows = toxicity.training_rows(docs, spark.range(50).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic")))
    assert sorted(r["toxic"] for r in rows.collect()) == [0, 1]
    assert "SortMergeJoin" in plans[0] and "BroadcastHashJoin" not in plans[0]
    # Every text is shortened below the first exchange that it would pass.
    left = plans[0][plans[0].index("SortMergeJoin") :]
    assert left.index("Exchange") < left.index("MapInArrow")


def test_training_rows_are_the_distinct_labelled_texts(spark):
    """Against plain Python: copies but for case and signs count once for each mark, repeats of words in n_words, ids without a label not at all."""
    texts = ["", "Vile, vile day", "vile vile DAY!", "day vile vile", "calm day", "calm day day", "Größe \u0e01\u0e02", "left out"]
    docs = [(i, texts[i % 8]) for i in range(64)] + [(1, "calm day"), (1, texts[1]), (None, "nobody"), (99, "unmarked")]
    marks = [(i, int(i % 5 == 0)) for i in range(64) if i % 8 != 7] + [(3, 1), (3, 1), (4, None), (None, 1), (7, None), (500, 1)]
    mark = {}
    for i, toxic in marks:
        if i is not None and toxic is not None:
            mark[i] = max(toxic, mark.get(i, 0))
    expected = set()
    for i, text in docs:
        if i in mark:
            words = toxicity.plain_words(text.encode())
            expected.add((mark[i], len(words), tuple(sorted(toxicity.features(text.encode()).tolist()))))
    frame = spark.createDataFrame(docs, "doc_id long, text string").select("doc_id", F.col("text").cast("binary").alias("text"))
    rows = toxicity.training_rows(frame, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()
    assert len(rows) == len(expected)
    assert {(r["toxic"], r["n_words"], tuple(toxicity.unpacked(r["features"]).tolist())) for r in rows} == expected
