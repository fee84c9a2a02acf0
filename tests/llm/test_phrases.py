"""Mined phrases against counting everything."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatpulse.llm import phrases as ph
from tests.sql_check import connect, difference
from chatpulse.llm.queries import PHRASES_SQL, op12_phrases

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, lang string, text string, words string, block int, n int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest=3, least=10, inside=50, top=2000):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            if any(
                100 * b >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in found.items() if len(q) > len(p)
            ):
                continue
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def texts(seed=3):
    random = np.random.default_rng(seed)
    words = ["The", "of", "new", "york", "city", "São", "x\x00y", "a-b", "no\xa0break", "Ä"] + [f"w{i}" for i in range(40)]
    rare = [f"rare{i}" for i in range(300)]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(int(random.integers(5, 60))):
            kind = random.random()
            if kind < 0.12:
                parts.append("New York City" if random.random() < 0.7 else "new york")
            elif kind < 0.2:
                parts.append("big big big")
            elif kind < 0.3:
                parts.append(str(random.choice(rare)))
            else:
                parts.append(words[int(random.zipf(1.5)) % len(words)])
            parts.append(str(random.choice([" ", " ", " ", "\t", ". ", ",", "\n", " ;"])))
        rows.append((["en", "de", None, "und", ""][i % 5], "".join(parts)))
    return rows + [("en", None), ("en", ""), ("xx", "too few words here"), ("en", rows[0][1]), ("en", rows[0][1]), ("de", "one two " * 20_000)]


def frame_of(spark, rows):
    return spark.createDataFrame([(None if i % 7 == 0 else i // 2, lang, t, "x", 1, 2) for i, (lang, t) in enumerate(rows)], SCHEMA).repartition(4)


@pytest.mark.parametrize("settings", [{}, {"block_bytes": 2000, "sample_words": 300}, {"sample_words": 1, "filter_bytes": 8}, {"longest": 2}])
def test_phrases_equal_full_counting(spark, settings):
    rows = texts()
    found = sorted(tuple(r) for r in ph.mine_phrases(frame_of(spark, rows), **settings).collect())
    wanted = brute(rows, settings.get("longest", 3))
    assert len(wanted) > 30 and found == wanted


def test_longer_phrases_and_other_limits(spark):
    rows = texts(4)
    settings = {"longest": 5, "least": 4, "inside": 30, "top": 25}
    found = sorted(tuple(r) for r in ph.mine_phrases(frame_of(spark, rows), sample_words=500, block_bytes=3000, **settings).collect())
    assert found == brute(rows, **settings)


def test_border_failures_are_expanded(spark):
    blocks = ph.word_blocks(frame_of(spark, texts()), 2000, "lang", "text")
    blocks = ph.write_once(blocks, "test-blocks")
    codes = ph.code_words(blocks, 10)
    assert sorted(r["code"] for r in codes.collect()) == list(range(1, codes.count() + 1))
    coded = ph.coded_blocks(blocks, codes)
    whole, passes = ph.frequent_phrases(coded, 3, 10, 6000, 10**9, 1 << 16)
    some, more = ph.frequent_phrases(coded, 3, 10, 6000, 200, 1 << 16)
    assert passes == 1 and more == 2
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, some.collect()))
    assert whole.groupBy("gram").count().where("count > 1").isEmpty()


def test_empty_tables(spark):
    empty = frame_of(spark, texts()).where("false")
    assert ph.mine_phrases(empty).count() == 0
    assert ph.mine_phrases(frame_of(spark, [("en", "once only"), (None, None)])).count() == 0
    with pytest.raises(ValueError):
        ph.mine_phrases(empty, longest=1)


def test_query_equals_its_sql(spark):
    assert difference(spark, connect(SF), SF, op12_phrases, PHRASES_SQL) is None


def test_scores_stay_exact_beyond_64_bits(spark):
    big = 9_000_000_001
    grams = spark.createDataFrame([(bytes(7) + b"\x01", big - 2)], ph.GRAMS)
    counts = spark.createDataFrame([(bytes(4), big), (bytes(3) + b"\x01", 3 * big + 1)], ph.GRAMS)
    row = ph.with_cuts(grams, counts).first()
    assert row["score"] == 1000000 * (big - 2) ** 2 // (big * (3 * big + 1))
