"""Edited copies of long items, and items of few words."""

import numpy as np

from chatpulse.llm import decontaminate


def test_long_items_are_found_at_the_full_distance(spark):
    random = np.random.default_rng(9)
    word = lambda n: [f"v{k}" for k in random.integers(0, 3000, n)]
    items = [word(n) for n in (100, 150, 200, 300, 500) for _ in range(8)]
    docs = []
    for i, item in enumerate(items):
        copy = list(item)
        for k in sorted(random.choice(len(item), decontaminate.edits_allowed(len(item), 0.8), replace=False))[::-1]:
            kind = random.integers(0, 3)
            copy[k : k + (kind != 1)] = [] if kind == 2 else word(1)
        docs.append((i, " ".join(word(40) + copy + word(60))))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    found = decontaminate.find_benchmark(frame, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(i, i) for i in range(len(items))}


def test_every_piece_is_a_seed():
    """Whatever d words of an item change, a seed stays."""
    random = np.random.default_rng(10)
    for low, high in decontaminate.length_classes(400, 1):
        for n in {low, high}:
            item = np.arange(n).astype(np.uint64)
            size = decontaminate.seed_size(low, high, 0.8)
            own = decontaminate.seeds(item, size, high, 0.8)
            item[random.choice(n, decontaminate.edits_allowed(n, 0.8), replace=False)] = 1 << 40
            assert np.isin(own, decontaminate.run_codes(item, size, high)).any()


def test_short_items_and_scripts_without_blanks(spark):
    items = ["What is 2+2?", "Photosynthesis", "red green blue", "two words", "", "光合作用是什么", "水", "สวัสดีครับ"]
    docs = ["so: what IS 2, 2 then", "of photosynthesis.", "red green, blue red", "words two", "", "问题：光合作用是什麼？", "喝水", "a สวัสดีครับ b", "red green", None]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): (r["first_word"], r["words"], r["edits"]) for r in decontaminate.find_benchmark(frame, bench).collect()}
    assert found == {(0, 0): (1, 4, 0), (1, 1): (1, 1, 0), (2, 2): (0, 3, 0), (5, 5): (3, 6, 1), (6, 6): (1, 1, 0), (7, 7): (1, 10, 0)}
