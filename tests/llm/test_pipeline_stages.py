"""Stages of the pipeline against brute force on small tables."""

from itertools import combinations

import numpy as np

import corpus_pipeline
from chatpulse.llm.common import write_once
from tests.llm.test_text_jobs import naive_fingerprint, roots_of


def test_stages_are_the_wanted_ones():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "toxicity", "SimHash near-dedup", "benchmark decontamination", "packing"]


def test_one_document_of_each_group_of_fingerprints_stays(spark):
    random = np.random.default_rng(8)
    word = lambda n: [f"v{k}" for k in random.integers(0, 3000, n)]
    texts = [None, "", "one two", "One two", "one two three", "one  two\tthree"]
    for size in (30, 400, 2000):
        base = word(size)
        for _ in range(15):
            copy = list(base)
            for k in random.integers(0, len(copy), int(random.integers(0, 3))):
                copy[k] = word(1)[0]
            texts.append(" ".join(copy))
    rows = [(i, t, "en", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, (None, texts[6], "en", 1), (7, texts[7], "en", 2)], "doc_id long, text string, fp string, component_id int")
    docs = write_once(docs.repartition(3), "docs")
    prints = {i: naive_fingerprint(t) for i, t, _, _ in rows}
    near = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    wanted = sorted(set(roots_of(prints, near).values()))
    kept = corpus_pipeline.simhash_near_dedup(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == wanted
    assert corpus_pipeline.simhash_near_dedup(spark, docs.where("false"), "").count() == 0


def test_quality_stage_fits_on_all_trusted_texts(spark, tmp_path, monkeypatch):
    import corpus_pipeline
    from chatpulse.llm import kneser_ney

    spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, "an even text " * (2000 if i == 7 else 3), "en") for i in range(40)], "doc_id long, text string, lang string")
    fitted = []
    fit = kneser_ney.fit_model

    def seen(narrow, chosen, order, longest=None, most=None):
        fitted.append((chosen.count(), longest))
        return fit(narrow, chosen, order, longest, most)

    monkeypatch.setattr(kneser_ney, "fit_model", seen)
    assert corpus_pipeline.quality(spark, docs, str(tmp_path)).count() == 40
    half = kneser_ney.trusted_labels(spark.read.parquet(f"{tmp_path}/labels.parquet")).where("fit").count()
    assert fitted == [(half, None)]
