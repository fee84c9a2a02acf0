"""Clean, deduplicate, decontaminate and pack the documents table, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatpulse.llm.common import new_folder
from chatpulse.llm.decontaminate import drop_contaminated
from chatpulse.llm.kneser_ney import drop_low_quality
from chatpulse.llm.queries import packed_pieces
from chatpulse.llm.simhash import keep_one_each
from chatpulse.llm.toxicity import drop_toxic
from chatpulse.sources.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fingerprints of 3-word shingles, linked at two differing bits or fewer."""
    return keep_one_each(docs, radius=2, shingle=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_pieces(docs)


STAGES = [
    ("quality classifier", quality),
    ("toxicity", toxicity),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: No SQL: stages train models, hash shingles and run a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; every stage's rows are stored and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
