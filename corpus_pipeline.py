"""The corpus pipeline over the ``documents`` table.

STAGES are (name, function) in order; a function takes (spark, docs, sf_dir) and returns the
documents it keeps with all their columns, the last one the packed pieces. Each result is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from livepulse.llm import best_fit_packing, decontaminate, exact_dedup, near_join, quality
from livepulse.llm.common import stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier scores 0.3 or more (learned from the labels of this input)."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels"), "quality"), least=0.3)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to the case of A-Z, the row with the largest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs, keep="max")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a similarity of 0.8 on five-word shingles, the least doc_id."""
    return near_join.drop_near_duplicates(docs, n=5, threshold=0.8)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents no benchmark passage is found in."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, packed into sequences of at most 2048 ids."""
    return best_fit_packing.pack(docs, capacity=2048, end_id=0)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: Training, tokenising and packing are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
