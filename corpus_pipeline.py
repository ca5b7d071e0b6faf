"""From raw documents to packed training sequences.

``run`` applies the stages in order; each result is written as Parquet below the
shared folder and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from taxaspark.llm import packing, quality_classifier, quality_rules, simhash_vptree
from taxaspark.llm.common import table, written
from taxaspark.llm.queries import byte_bpe_added, byte_bpe_files


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the fences of their language and source keep."""
    return quality_rules.keep_good(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as good by a classifier trained on all documents that have a label."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"),
                                        labelled_docs=table(spark, sf_dir, "documents"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash_vptree.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    return packing.pack_documents(docs, *byte_bpe_files(), added=byte_bpe_added())


STAGES = [("quality_rules", rules), ("quality_classifier", classifier), ("simhash_near_dedup", near_dedup),
          ("packing", packed)]

#: Sketches, the classifier, XXH64 and the tokenizer have no SQL form; tested by brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
