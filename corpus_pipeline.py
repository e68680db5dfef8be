"""Clean and pack the corpus: each stage works on what the stage before it kept.

A stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of documents.
Packing returns the pieces of the sequences (see ``streambed.llm.packing``), in the order of the kept documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streambed.llm.decontaminate import drop_contaminated
from streambed.llm.ngram_join import keep_one
from streambed.llm.packing import packing_digest
from streambed.llm.queries import tokenizer_path
from streambed.llm.shared import scratch, table
from streambed.llm.suffix_dedup import drop_repeats
from streambed.llm.toxicity import drop_toxic, fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score as toxic; the classifier learns from the labelled documents of its input."""
    return drop_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of near copies."""
    return keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 100 bytes or more that stand earlier; documents of nothing else go."""
    return drop_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of which one word in 20 or more stands in benchmark windows."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences."""
    return packing_digest(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Compressed lengths, suffix order and token ids are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
