"""The training-corpus pipeline: five operators in a row over the documents.

``STAGES`` lists (name, function) pairs; a function takes (spark, docs, sf_dir) and works on
all that its predecessor kept.  All but the last return rows of documents, with all their
columns; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowverdict.llm import decontaminate, exact_dedup, jaccard_join, quality
from flowverdict.llm.queries import packed_rows
from flowverdict.llm.tables import bounded_batches, read
from flowverdict.sources.scratch import stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject as low quality or toxic."""
    bounded_batches(spark)
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.keep_one(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the document with the least id."""
    bounded_batches(spark)
    return jaccard_join.keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    bounded_batches(spark)
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in the training sequences."""
    bounded_batches(spark)
    return packed_rows(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_duplicates),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# The classifier, MinHash, SimHash and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
