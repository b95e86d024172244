"""A corpus pipeline of five stages: rules, classifier, near duplicates, mixing, packing.

Each stage takes what its predecessor kept, written as Parquet and read again, and its decisions take effect: rejected
documents and all but one of each near-duplicate class go, documents come as often as the mix takes them, and the last
stage returns where every piece of what is left is packed.

All stages take documents with any further columns, whatever their names, null in any column, empty texts and texts of
any length, repeated rows and ids, and no rows at all, which gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grainloom.llm import jaccard_join, mixing, packing, quality_classifier, quality_rules
from grainloom.llm.common import scratch, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules (operator 8) keep. A null or empty text has no words, which the rules reject; repeated rows are judged alike."""
    return quality_rules.keep_good(docs)


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (operator 7) keeps; it is trained on these documents and `labels`.

    A score of exactly the bound stays; without any trusted positive all documents do. Null ids are never trusted.
    """
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join (operator 3): of the least id, null ids last, and of those of the least text hash."""
    return jaccard_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix (operator 9) takes them; null sources are one source, texts without words stay once."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences (operator 2); a null or empty text is one piece of one token."""
    return packing.pack(docs)


STAGES = [("quality_rules", rules), ("quality_classifier", classifier), ("ngram_jaccard_join", near_duplicates), ("source_mixing", mix), ("best_fit_packing", pack)]

#: Training, tokens and hashes have no SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
