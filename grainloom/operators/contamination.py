"""Benchmark contamination: word n-grams against an inverted index, and character n-grams with exact hashes first.

Both are equi-joins on n-grams, by 64-bit hashes. The benchmark's side is broadcast while its counted n-grams are few; else it is shuffled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.functions.ngram_hash import gram_rows
from grainloom.functions.text import drop_marks_then_strip, strip_then_drop_marks, word_ngram_hashes, words
from grainloom.session import settled

#: n-grams of a benchmark that are broadcast at most.
BROADCAST = 500_000


def _small(side: DataFrame) -> DataFrame:
    side = settled(side)
    return F.broadcast(side) if side.count() <= BROADCAST else side


def benchmark_text(fields: list[Column], choices: Column | None = None, reference: Column | None = None) -> Column:
    """Fields in order, then choices, then the reference, joined by a space; nulls are left out."""
    parts = [F.array(*fields)]
    if choices is not None:
        parts.append(choices)
    if reference is not None:
        parts.append(F.array(reference))
    return F.array_join(F.flatten(F.array(*parts)), " ")


def word_overlaps(docs: DataFrame, items: DataFrame, n: int = 13, least: float = 0.1) -> DataFrame:
    """(doc_id, item_id, hits, doc_ngrams, overlap) for overlap > least.

    hits adds, for each distinct n-gram of the document, how often it stands in the item, so overlap can exceed 1.
    """
    index = items.select("item_id", F.explode(word_ngram_hashes(words(drop_marks_then_strip(F.col("text"))), n)).alias("gram")).groupBy("gram", "item_id").agg(F.count(F.lit(1)).alias("times"))
    grams = docs.select("doc_id", F.array_distinct(word_ngram_hashes(words(drop_marks_then_strip(F.coalesce("text", F.lit("")))), n)).alias("grams"))
    spread = grams.select("doc_id", F.size("grams").alias("doc_ngrams"), F.explode("grams").alias("gram"))
    hits = spread.join(_small(index), "gram").groupBy("doc_id", "doc_ngrams", "item_id").agg(F.sum("times").alias("hits"))
    return hits.withColumn("overlap", F.col("hits") / F.col("doc_ngrams")).where(F.col("overlap") > least).select("doc_id", "item_id", "hits", "doc_ngrams", "overlap")


def first_hits(overlaps: DataFrame) -> DataFrame:
    """Each item with the first document that hits it, and whether that is an exact match (overlap above 0.8)."""
    first = overlaps.groupBy("item_id").agg(F.min(F.struct("doc_id", "overlap")).alias("f"))
    return first.select("item_id", "f.doc_id", "f.overlap", F.when(F.col("f.overlap") > 0.8, "exact").otherwise("ngram_overlap").alias("match_type"))


def word_report(docs: DataFrame, items: DataFrame, overlaps: DataFrame) -> DataFrame:
    """One row: items, documents, contaminated items, rate, clean."""
    hit = overlaps.agg(F.countDistinct("item_id").alias("contaminated_items"), F.countDistinct("doc_id").alias("hit_docs"))
    total = items.agg(F.count(F.lit(1)).alias("total_items")).crossJoin(docs.agg(F.count(F.lit(1)).alias("total_docs")))  # two rows of one
    return total.crossJoin(hit).withColumn("rate", F.col("contaminated_items") / F.greatest("total_items", F.lit(1))).withColumn("clean", F.col("contaminated_items") == 0)


def char_overlaps(docs: DataFrame, items: DataFrame, n: int = 13, least: float = 0.8) -> DataFrame:
    """(doc_id, item_id, match_type, similarity): exact normal forms first; only other documents are compared by n-grams.

    similarity is the shared distinct n-grams over those of the smaller side. Of items with one normal form the last wins.
    """
    normal = strip_then_drop_marks(F.coalesce("text", F.lit("")))
    items = items.where(F.length(F.trim("text")) > 0).select("item_id", normal.alias("t"))
    docs = docs.where(F.length("text") > 0).select("doc_id", normal.alias("t"))
    hashes = items.groupBy(F.sha2("t", 256).alias("h")).agg(F.max("item_id").alias("item_id"))
    hashed = docs.withColumn("h", F.sha2("t", 256))
    exact = hashed.join(_small(hashes), "h").select("doc_id", "item_id", F.lit("exact").alias("match_type"), F.lit(1.0).alias("similarity"))
    rest = hashed.join(_small(hashes.select("h")), "h", "left_anti")
    item_grams = settled(gram_rows(items, "item_id", "t", n).withColumnRenamed("n_grams", "item_n"))
    few = item_grams.count() <= BROADCAST
    # while the items' n-grams are few, documents emit only what is among them
    known = np.array(sorted(r["gram"] for r in item_grams.select("gram").distinct().collect()), np.int64) if few else None
    doc_grams = gram_rows(rest, "doc_id", "t", n, known).withColumnRenamed("n_grams", "doc_n")
    shared = doc_grams.join(F.broadcast(item_grams) if few else item_grams, "gram").groupBy("doc_id", "doc_n", "item_id", "item_n").agg(F.count(F.lit(1)).alias("shared"))
    ratio = F.col("shared") / F.least("doc_n", "item_n")
    near = shared.withColumn("similarity", ratio).where(F.col("similarity") >= least).select("doc_id", "item_id", F.lit("ngram").alias("match_type"), "similarity")
    return exact.unionByName(near)


def training_report(docs: DataFrame, items: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: training rows, benchmark items, rows with a match, matches, and the rate over the training rows."""
    hit = matches.agg(F.countDistinct("doc_id").alias("contaminated_count"), F.count(F.lit(1)).alias("matches"))
    total = docs.agg(F.count(F.lit(1)).alias("total_training_examples")).join(F.broadcast(items.agg(F.count(F.lit(1)).alias("total_benchmark_examples")))).join(F.broadcast(hit))  # rows of one
    return total.withColumn("contamination_rate", F.col("contaminated_count") / F.greatest("total_training_examples", F.lit(1)))


def top_matches(matches: DataFrame, k: int = 10) -> DataFrame:
    return matches.orderBy(F.col("similarity").desc(), "doc_id", "item_id").limit(k)
