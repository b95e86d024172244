"""Whole plans: cleaning funnel, judging, assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainloom.functions.pii import PATTERNS, redactions
from grainloom.functions.text import rounded
from grainloom.operators import assemble, dedup
from grainloom.operators.quality import Limits, analysis
from grainloom.session import settled


def clean(docs: DataFrame, limits: Limits = Limits(), threshold: float = 0.85, language: Column | None = None, confidence: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(cleaned documents, one row of counts): near duplicates first, then quality, then personal data.

    A document that quality rejects still suppresses its later near duplicates. What is emitted is the original text with
    personal data rewritten; boilerplate lines count in the metrics only. Rows are told apart by id and text, in the order
    of ids, null ids last; of rows that repeat both, one can be kept. No text is written but the output's.
    """
    ident = F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("id"), F.md5(F.coalesce("text", F.lit(""))).alias("hash"))
    keyed = docs.withColumn("_key", ident)
    kept = settled(dedup.near(keyed, "_key", threshold=threshold).where("kept").select("_key").distinct())
    first = keyed.join(kept, "_key", "left_semi")
    if not keyed.groupBy("_key").count().where("count > 1").isEmpty():
        first = first.dropDuplicates(["_key"])
    judged = first.withColumn("_q", analysis(F.col("text"), limits, language, confidence))
    passed = judged.where("_q.passed")
    q = "_q."
    metrics = F.struct(
        F.col(q + "char_count").alias("char_count"), F.col(q + "word_count").alias("word_count"), rounded(F.col(q + "repetition_ratio"), 4).alias("repetition_ratio"),
        F.col(q + "language").alias("language"), rounded(F.col(q + "language_confidence").cast("double"), 4).alias("language_confidence"), F.col(q + "has_code").alias("has_code"),
    )
    out = passed.withColumn("_r", redactions(F.col("text"))).select("doc_id", F.col("_r.text").alias("text"), metrics.alias("quality_metrics"), *(F.col(f"_r.n_{n}").alias(f"n_{n}") for n in PATTERNS))
    seen = judged.agg(F.count(F.lit(1)).alias("_kept"), F.count_if(F.col("_q.passed")).alias("output"))
    counts = docs.agg(F.count(F.lit(1)).alias("total")).join(F.broadcast(seen))  # one row beside one row
    return out, counts.select("total", (F.col("total") - F.col("_kept")).alias("duplicates"), (F.col("_kept") - F.col("output")).alias("filtered"), "output")


def assembled(docs: DataFrame, template: str = "chatml", room: int | None = None, seed: int = 42) -> DataFrame:
    """docs (doc_id, source, text, composite_score) as split training examples; with room, packed first, which leaves the text only."""
    from grainloom.functions.chat import rendered

    rows = assemble.conversations(docs, seed).select("doc_id", "source", "composite_score", rendered(F.col("messages"), template).alias("text"))
    if room is None:
        return assemble.split(rows, seed=seed)
    packed = assemble.packed(rows.select(F.col("doc_id").alias("pos"), "text"), room)
    return assemble.split(packed.select(F.col("sequence").alias("doc_id"), "text").withColumn("composite_score", F.lit(None).cast("double")), seed=seed)
