"""Duplicates: exact by hash, near by MinHash bands, and the greedy rule that keeps the first."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainloom.functions.minhash import SLOTS, with_signature
from grainloom.functions.text import let
from grainloom.session import settled

BANDS = 32


def exact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with content_hash and is_first: the least key of each SHA-256 of the text.

    Only hashes that come twice are looked up, from a table, so that Spark can broadcast a small one and split a hot hash.
    """
    hashed = docs.withColumn("content_hash", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    twice = settled(hashed.groupBy("content_hash").agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    is_first = F.col("_first").isNull() | F.col(key).eqNullSafe(F.col("_first"))
    return hashed.join(twice, "content_hash", "left").withColumn("is_first", is_first).drop("_first")


def similar_pairs(signed: DataFrame, key: str, threshold: float = 0.85, bands: int = BANDS, slots: int = SLOTS) -> DataFrame:
    """(a, b, similarity), a < b, of rows (key, signature) whose equal slots reach the threshold.

    A pair at the threshold differs in too few slots to differ in every band, so bands lose none above 1 - bands/slots; by
    the same count it has `least` bands in common. A bucket emits only pairs that have these, and only in the first band
    that they share, so rows that share a band by a common passage, or near copies below the threshold, are compared by
    their band hashes where they meet and go no further.
    Rows of one signature meet by their first only, so a hot group of copies costs one comparison a copy; its inner pairs
    (similarity 1) aren't listed: join `signature_groups` for them.
    """
    rows = slots // bands
    groups = signature_groups(signed, key)
    heads = groups.where(F.col(key) == F.col("head")).join(signed, key).select(F.col("head"), "signature")
    hashes = F.array(*(F.xxhash64(F.slice("signature", 1 + i * rows, rows)) for i in range(bands)))
    banded = heads.select("head", hashes.alias("bands")).select("head", "bands", F.posexplode("bands").alias("band", "value"))
    left = banded.select(F.col("head").alias("a"), "band", "value", F.col("bands").alias("x"))
    right = banded.select(F.col("head").alias("b"), "band", "value", F.col("bands").alias("y"))
    least = max(1, bands - math.floor(slots * (1 - threshold) + 1e-9))
    shared = F.zip_with("x", "y", lambda x, y: x == y)
    fit = let(shared, lambda s: (F.array_position(s, F.lit(True)) == F.col("band") + 1) & (F.size(F.filter(s, lambda e: e)) >= least))
    candidates = left.join(right, ["band", "value"]).where((F.col("a") < F.col("b")) & fit).select("a", "b")
    of = signed.select(F.col(key).alias("_k"), "signature")
    both = candidates.join(of.select(F.col("_k").alias("a"), F.col("signature").alias("x")), "a").join(of.select(F.col("_k").alias("b"), F.col("signature").alias("y")), "b")
    equal = F.aggregate(F.zip_with("x", "y", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, v: s + v)
    return both.withColumn("similarity", equal / float(slots)).where(F.col("similarity") >= threshold).select("a", "b", "similarity")


def linked(signed: DataFrame, key: str, threshold: float = 0.85) -> DataFrame:
    """(a, b, similarity), a < b: similar_pairs(), and each other row of a signature with its first, at similarity 1.

    Rows of similarity 1 are the members of a, and only they: first rows differ in a slot. Members share all pairs of
    their first, so every pair of rows that reaches the threshold follows from these, and there is one row a copy.
    """
    members = signature_groups(signed, key).where(F.col(key) != F.col("head"))
    return similar_pairs(signed, key, threshold).unionByName(members.select(F.col("head").alias("a"), F.col(key).alias("b"), F.lit(1.0).alias("similarity")))


def signature_groups(signed: DataFrame, key: str) -> DataFrame:
    """(key, head): the least key with the same signature; rows without one are left out."""
    full = signed.where("signature IS NOT NULL").select(key, F.xxhash64("signature").alias("_1"), F.xxhash64(F.lit(7), "signature").alias("_2"))
    heads = full.groupBy("_1", "_2").agg(F.min(key).alias("head"))
    return full.join(heads, ["_1", "_2"]).select(key, "head")


def greedy_kept(heads: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of heads (head) those that greedy_first keeps: a row goes if an earlier kept row is its pair.

    Rounds decide what they can: a row none of whose earlier partners is kept or open is kept; one with a kept earlier
    partner goes. As many rounds as the longest chain has links.
    """
    edges = settled(pairs.select("a", "b"))
    touched = settled(edges.select(F.col("b").alias("head")).distinct())
    kept = heads.join(touched, "head", "left_anti")
    state = settled(touched.withColumn("status", F.lit(0)))  # 0 open, 1 kept, -1 gone
    while True:
        status = state.select(F.col("head").alias("a"), F.col("status").alias("of_a"))
        seen = edges.join(status, "a", "left").withColumn("of_a", F.coalesce("of_a", F.lit(1)))
        verdict = seen.groupBy(F.col("b").alias("head")).agg(F.max(F.col("of_a") == 1).alias("hit"), F.max(F.col("of_a") == 0).alias("wait"))
        state = settled(state.join(verdict, "head").select("head", F.when(F.col("status") != 0, F.col("status")).when(F.col("hit"), -1).when(F.col("wait"), 0).otherwise(1).alias("status")))
        if state.where("status = 0").isEmpty():
            break
    return kept.select("head").union(state.where("status = 1").select("head"))


def near(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.85) -> DataFrame:
    """(key, kept): the greedy rule in order of key. Texts too short for a shingle are dropped, as duplicates are."""
    return _greedy(settled(with_signature(docs, key, text)), key, threshold)


def _greedy(signed: DataFrame, key: str, threshold: float) -> DataFrame:
    groups = settled(signature_groups(signed, key))
    heads = groups.select("head").distinct()
    kept = greedy_kept(heads, similar_pairs(signed, key, threshold)).withColumn("_kept", F.lit(True))
    full = groups.join(kept, "head", "left").select(key, (F.coalesce("_kept", F.lit(False)) & (F.col(key) == F.col("head"))).alias("kept"))
    return full.union(signed.where("signature IS NULL").select(key, F.lit(False).alias("kept")))


def incremental(index: DataFrame, batch: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.85) -> tuple[DataFrame, DataFrame]:
    """(key, kept) of batch, and the index with its kept rows: the greedy rule where all of index (key, signature) came before and stays.

    The index is what earlier batches kept, so its rows are no pairs of each other; signatures alone are carried on.
    """
    signed = settled(with_signature(batch, key, text))
    place = lambda rows, new: rows.withColumn("_key", F.struct(F.lit(new).alias("new"), F.col(key).alias("id"))).select("_key", "signature")
    verdict = settled(_greedy(place(index, False).unionByName(place(signed, True)), "_key", threshold))
    of_batch = verdict.where("_key.new").select(F.col("_key.id").alias(key), "kept")
    return of_batch, index.select(key, "signature").unionByName(signed.join(of_batch.where("kept").select(key), key, "left_semi"))


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row a key, that of the greatest order: what an upsert leaves. Tasks pick their own latest before the shuffle."""
    last = F.max_by(F.struct(*rows.columns), F.col(order)).alias("_row")
    return rows.groupBy(F.col(key).alias("_key")).agg(last).select("_row.*")
