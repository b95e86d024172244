"""Sharding by longest processing time: equal texts stay together, large groups are placed first, each into the least-loaded shard.

Groups of at least 1/HEAVY of all bytes are units of their own, so there are at most HEAVY of them; the rest are dealt by
their hash into BUNDLES units. Only these units, whose number no input can raise, are sorted and placed on the driver.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainloom.llm.common import gapless_rank, settled

HEAVY = 1 << 14
BUNDLES = 1 << 15


def longest_first(sizes: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Units by decreasing size (ties by name), each to the shard with the least load (ties: the lowest)."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for unit, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        out[unit] = shard
    return out


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Puts every row of docs (doc_id, text; other columns are ignored) into a shard 0 .. shards - 1 of near-equal bytes.

    Size: UTF-8 bytes of the text (null counts as empty) plus 1. Rows of equal texts share a shard. Returns doc_id, size,
    text_crc32, law ("bytes"), shard, slot (0, 1, ... within the shard) and grown_shard (null: this law plans anew for
    another number of shards). Repeated rows and null ids are rows like all others; an empty table gives none.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text)).alias("_key"), F.monotonically_increasing_id().alias("_tie"))
    rows = settled(rows)
    groups = rows.groupBy("_key").agg(F.sum("size").alias("_bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    least = max(1, -(-total // HEAVY))
    unit = F.when(F.col("_bytes") >= least, F.hex("_key")).otherwise(F.pmod(F.xxhash64("_key"), F.lit(BUNDLES)).cast("string"))
    # at most HEAVY + BUNDLES rows
    units = groups.groupBy(unit.alias("unit")).agg(F.sum("_bytes").alias("bytes")).collect()
    spark = docs.sparkSession
    placed = longest_first([(r["unit"], r["bytes"]) for r in units], shards)
    heavy = spark.createDataFrame([(u, s) for u, s in placed.items() if len(u) == 32], T.StructType([T.StructField("_u", T.StringType()), T.StructField("_heavy", T.IntegerType())]))
    light = spark.createDataFrame([(int(u), s) for u, s in placed.items() if len(u) != 32], T.StructType([T.StructField("_b", T.LongType()), T.StructField("_light", T.IntegerType())]))
    # both tables are bounded by HEAVY and BUNDLES
    dealt = rows.join(F.broadcast(heavy), F.hex("_key") == F.col("_u"), "left").join(F.broadcast(light), F.pmod(F.xxhash64("_key"), F.lit(BUNDLES)) == F.col("_b"), "left")
    dealt = dealt.select("doc_id", "size", "text_crc32", "_tie", F.coalesce("_heavy", "_light").alias("shard"))
    counts = {r["shard"]: r["n"] for r in dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranked = gapless_rank(dealt, "shard", counts, [F.col(c) for c in ("doc_id", "text_crc32", "size", "_tie")], "slot")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
