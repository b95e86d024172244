"""Connected components of an edge table, kept distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainloom.llm.common import drop_tables, renamed, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of `edges` (a, b), label the smallest node it reaches.

    Each round takes the smallest label among a node's neighbours and then that label's own label, so paths halve; the
    driver sees one count a round. Hubs meet labels in plain joins of two tables, which Spark splits where a key is hot,
    and minima are formed before the shuffle. Edges between equal nodes and repeated edges are allowed; no edges give no rows.
    """
    both = stored(edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("_e")).select("_e.a", "_e.b").distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m")).select("node", F.least("node", "_m").alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("label"))
        of = labels.select(F.col("node").alias("label"), F.col("label").alias("_far"))
        after = stored(step.join(of, "label", "left").select("node", "_old", F.least("label", F.coalesce("_far", "label")).alias("label")))
        drop_tables(labels)
        if after.where(F.col("_old") != F.col("label")).isEmpty():
            drop_tables(both)
            return renamed(after, after.select("node", "label"))
        labels = renamed(after, after.select("node", "label"))
