"""Manifests of files, their differences, and differences of configurations and metrics."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(filename, bytes, sha256, lines) of every file below path, by its path from there; a missing path raises."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    lines = F.size(F.filter(F.split(F.col("content").cast("string"), "\n"), lambda x: F.trim(x) != ""))
    # every file's path ends with what stands behind the root's, whatever scheme the two are written with
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath().rstrip("/") + "/"
    name = F.substring(F.col("path"), F.locate(root, F.col("path")) + len(root), F.lit(1 << 20))
    return files.select(name.alias("filename"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.when(F.endswith("path", F.lit(".jsonl")), lines).otherwise(0).alias("lines"))


def snapshot(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("num_files"), F.sum("bytes").alias("total_bytes"), F.sum("lines").alias("total_examples"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("filename", "sha256")))).alias("file_hashes"))


def diff(old: DataFrame, new: DataFrame, key: str = "filename", value: str = "sha256") -> DataFrame:
    """(key, status): added, removed, modified or unchanged."""
    a, b = old.select(key, F.col(value).alias("_a"), F.lit(True).alias("_in_a")), new.select(key, F.col(value).alias("_b"), F.lit(True).alias("_in_b"))
    status = F.when(F.col("_in_a").isNull(), "added").when(F.col("_in_b").isNull(), "removed").when(F.col("_a").eqNullSafe(F.col("_b")), "unchanged").otherwise("modified")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def flattened(config: Mapping, prefix: str = "") -> dict[str, str]:
    """Dotted paths to JSON text."""
    out: dict[str, str] = {}
    for k, v in config.items():
        at = f"{prefix}.{k}" if prefix else str(k)
        out |= flattened(v, at) if isinstance(v, Mapping) else {at: json.dumps(v, sort_keys=True)}
    return out


def config_diff(spark: SparkSession, a: Mapping, b: Mapping) -> DataFrame:
    """(path, a, b) where two nested configurations differ."""
    rows = lambda c, name: spark.createDataFrame([*flattened(c).items()], f"path string, {name} string")
    return rows(a, "a").join(rows(b, "b"), "path", "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))


def metric_deltas(a: DataFrame, b: DataFrame) -> DataFrame:
    """(stage, metric, a, b, delta, pct) where both runs have the metric; a base of 0 gives 0 percent; six digits."""
    both = a.select("stage", "metric", F.col("value").alias("a")).join(b.select("stage", "metric", F.col("value").alias("b")), ["stage", "metric"])
    delta = F.col("b") - F.col("a")
    return both.withColumn("delta", F.bround(delta, 6)).withColumn("pct", F.when(F.col("a") == 0, 0.0).otherwise(F.bround(delta / F.abs("a") * 100, 2)))


def config_hash(config: Mapping) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()[:12]


def run_hash(config: Mapping) -> str:
    return hashlib.md5(json.dumps(config, sort_keys=True).encode()).hexdigest()[:8]
