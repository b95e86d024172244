"""Helpers that the operators of this subpackage share.

Cutting lineage, small bounded tables, and a rank without gaps that never puts a hot group into one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import cache
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grainloom.session import scratch, settled, shared_dir

__all__ = ["drop_tables", "gapless_rank", "quiet_threads", "renamed", "scratch", "settled", "shared_dir", "short_batches", "stored", "table"]

#: Where the tables of stored() are.
_TABLES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Groups of a rank are cut so that none holds more than about 1/RANK_PARTS of the rows.
RANK_PARTS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The same rows, read from a Parquet table written below the shared folder: lineage is cut, Spark knows the size, and drop_tables() can remove it."""
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _TABLES[out] = path
    return out


def renamed(table: DataFrame, out: DataFrame) -> DataFrame:
    """out, a view of the stored table, as what drop_tables() is given from now on."""
    if path := _TABLES.pop(table, None):
        _TABLES[out] = path
    return out


def drop_tables(*tables: DataFrame) -> None:
    """Removes tables that stored() wrote and nothing will read again; others are left alone."""
    for df in tables:
        if path := _TABLES.pop(df, None):
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What is run inside hands whole texts to Python in Arrow batches of `rows` rows at most: JVM and worker both hold a batch at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@cache
def _libc():
    import ctypes

    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:  # another C library, which has its own ways
        return None


def quiet_threads(keep_tokens: bool = False) -> None:
    """One thread a task: native libraries must not start more than Spark gave. A worker that did another operator's tasks
    before lets go of the token ids that it remembers, unless it needs them, and of memory that those tasks have freed."""
    import os
    import sys

    if not keep_tokens and "grainloom.llm.wordbpe" in sys.modules:
        sys.modules["grainloom.llm.wordbpe"].loaded.cache_clear()
    for name in ("OMP_NUM_THREADS", "RAYON_NUM_THREADS"):
        os.environ.setdefault(name, "1")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if trim := getattr(_libc(), "malloc_trim", None):
        trim(0)


def gapless_rank(df: DataFrame, group: str, sizes: Mapping[int, int], order: list[Column], out: str) -> DataFrame:
    """Adds `out`: 0, 1, 2, ... within each value of the integer column `group`, in an unspecified but complete order.

    sizes: rows of each group; the caller bounds the number of groups. A group is cut by a hash of `order` into as many
    parts as its share of all rows asks for, each part is numbered by itself and shifted by the parts before it, so the
    largest window holds about 1/RANK_PARTS of the rows however hot a group is. So that rows repeated as a whole are cut
    too, `order` ends with a column that tells rows apart, as `_tie` of monotonically_increasing_id(). df is read twice:
    give one whose lineage was cut after that column came.
    """
    spark, total = df.sparkSession, max(1, sum(sizes.values()))
    parts = spark.createDataFrame([(int(g), max(1, -(-RANK_PARTS * n // total))) for g, n in sizes.items()], "_g long, _parts long")
    cut = df.withColumn("_g", F.col(group).cast("long")).join(F.broadcast(parts), "_g").withColumn("_part", F.pmod(F.xxhash64(*order), F.col("_parts")))
    # at most RANK_PARTS + len(sizes) rows
    counts = cut.groupBy("_g", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("_g", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    within = Window.partitionBy("_g", "_part").orderBy(*order)
    ranked = cut.withColumn("_in", F.row_number().over(within) - 1)
    return ranked.join(F.broadcast(shift), ["_g", "_part"]).withColumn(out, (F.col("_in") + F.col("_shift")).cast("long")).drop("_g", "_part", "_parts", "_in", "_shift")
