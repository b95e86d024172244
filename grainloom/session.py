"""What operators ask of the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the checkpoint directory the cluster names; one of our own only where all run on this machine."""
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    if not known.isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="grainloom-"))
        known = sc._jsc.sc().getCheckpointDir()
    return known.get()


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/grainloom-{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """The same rows, their lineage cut by a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def numbered(rows: DataFrame, order: list[str], out: str) -> DataFrame:
    """rows with `out`: 0, 1, 2, … in order, ranked within ranges of it and shifted by the counts of those before. Rows that tie in all of order are one range's."""
    parts = settled(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    shift = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return parts.withColumn(out, own).join(F.broadcast(shift), "_part").withColumn(out, (F.col(out) + F.col("_shift")).cast("long")).drop("_part", "_shift")


#: Tables of at least this many bytes come in enough pieces of their own.
SPREAD_BELOW = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """A small table dealt to all cores: one file of one row group is else one task, however dear each row is."""
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) >= SPREAD_BELOW:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
