"""Telemetry: counters, gauges, histograms, exposition text, moving statistics, alerts, early stopping."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Cells of a group's values in which a rank is looked for first.
CELLS = 4096


def counters(rows: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    return rows.groupBy(*by).agg(F.sum(value).alias("total"))


def gauges(rows: DataFrame, by: list[str], value: str, *order: str) -> DataFrame:
    """The last value in order."""
    return rows.groupBy(*by).agg(F.max_by(value, F.struct(*order)).alias("last"))


def histogram(rows: DataFrame, by: list[str], buckets: Sequence[float], value: str = "value", compat: bool = False) -> DataFrame:
    """(by, le, n, sum, count): observations up to each bound, and all of them under +Inf.

    compat gives the sums of these counts over the bounds so far, as exporters write that accumulate twice.
    """
    counts = [F.count_if(F.col(value) <= b).alias(f"_{i}") for i, b in enumerate(buckets)]
    sums = rows.groupBy(*by).agg(*counts, F.sum(value).alias("sum"), F.count(value).alias("count"))
    at = [F.col(f"_{i}") for i in range(len(buckets))]
    if compat:
        at = [sum(at[1 : i + 1], at[0]) for i in range(len(at))]
    cells = [F.struct(F.lit(f"{b:g}").alias("le"), c.cast("long").alias("n")) for b, c in zip(buckets, at, strict=True)]
    spread = sums.select(*by, "sum", "count", F.explode(F.array(*cells, F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("n")))).alias("_c"))
    return spread.select(*by, "_c.le", "_c.n", "sum", "count")


def labels_text(labels: Column) -> Column:
    """{a="1",b="2"} of a map, by name; "" of an empty one."""
    parts = F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit('="'), e["value"], F.lit('"')))
    return F.when(F.size(labels) > 0, F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))).otherwise("")


def number_text(x: Column) -> Column:
    """A double as Python writes it: as short as it can be, with an exponent only below 1e-4 and from 1e16 on. Java's has one from 1e7 on."""

    def shown(values: pd.Series) -> pd.Series:
        return pd.Series([repr(v) for v in values.tolist()], dtype=object)

    return F.when(x.isNotNull(), F.pandas_udf(shown, "string")(x))


def exposition(series: DataFrame) -> DataFrame:
    """(name, text): a block of Prometheus text for each name of series (name, type, labels, value), its lines by their labels; null without a line."""
    value = F.col("value").cast("string")
    if dict(series.dtypes)["value"] in ("float", "double"):
        value = number_text(value.cast("double"))  # a float keeps its own digits
    line = F.concat("name", labels_text(F.col("labels")), F.lit(" "), value)
    lines = series.select("name", "type", F.array_sort(F.map_entries("labels")).alias("_at"), line.alias("_line"))
    block = lines.groupBy("name", "type").agg(F.array_sort(F.collect_list(F.when(F.col("_line").isNotNull(), F.struct("_at", "_line")))).alias("_l"))
    text = F.concat(F.lit("# TYPE "), "name", F.lit(" "), "type", F.lit("\n"), F.array_join("_l._line", "\n"), F.lit("\n"))
    return block.select("name", F.when(F.size("_l") > 0, text).alias("text"))


def nearest_rank(rows: DataFrame, by: list[str], value: str, share: float = 0.99, last: int | None = None, order: list[str] | None = None) -> DataFrame:
    """(by, n, mean, pxx): sorted[int(n * share)] of the values, or of the last ones in order; nulls don't count."""
    if last is not None:
        w = Window.partitionBy(*by).orderBy(*(F.col(c).desc() for c in order or []))
        rows = rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= last)
    # cells of equal width between a group's extremes: the one that holds the rank is found by counts, and only its rows are ranked
    ends = rows.groupBy(*by).agg(F.min(value).cast("double").alias("_low"), F.max(value).cast("double").alias("_high"), F.count(value).alias("n"), F.avg(value).alias("mean"))
    width = (F.col("_high") - F.col("_low")) / CELLS
    keys = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    beside = lambda table: rows.where(F.col(value).isNotNull()).join(table.withColumnsRenamed({c: f"_by_{c}" for c in by}), reduce(lambda x, y: x & y, keys, F.lit(True)))
    cell = F.least(F.lit(CELLS - 1), F.coalesce(F.floor(F.try_divide(F.col(value) - F.col("_low"), width)), F.lit(0))).cast("int")
    counted = beside(ends).groupBy(*by, "_low", "_high", "n", "mean", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    to = F.sum("_n").over(Window.partitionBy(*by).orderBy("_cell"))  # at most CELLS rows a group
    wanted = F.least(F.floor(F.col("n") * share), F.col("n") - 1)
    at = counted.withColumn("_to", to).where((F.col("_to") > wanted) & (F.col("_to") - F.col("_n") <= wanted))
    at = at.select(*by, "_low", "_high", "n", "mean", F.col("_cell").alias("_at"), (wanted - (F.col("_to") - F.col("_n"))).alias("_rank"))
    inside = beside(at).where(cell == F.col("_at")).groupBy(*by, "n", "mean", "_rank", F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*by).orderBy("_v"))
    return inside.withColumn("_to", upto).groupBy(*by, "n", "mean").agg(F.min(F.when(F.col("_to") > F.col("_rank"), F.col("_v"))).alias("pxx")).select(*by, "n", "mean", "pxx")


def ema(rows: DataFrame, by: str, order: str, value: str, alpha: float = 0.1) -> DataFrame:
    """(by, order, value, ema): e0 = x0, e = alpha * x + (1 - alpha) * e before. A run is one series and is folded by one task."""
    kinds = dict(rows.dtypes)

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order)
        return frame.assign(ema=frame[value].astype(float).ewm(alpha=alpha, adjust=False).mean())

    return rows.select(by, order, value).groupBy(by).applyInPandas(fold, f"{by} {kinds[by]}, {order} {kinds[order]}, {value} {kinds[value]}, ema double")


def spikes(rows: DataFrame, by: str, order: list[str], value: str, window: int = 100, least: int = 10, z: float = 5.0) -> DataFrame:
    """rows with z_score against the last `window` rows, this one included, and is_spike; null below `least` rows or without spread."""
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(-(window - 1), 0)
    n, mean, spread = F.count(value).over(w), F.avg(value).over(w), F.stddev_pop(value).over(w)
    score = F.when((n >= least) & (spread > 0), (F.col(value) - mean) / spread)
    return rows.withColumn("z_score", score).withColumn("is_spike", F.coalesce(F.col("z_score") > z, F.lit(False)))


def early_stop(rows: DataFrame, by: str, order: str, value: str, patience: int = 5, min_delta: float = 0.0, min_evals: int = 3) -> DataFrame:
    """(by, best, stop_at): the step at which a falling metric has not improved by more than min_delta for `patience` evaluations.

    The first min_evals - 1 evaluations count for nothing; the next one sets the best. stop_at is null if it never stops.
    """
    evals = F.array_sort(F.collect_list(F.struct(F.col(order).cast("long").alias("o"), F.col(value).cast("double").alias("x"))))
    start = F.struct(F.lit(0).alias("seen"), F.lit(None).cast("double").alias("best"), F.lit(0).alias("bad"), F.lit(None).cast("long").alias("stop"))

    def step(s: Column, e: Column) -> Column:
        live = s["stop"].isNull() & (s["seen"] + 1 >= min_evals)
        better = s["best"].isNull() | (s["best"] - e["x"] > min_delta)
        bad = F.when(~live, s["bad"]).when(better, 0).otherwise(s["bad"] + 1)
        return F.struct((s["seen"] + 1).alias("seen"), F.when(live & better, e["x"]).otherwise(s["best"]).alias("best"), bad.alias("bad"), F.when(live & ~better & (s["bad"] + 1 >= patience), e["o"]).otherwise(s["stop"]).alias("stop"))

    return rows.groupBy(by).agg(evals.alias("_e")).select(by, F.aggregate("_e", start, step).alias("_s")).select(by, "_s.best", F.col("_s.stop").alias("stop_at"))


def stale_checkpoints(rows: DataFrame, by: str, step: str, keep: int = 3) -> DataFrame:
    """Checkpoints to delete: all but the last `keep` by step."""
    w = Window.partitionBy(by).orderBy(F.col(step).desc())
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") > keep).drop("_rn")


def norms(arrays: DataFrame) -> DataFrame:
    """(param, norm, dead) of (param, values): L2 norm, and whether it is below 1e-8."""
    norm = F.sqrt(F.aggregate("values", F.lit(0.0), lambda s, x: s + x * x))
    return arrays.select("param", norm.alias("norm")).withColumn("dead", F.col("norm") < 1e-8)


def alerts(rows: DataFrame, by: str, order: str, value: str, compare: str, bound: float, cooldown_s: float) -> DataFrame:
    """(by, fired_at): rows that break the bound ("gt", "lt", "eq") more than cooldown_s after the last that fired.

    Only breaking rows are folded, and only their distinct times.
    """
    breaks = {"gt": F.col(value) > bound, "lt": F.col(value) < bound, "eq": F.col(value) == bound}[compare]
    kinds = dict(rows.dtypes)

    def fired(frame: pd.DataFrame) -> pd.DataFrame:
        """The next alert is looked up behind the cooldown of the last, so a series costs a search for each alert."""
        at = np.sort(frame["_us"].to_numpy())
        out, next_one = [], 0
        while next_one < len(at):
            out.append(at[next_one])
            next_one = int(np.searchsorted(at, at[next_one] + cooldown_s * 1e6, "right"))
        return pd.DataFrame({by: [frame[by].iat[0]] * len(out), "_us": out})

    # a time at which several rows break is one row before the shuffle
    hit = rows.where(breaks).select(by, F.unix_micros(F.col(order).cast("timestamp")).alias("_us")).distinct()
    return hit.groupBy(by).applyInPandas(fired, f"{by} {kinds[by]}, _us long").select(by, F.timestamp_micros("_us").alias("fired_at"))


def append_log(rows: DataFrame, path: str) -> None:
    """Adds rows to a log of metrics; what is there stays."""
    rows.write.mode("append").parquet(path)


def latest_stage(rows: DataFrame) -> DataFrame:
    """Of (stage, status, end_time) the completed stage that ended last."""
    return rows.where("status = 'completed'").agg(F.max_by("stage", "end_time").alias("stage"))


def loss_summary(rows: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """(by, steps, first, last, least, improvement)."""
    out = rows.groupBy(by).agg(F.count(F.lit(1)).alias("steps"), F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"), F.min(value).alias("least"))
    return out.withColumn("improvement", F.col("first") - F.col("last"))
