"""Streams of events (ts, event_type, user_id, value): windows, rates, sessions, alerts with a hold time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet files of a folder as they come."""
    return spark.readStream.schema(schema).parquet(path)


def _timed(events: DataFrame, late: str) -> DataFrame:
    """Event times as timestamps, with a watermark on a stream."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.withWatermark("ts", late) if events.isStreaming else rows


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, event_type, n, total); batch or stream."""
    rows = _timed(events, late)
    out = rows.groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sliding_rate(events: DataFrame, width: str = "1 hour", slide: str = "15 minutes", seconds: float = 3600, late: str = "10 minutes") -> DataFrame:
    """(start, event_type, n, rate a second) of sliding windows."""
    rows = _timed(events, late)
    out = rows.groupBy(F.window("ts", width, slide), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", (F.col("n") / seconds).alias("rate"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(user_id, start, finish, n): a user's events with less than gap between neighbours; finish is the last event plus gap."""
    rows = _timed(events, late)
    out = rows.groupBy("user_id", F.session_window("ts", gap)).agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("finish"), "n")


def distinct_events(events: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """The first of equal keys within the watermark."""
    rows = _timed(events, late)
    return rows.dropDuplicatesWithinWatermark(keys) if events.isStreaming else rows.dropDuplicates(keys)


def held_alerts(events: DataFrame, above: float, hold_s: float, late: str = "10 minutes") -> DataFrame:
    """(event_type, fired_at): a type whose values stay above a bound for at least hold_s seconds; it fires once a breach.

    State is a breach's begin and whether it fired; rows of a trigger are taken in order of time.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        begin, fired = state.get if state.exists else (None, False)
        rows = pd.concat(list(frames)).sort_values("ts")
        out = []
        for ts, value in zip(rows["ts"], rows["value"], strict=True):
            if not value > above:
                begin, fired = None, False
                continue
            begin = begin or int(ts.value // 1000)
            if not fired and ts.value // 1000 - begin >= hold_s * 1e6:
                fired = True
                out.append(ts)
        state.update((begin, fired))
        if out:
            yield pd.DataFrame({"event_type": [key[0]] * len(out), "fired_at": out})

    grouped = _timed(events, late).groupBy("event_type")
    return grouped.applyInPandasWithState(step, "event_type string, fired_at timestamp", "begin long, fired boolean", "append", GroupStateTimeout.NoTimeout)


def each_batch(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]):
    """Runs what is there, batch by batch; after a restart from the checkpoint only new files come."""
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
