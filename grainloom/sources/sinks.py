"""Sinks: JSON lines in files of bounded length, Parquet by split, reports, weights."""

from __future__ import annotations

from pyspark.sql import DataFrame


def jsonl_batches(rows: DataFrame, path: str, each: int = 500) -> None:
    rows.write.option("maxRecordsPerFile", each).mode("overwrite").json(path)


def splits(rows: DataFrame, path: str, form: str = "parquet") -> None:
    """One folder a split; "arrow" is written as Parquet."""
    rows.write.partitionBy("split").mode("overwrite").format({"arrow": "parquet", "jsonl": "json"}.get(form, form)).save(path)


def scored_and_passed(scored: DataFrame, path: str, least: float = 3.5) -> None:
    """Two outputs of one computation: all scored rows, then those that pass, read back from what was written."""
    scored.write.mode("overwrite").parquet(f"{path}/scored")
    scored.sparkSession.read.parquet(f"{path}/scored").where(f"composite_score >= {least}").write.mode("overwrite").parquet(f"{path}/passed")


def report(row: DataFrame, path: str) -> None:
    row.coalesce(1).write.mode("overwrite").json(path)


def weights(state: DataFrame, path: str) -> None:
    state.write.mode("overwrite").parquet(path)
