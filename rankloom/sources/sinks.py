"""Sinks: snapshots, prediction files, tables, isolated batches."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")


def write_csv_snapshot(df: DataFrame, root: str, prefix: str, stamp: str | None = None) -> str:
    """Quote-all CSV with doubled quotes under a time-stamped path."""
    path = f"{root.rstrip('/')}/{prefix}_{stamp or run_stamp()}"
    df.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return path


def write_predictions(df: DataFrame, path: str) -> None:
    df.select("job_id", "resume_id", "prediction").write.mode("overwrite").json(path)


def reset_table(df: DataFrame, path: str) -> None:
    """Delete-all and reload as one overwrite."""
    df.write.mode("overwrite").parquet(path)


def write_embeddings(df: DataFrame, path: str, features: str = "X", target: str = "y") -> None:
    df.select(F.col(features).cast("array<float>").alias("X"), F.col(target).alias("y")).write.mode("overwrite").parquet(path)


def batch_report(rows: DataFrame, queue: list[str]) -> DataFrame:
    """Rows written, rows good and verdict per numbered batch."""
    return rows.groupBy(*queue, "batch").agg(
        F.count("*").alias("n_rows"), F.count_if("ok").alias("n_ok"), F.bool_and("ok").alias("batch_ok")
    )


def write_in_batches(rows: DataFrame, write: Callable[[list], None], size: int = 100) -> DataFrame:
    """Hand rows to ``write`` in calls of at most ``size`` and report each call.

    Every task cuts its own rows into calls, so a call never waits for another
    task and never holds more than ``size`` rows; a failing call is reported and
    the others go on.
    """
    import pandas as pd
    from pyspark import TaskContext

    def send(batches):
        part, call = TaskContext.get().partitionId(), 0
        for pdf in batches:
            for start in range(0, len(pdf), size):
                chunk = pdf.iloc[start : start + size]
                error = None
                try:
                    write(chunk.to_dict("records"))
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
                yield pd.DataFrame({"task": [part], "call": [call], "n_rows": [len(chunk)], "error": [error]})
                call += 1

    return rows.mapInPandas(send, "task int, call int, n_rows long, error string")
