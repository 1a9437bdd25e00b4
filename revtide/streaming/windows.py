"""Streaming forms of deduplication, outcome counts and lost operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtide.operators.telemetry import operation_counts, outcome_label


def dedupe_stream(deliveries: DataFrame, window: str, ts: str = "ts", id: str = "id") -> DataFrame:
    """One message per stable id inside the window; state older than it is dropped."""
    return deliveries.withWatermark(ts, window).dropDuplicatesWithinWatermark([id])


def operation_counts_stream(observations: DataFrame) -> DataFrame:
    """Running counts per operation and outcome, for update mode; state is a few dozen rows."""
    return operation_counts(observations)


def abandoned_stream(starts: DataFrame, finishes: DataFrame, timeout: str, late: str = "1 minute"):
    """Stream-stream outer join: a start whose finish does not come in time is abandoned.

    ``starts``: ``observation, operation, ts``; ``finishes``: ``observation, result, ts``. The
    observation id must be unique among starts and among finishes.
    """
    begun = starts.withWatermark("ts", late).alias("s")
    ended = (
        finishes.withColumnRenamed("observation", "finished")
        .withColumnRenamed("ts", "finished_ts")
        .withWatermark("finished_ts", late)
    )
    in_time = F.expr(f"finished_ts >= ts AND finished_ts <= ts + INTERVAL {timeout}")
    joined = begun.join(ended, (F.col("observation") == F.col("finished")) & in_time, "left_outer")
    outcome = F.when(F.col("finished").isNull(), "abandoned").otherwise(
        outcome_label(F.col("result"))
    )
    return joined.select("observation", "operation", F.col("s.ts").alias("ts"), outcome.alias("outcome"))
