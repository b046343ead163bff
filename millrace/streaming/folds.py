"""Incremental forms of the folds: Structured Streaming over arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_budget(events: DataFrame, at: str, limit: int, late: str = "1 day") -> DataFrame:
    """Requests per UTC day and what exceeds ``limit``; rows later than ``late`` are dropped by the watermark."""
    days = events.withWatermark(at, late).groupBy(F.window(at, "1 day").alias("w")).agg(F.count("*").alias("used"))
    return days.select(F.to_date("w.start").alias("day"), "used", F.greatest(F.col("used") - limit, F.lit(0)).alias("over_budget"))


def sliding_rate(events: DataFrame, at: str, seconds: int = 60, step: int = 10, late: str = "5 minutes") -> DataFrame:
    """Calls per sliding window."""
    return events.withWatermark(at, late).groupBy(F.window(at, f"{seconds} seconds", f"{step} seconds").alias("w")).agg(F.count("*").alias("calls")).select("w.start", "w.end", "calls")


def sessions(events: DataFrame, key: str, at: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Bursts of one key that no gap interrupts."""
    return events.withWatermark(at, late).groupBy(key, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n")).select(key, "w.start", "w.end", "n")


def distinct_observations(observations: DataFrame, keys: list[str], at: str, late: str = "14 days") -> DataFrame:
    """Observations without the overlap of resumed passes."""
    return observations.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def merge_observations(state: DataFrame, batch: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Newest observation per key of state and micro-batch; repeating a batch changes nothing (for ``foreachBatch``)."""
    both = state.unionByName(batch)
    rest = [c for c in state.columns if c not in keys]
    ordered = F.struct(F.col(at), *[F.col(c) for c in sorted(rest) if c != at])
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordered).alias("_r")).select(*keys, "_r.*")
