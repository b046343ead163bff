"""Incremental folds as queries: the tables arrive as streams and are folded to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.plans.catalog_base import Catalog
from millrace.streaming import folds
from millrace.streaming.runs import arriving, fold_available

CATALOG = Catalog()
query = CATALOG.query


def _events(spark, d):
    return arriving(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS used, greatest(count(*) - 300, 0) AS over_budget FROM events GROUP BY 1")
def streamed_budget(spark, d):
    """Requests per day and what exceeds the budget, from the arriving events."""
    stream = folds.daily_budget(_events(spark, d), "ts", 300)
    got = fold_available(stream, lambda _, batch: batch, "complete")
    return got.select(F.col("day").cast("string").alias("day"), "used", F.col("over_budget").cast("long").alias("over_budget"))


@query("""SELECT w * 600 AS start_s, count(*) AS calls FROM (SELECT unnest([epoch_us(ts) // 1000000 // 600, epoch_us(ts) // 1000000 // 600 - 1]) AS w FROM events) GROUP BY 1""")
def streamed_rate(spark, d):
    """Calls per twenty minutes, every ten minutes anew."""
    stream = folds.sliding_rate(_events(spark, d), "ts", 1200, 600)
    got = fold_available(stream, lambda _, batch: batch, "complete")
    return got.select(F.unix_seconds("start").alias("start_s"), "calls")


@query("""WITH x AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS n FROM events), s AS (SELECT user_id, ts, sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM x)
  SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS n FROM s GROUP BY user_id, k""")
def streamed_sessions(spark, d):
    """Bursts of a user that no six hours interrupt."""
    stream = folds.sessions(_events(spark, d), "user_id", "ts", "6 hours")
    got = fold_available(stream, lambda _, batch: batch, "complete")
    return got.select("user_id", F.unix_micros("start").alias("start_us"), "n")


@query("SELECT job_id, source_id, max_by(observed_status, last_observed_at) AS status, max_by(consecutive_missing, last_observed_at) AS missing, epoch_us(max(last_observed_at)) AS seen_us FROM job_source_obs GROUP BY ALL")
def streamed_observations(spark, d):
    """The newest observation of each posting and source, merged batch by batch."""
    stream = arriving(spark, d, "job_source_obs").select("job_id", "source_id", "observed_status", "consecutive_missing", "last_observed_at")
    merge = lambda state, batch: folds.merge_observations(batch.limit(0) if state is None else state, batch, ["job_id", "source_id"], "last_observed_at")
    got = fold_available(stream, merge)
    return got.select("job_id", "source_id", F.col("observed_status").alias("status"), F.col("consecutive_missing").alias("missing"), F.unix_micros("last_observed_at").alias("seen_us"))
