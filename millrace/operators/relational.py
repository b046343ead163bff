"""Keyed folds, rankings and retention over observation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def newest(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The newest row per key by a ranked window, which keeps one row per key and partition before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def versions(df: DataFrame, key: str, content: str, *order: str) -> DataFrame:
    """Numbers the versions of a key: one more whenever ``content`` changes in ``order``."""
    w = W.partitionBy(key).orderBy(*order)
    changed = F.when(F.lag(content).over(w).isNull() | ~F.lag(content).over(w).eqNullSafe(F.col(content)), 1).otherwise(0)
    return df.withColumn("_c", changed).withColumn("version", F.sum("_c").over(w)).drop("_c")


def recent_unique(df: DataFrame, owner: str, value: str, n: int, *order: str) -> DataFrame:
    """Last occurrence of each value per owner, the newest ``n`` of them."""
    last = df.groupBy(owner, value).agg(F.max(F.struct(*order)).alias("_o")).select(owner, value, "_o.*")
    w = W.partitionBy(owner).orderBy(*[F.desc(c) for c in order], value)
    return last.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= n)


def round_robin(df: DataFrame, bucket: str, *order: str) -> DataFrame:
    """Fair order over buckets: the first of each, then the second of each."""
    return df.withColumn("round", F.row_number().over(W.partitionBy(bucket).orderBy(*order)))


def supported_status(obs: DataFrame) -> DataFrame:
    """``job_id, stored_status, score, missing`` from the observations of its sources.

    Closed if every source saw it closed or missed it to its threshold; in
    review if any source saw it closed or in review, or all miss it; else
    active.  Null scores count 0, a closed posting scores 0.
    """
    closed = (F.col("observed_status") == "closed") | (F.col("consecutive_missing") >= F.coalesce("closure_threshold", F.lit(2)))
    folded = obs.groupBy("job_id").agg(
        F.bool_and(F.coalesce(closed, F.lit(False))).alias("all_closed"),
        F.bool_or(F.coalesce(F.col("observed_status").isin("closed", "needs_review"), F.lit(False))).alias("any_doubt"),
        F.bool_and(F.coalesce(F.col("consecutive_missing") >= 1, F.lit(False))).alias("all_missing"),
        F.max(F.coalesce("active_score", F.lit(0))).alias("top"),
        F.min("consecutive_missing").alias("missing"),
    )
    status = F.when(F.col("all_closed"), "closed").when(F.col("any_doubt") | F.col("all_missing"), "needs_review").otherwise("confirmed_active")
    return folded.select("job_id", status.alias("stored_status"), F.when(F.col("all_closed"), 0).otherwise(F.col("top")).alias("score"), "missing")


def missing_advance(obs: DataFrame, seen: Column, whole: Column) -> DataFrame:
    """The counts after a pass: ``job_id, source_id, missing_after, mode_after, status_after, score_after``.

    A support that was ``seen`` starts at zero.  One that a ``whole`` feed didn't
    list counts one more, from zero if it was only marked before, and closes at
    its threshold, two at least; a partial feed marks it for review, caps its
    score at 50 and never touches a running count.  Closed ones stay.
    """
    open_ = ~seen & (F.col("observed_status") != "closed")
    streak = F.when(F.col("missing_mode") == "review_only", 0).otherwise(F.col("consecutive_missing")) + 1
    missing = F.when(seen, 0).when(open_ & whole, streak).when(open_ & (F.col("consecutive_missing") == 0), 1).otherwise(F.col("consecutive_missing"))
    gone = open_ & whole & (streak >= F.greatest(F.lit(2), F.coalesce("closure_threshold", F.lit(2))))
    score = F.coalesce("active_score", F.lit(0))
    return obs.select(
        "job_id",
        "source_id",
        missing.cast("long").alias("missing_after"),
        F.when(open_ & whole, "authoritative").when(open_ & (F.col("consecutive_missing") == 0), "review_only").otherwise(F.col("missing_mode")).alias("mode_after"),
        F.when(gone, "closed").when(open_, "needs_review").otherwise(F.col("observed_status")).alias("status_after"),
        F.when(gone, 0).when(open_ & ~whole, F.least(score, F.lit(50))).otherwise(score).alias("score_after"),
    )


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    for k in keys:
        df = df.filter(F.col(k).isNotNull() & (F.col(k) != ""))
    return df


def conflicting_keys(df: DataFrame, keys: list[str], url: str, identity: str) -> DataFrame:
    """``keys, urls, identities`` of ``key_conflicts``, without the sample."""
    return _keyed(df, keys).groupBy(*keys).agg(F.countDistinct(url).alias("urls"), F.countDistinct(identity).alias("identities")).filter("urls > 1 AND identities > 1")


def key_conflicts(df: DataFrame, keys: list[str], url: str, identity: str, row: str, sample: int = 20) -> DataFrame:
    """``keys, urls, identities, sample``: keys that stand for several URLs and several identities at once.

    Null and empty keys take no part; a changed URL or a changed identity alone
    is an update.
    """
    asked = _keyed(df, keys)
    found = conflicting_keys(df, keys, url, identity)
    # Only the rows of conflicting keys are ranked for the sample.  No semi join: Spark pushes one below a union and
    # takes the parts for partitioned alike, which they may not be once they run.
    first = asked.join(found.select(*keys), keys).select(*keys, row).distinct().withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(row))).filter(F.col("_n") <= sample)
    shown = first.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", F.col(row).cast("string").alias("r")))), lambda x: x["r"]), ",").alias("sample"))
    return found.join(shown, keys)


def page(df: DataFrame, limit: int, cursor: int, *order: Column) -> DataFrame:
    """One page in a total order."""
    return df.orderBy(*order).offset(cursor).limit(limit)


def asof_latest(left: DataFrame, right: DataFrame, key: str, at_left: str, at_right: str, out: str) -> DataFrame:
    """Adds to ``left`` the latest ``at_right`` of the same key not after ``at_left``, else null.

    Time is cut into months, so that a key with very many rows is spread over
    many window groups; what the earlier months end with is carried in from a
    table of one row per key and month.
    """
    month = lambda c: F.date_trunc("month", c)
    seen = right.select(F.col(key).alias("_k"), F.col(at_right).alias("_at")).filter("_k IS NOT NULL AND _at IS NOT NULL").distinct()
    per_month = seen.groupBy("_k", month("_at").alias("_m")).agg(F.max("_at").alias("_last"))
    asked = left.withColumn("_k", F.col(key)).withColumn("_at", F.col(at_left)).withColumn("_m", month(F.col(at_left)))
    months = per_month.unionByName(asked.select("_k", "_m").distinct().withColumn("_last", F.lit(None).cast("timestamp"))).groupBy("_k", "_m").agg(F.max("_last").alias("_last"))
    before = W.partitionBy("_k").orderBy("_m").rowsBetween(W.unboundedPreceding, -1)
    carried = months.select("_k", "_m", F.max("_last").over(before).alias("_carry"))
    both = asked.withColumn("_seen", F.lit(None).cast("timestamp")).withColumn("_q", F.lit(1)).unionByName(
        seen.select("_k", "_at", month("_at").alias("_m"), F.col("_at").alias("_seen"), F.lit(0).alias("_q")), allowMissingColumns=True
    )
    within = F.max("_seen").over(W.partitionBy("_k", "_m").orderBy("_at", "_q").rowsBetween(W.unboundedPreceding, W.currentRow))
    got = both.withColumn("_w", within).filter("_q = 1").join(carried, ["_k", "_m"], "left")
    return got.withColumn(out, F.coalesce("_w", "_carry")).select(*left.columns, out)
