"""Queries of the registry: lists, rollups, coverage, folds and audits, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.functions import expressions as X
from millrace.functions import urls as U
from millrace.operators import relational as R
from millrace.session import table

#: The instant at which the queries look at the data.
NOW = "2026-08-20 00:00:00"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str):
    """Registers a query under its name, with the SQL that gives the same rows."""

    def add(f):
        _QUERIES[f.__name__] = f
        _SQL[f.__name__] = sql
        return f

    return add


_LATEST = "(SELECT * FROM jobs QUALIFY row_number() OVER (PARTITION BY id ORDER BY observed_at DESC, rec_id DESC) = 1)"


def _latest(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return R.newest(table(spark, d, "jobs").select("id", "observed_at", "rec_id", *columns), ["id"], "observed_at", "rec_id")


def _active(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sources").filter("lifecycle = 'approved' AND collection_enabled")


_STATUS_SQL = """SELECT job_id, CASE WHEN bool_and(coalesce(observed_status = 'closed' OR consecutive_missing >= coalesce(closure_threshold, 2), false)) THEN 'closed'
  WHEN bool_or(coalesce(observed_status IN ('closed', 'needs_review'), false)) OR bool_and(coalesce(consecutive_missing >= 1, false)) THEN 'needs_review' ELSE 'confirmed_active' END AS stored_status,
  CASE WHEN bool_and(coalesce(observed_status = 'closed' OR consecutive_missing >= coalesce(closure_threshold, 2), false)) THEN 0 ELSE max(coalesce(active_score, 0)) END AS score,
  min(consecutive_missing) AS missing FROM job_source_obs GROUP BY job_id"""


@query(_STATUS_SQL)
def stored_status(spark, d):
    return R.supported_status(table(spark, d, "job_source_obs"))


@query("SELECT id, source_key, lifecycle, count(*) OVER () AS total FROM sources WHERE lifecycle = 'approved' ORDER BY discovered_at DESC, id LIMIT 50 OFFSET 10")
def list_sources_page(spark, d):
    rows = table(spark, d, "sources").filter("lifecycle = 'approved'")
    total = rows.agg(F.count("*").alias("total"))
    return R.page(rows.select("id", "source_key", "lifecycle", "discovered_at"), 50, 10, F.desc("discovered_at"), F.asc("id")).crossJoin(F.broadcast(total)).drop("discovered_at")


_NORMAL = r"regexp_replace(lower(coalesce({0}, '')), '[\s\p{{Z}}\p{{P}}\p{{S}}]+', '', 'g')"


@query("""WITH x AS (SELECT rec_id, id, content_hash, CASE WHEN lag(content_hash) OVER w IS NULL OR lag(content_hash) OVER w IS DISTINCT FROM content_hash THEN 1 ELSE 0 END AS c, observed_at FROM jobs WINDOW w AS (PARTITION BY id ORDER BY observed_at, rec_id))
  SELECT rec_id, id, CAST(sum(c) OVER (PARTITION BY id ORDER BY observed_at, rec_id) AS BIGINT) AS version FROM x""")
def job_versions(spark, d):
    return R.versions(table(spark, d, "jobs").select("rec_id", "id", "content_hash", "observed_at"), "id", "content_hash", "observed_at", "rec_id").select("rec_id", "id", "version")


@query(f"SELECT id, rec_id, status, epoch_us(observed_at) AS seen_us FROM {_LATEST}")
def latest_snapshot(spark, d):
    return _latest(spark, d, "status").select("id", "rec_id", "status", F.unix_micros("observed_at").alias("seen_us"))


@query("SELECT coalesce(provider, 'none') AS provider, count(*) AS n, count(*) FILTER (lifecycle = 'approved') AS approved, count(*) FILTER (collection_enabled) AS enabled FROM sources GROUP BY 1")
def source_histogram(spark, d):
    return table(spark, d, "sources").groupBy(F.coalesce("provider", F.lit("none")).alias("provider")).agg(F.count("*").alias("n"), F.count_if(F.col("lifecycle") == "approved").alias("approved"), F.count_if("collection_enabled").alias("enabled"))


@query("SELECT coalesce(source_id, 'none') AS source_id, count(*) AS hits, count(DISTINCT query_id) AS queries, min(rank_no) AS best_rank, epoch_us(max(discovered_at)) AS last_us FROM discovery_hits GROUP BY 1")
def discovery_groups(spark, d):
    return table(spark, d, "discovery_hits").groupBy(F.coalesce("source_id", F.lit("none")).alias("source_id")).agg(F.count("*").alias("hits"), F.countDistinct("query_id").alias("queries"), F.min("rank_no").alias("best_rank"), F.unix_micros(F.max("discovered_at")).alias("last_us"))


_HOST = "regexp_extract(lower({0}), '^https?://([^/?#@:]+)', 1)"


@query(f"""SELECT t.id AS target_id, count(DISTINCT s.id) AS matched, CASE WHEN bool_or(coalesce(s.lifecycle = 'approved', false)) THEN 'approved' WHEN bool_or(coalesce(s.lifecycle = 'probed', false)) THEN 'verified' WHEN count(s.id) > 0 THEN 'discovered' ELSE 'missing' END AS coverage
  FROM employer_targets t LEFT JOIN sources s ON list_bool_or(list_transform(t.official_domains, lambda x: {_HOST.format('s.source_root_url')} = x OR ends_with({_HOST.format('s.source_root_url')}, '.' || x))) GROUP BY t.id""")
def target_coverage(spark, d):
    """Theta join on domain suffixes, planned as a hash join on the exploded suffixes of each host."""
    targets = table(spark, d, "employer_targets").select(F.col("id").alias("target_id"), "official_domains")
    domains = targets.select("target_id", F.explode("official_domains").alias("domain")).distinct()
    hosts = table(spark, d, "sources").select("id", "lifecycle", F.explode(X.suffixes(U.host(F.col("source_root_url")))).alias("domain"))
    matched = domains.join(hosts, "domain").groupBy("target_id").agg(F.countDistinct("id").alias("matched"), F.max(F.when(F.col("lifecycle") == "approved", 3).when(F.col("lifecycle") == "probed", 2).otherwise(1)).alias("rank"))
    return targets.select("target_id").join(matched, "target_id", "left").select("target_id", F.coalesce("matched", F.lit(0)).alias("matched"), F.when(F.col("rank") == 3, "approved").when(F.col("rank") == 2, "verified").when(F.col("rank") == 1, "discovered").otherwise("missing").alias("coverage"))


@query("SELECT t.id, t.name FROM employer_targets t WHERE NOT EXISTS (SELECT 1 FROM jobs j WHERE j.company = t.name)")
def targets_without_jobs(spark, d):
    return table(spark, d, "employer_targets").select("id", "name").join(table(spark, d, "jobs").select(F.col("company").alias("name")).distinct(), "name", "left_anti").select("id", "name")


@query(f"SELECT coalesce(a.id, b.job_id) AS id, a.status AS snapshot, b.stored_status AS folded FROM {_LATEST} a FULL JOIN ({_STATUS_SQL}) b ON a.id = b.job_id WHERE a.status IS DISTINCT FROM b.stored_status")
def status_differences(spark, d):
    a = _latest(spark, d, "status").select("id", F.col("status").alias("snapshot"))
    b = R.supported_status(table(spark, d, "job_source_obs")).select(F.col("job_id").alias("id"), F.col("stored_status").alias("folded"))
    return a.join(b, "id", "full").filter(~F.col("snapshot").eqNullSafe(F.col("folded")))


@query("""WITH x AS (SELECT user_id, event_id, ts, event_type, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events)
  SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id, island ORDER BY ts, event_id) - CASE WHEN island > 0 THEN 1 ELSE 0 END AS BIGINT) AS failures FROM x QUALIFY event_type = 'error'""")
def failure_streaks(spark, d):
    """Consecutive failures up to each failure, since the last success."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    x = table(spark, d, "events").withColumn("island", F.sum(F.when(F.col("event_type") != "error", 1).otherwise(0)).over(w))
    n = F.row_number().over(W.partitionBy("user_id", "island").orderBy("ts", "event_id")) - F.when(F.col("island") > 0, 1).otherwise(0)
    return x.withColumn("failures", n.cast("long")).filter("event_type = 'error'").select("user_id", "event_id", "failures")


@query("SELECT user_id, event_type, epoch_us(ts) AS last_us FROM (SELECT user_id, event_type, max(ts) AS ts FROM events GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type) <= 3")
def recent_event_types(spark, d):
    events = table(spark, d, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    return R.recent_unique(events, "user_id", "event_type", 3, "ts").select("user_id", "event_type", F.unix_micros("ts").alias("last_us"))


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS used, greatest(count(*) - 300, 0) AS over_budget FROM events GROUP BY 1")
def daily_budget(spark, d):
    n = F.count("*")
    return table(spark, d, "events").groupBy(F.to_date("ts").cast("string").alias("day")).agg(n.alias("used"), F.greatest(n - 300, F.lit(0)).cast("long").alias("over_budget"))


@query(f"SELECT id, rec_id, floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us(observed_at)) / 86400000000.0)::BIGINT AS days, CASE WHEN floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us(observed_at)) / 86400000000.0) <= 7 THEN 98 WHEN floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us(observed_at)) / 86400000000.0) <= 30 THEN 95 WHEN floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us(observed_at)) / 86400000000.0) <= 180 THEN 86 ELSE 68 END AS freshness FROM {_LATEST}")
def freshness_scores(spark, d):
    days = X.age_days(F.timestamp_seconds(F.lit(1787184000)), F.col("observed_at"))
    return _latest(spark, d).select("id", "rec_id", days.alias("days"), X.freshness(days).alias("freshness"))


@query(f"SELECT id, source_id FROM {_LATEST} WHERE epoch_us(observed_at) BETWEEN epoch_us(TIMESTAMP '{NOW}') - 14 * 86400000000 AND epoch_us(TIMESTAMP '{NOW}') + 300000000")
def fresh_support(spark, d):
    """Postings observed within the time to live of fourteen days, five minutes of clock skew allowed."""
    return _latest(spark, d, "source_id").filter(F.unix_micros("observed_at").between(1787184000000000 - 14 * 86_400_000_000, 1787184000000000 + 300_000_000)).select("id", "source_id")


@query(f"SELECT id, active_score, authenticity_score FROM {_LATEST} WHERE status <> 'quarantined' ORDER BY CASE status WHEN 'confirmed_active' THEN 0 WHEN 'needs_review' THEN 1 ELSE 2 END, active_score DESC, authenticity_score DESC, observed_at DESC, id LIMIT 300")
def projection_top(spark, d):
    """The 300 postings a bounded export begins with."""
    rank = F.when(F.col("status") == "confirmed_active", 0).when(F.col("status") == "needs_review", 1).otherwise(2)
    return _latest(spark, d, "status", "active_score", "authenticity_score").filter("status <> 'quarantined'").orderBy(rank, F.desc("active_score"), F.desc("authenticity_score"), F.desc("observed_at"), "id").limit(300).select("id", "active_score", "authenticity_score")


@query("SELECT id FROM jobs EXCEPT SELECT job_id FROM job_source_obs")
def jobs_without_observation(spark, d):
    return table(spark, d, "jobs").select("id").join(table(spark, d, "job_source_obs").select(F.col("job_id").alias("id")), "id", "left_anti").distinct()


@query("SELECT e.kind AS kind, count(*) AS items, count(DISTINCT rec_id) AS records FROM (SELECT rec_id, unnest(evidence) AS e FROM jobs) GROUP BY 1")
def evidence_histogram(spark, d):
    return table(spark, d, "jobs").select("rec_id", F.explode("evidence").alias("e")).groupBy("e.kind").agg(F.count("*").alias("items"), F.countDistinct("rec_id").alias("records"))


@query("SELECT source_id, count(*) AS rows_late, max((epoch_us(ingested_at) - epoch_us(observed_at)) // 86400000000) AS worst_days FROM jobs WHERE epoch_us(ingested_at) - epoch_us(observed_at) >= 86400000000 GROUP BY 1")
def late_arrivals(spark, d):
    lag = F.unix_micros("ingested_at") - F.unix_micros("observed_at")
    return table(spark, d, "jobs").select("source_id", lag.alias("lag")).filter("lag >= 86400000000").groupBy("source_id").agg(F.count("*").alias("rows_late"), F.floor(F.max("lag") / 86_400_000_000).alias("worst_days"))


@query("SELECT h.hit_id, epoch_us(j.observed_at) AS last_seen_us FROM (SELECT * FROM discovery_hits WHERE source_id IS NOT NULL) h ASOF LEFT JOIN (SELECT DISTINCT source_id, observed_at FROM jobs) j ON h.source_id = j.source_id AND h.discovered_at >= j.observed_at")
def asof_observation(spark, d):
    """When the source of a hit was last observed before the hit."""
    hits = table(spark, d, "discovery_hits").filter("source_id IS NOT NULL").select("hit_id", "source_id", "discovered_at")
    got = R.asof_latest(hits, table(spark, d, "jobs"), "source_id", "discovered_at", "observed_at", "last_seen")
    return got.select("hit_id", F.unix_micros("last_seen").alias("last_seen_us"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
