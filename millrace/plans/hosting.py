"""Read models: status resolved at read time, freshness, bounded projection with referential closure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.functions import urls as U
from millrace.operators import relational as R
from millrace.plans.catalog_base import Catalog
from millrace.plans.identity import canonical_sql
from millrace.session import table

CATALOG = Catalog()
query = CATALOG.query

#: The instant at which the queries look at the data.
NOW, NOW_US = "2026-08-20 00:00:00", 1787184000000000
SOURCES, JOBS, EDGES, BYTES = 60, 300, 200, 100_000
TTL_US, SKEW_US = 14 * 86_400_000_000, 300_000_000

_LATEST = "(SELECT * FROM jobs QUALIFY row_number() OVER (PARTITION BY id ORDER BY observed_at DESC, rec_id DESC) = 1)"
_ACTIVE = "(SELECT id FROM sources WHERE lifecycle = 'approved' AND review_status = 'approved' AND collection_enabled)"
_OBS = "(SELECT DISTINCT job_id, source_id, consecutive_missing, observed_status, active_score, closure_threshold, last_observed_at FROM job_source_obs)"


def latest(spark, d, *columns: str) -> DataFrame:
    return R.newest(table(spark, d, "jobs").select("id", "observed_at", "rec_id", *columns), ["id"], "observed_at", "rec_id")


def active_sources(spark, d) -> DataFrame:
    return table(spark, d, "sources").filter("lifecycle = 'approved' AND review_status = 'approved' AND collection_enabled")


def resolve_support(jobs: DataFrame, obs: DataFrame, active: DataFrame, now_us: int) -> DataFrame:
    """``id, source_id, eligible_source, resolved_status, score, missing, conflict`` of every posting.

    ``jobs`` has ``id, source_id, status, active_score, valid_us``; ``obs``
    ``job_id, source_id, consecutive_missing, observed_status, active_score,
    closure_threshold``; ``active`` the ids of sources that may support one
    (``source_id``).  The primary source comes first, the others by id.

    A support is closed if it was observed so, missed to its threshold (two at
    least) or expired, and one without its own entry among other entries is
    closed, too.  The first open support is chosen, else the first.  Without an
    active source a posting is quarantined; without any entry its own status
    stands unless it has expired; else it is closed if no support is open, in
    review if any is closed or doubtful, and active otherwise.
    """
    o = obs.select("job_id", "source_id", "consecutive_missing", "observed_status", F.col("active_score").alias("seen_score"), "closure_threshold").distinct()
    primary = jobs.select("id", "source_id", F.lit(0).alias("pos"))
    others = o.select(F.col("job_id").alias("id"), "source_id", F.lit(1).alias("pos"))
    supports = primary.unionByName(others).groupBy("id", "source_id").agg(F.min("pos").alias("pos")).join(F.broadcast(active), "source_id", "left_semi")
    seen = o.withColumn("has", F.lit(True)).withColumnRenamed("job_id", "id")
    observed = o.select(F.col("job_id").alias("id")).distinct().withColumn("any_obs", F.lit(True))
    facts = jobs.select("id", F.col("source_id").alias("primary"), "status", "active_score", "valid_us").join(observed, "id", "left")
    rows = supports.join(seen, ["id", "source_id"], "left").join(facts, "id")
    expired = F.coalesce(F.col("valid_us") < now_us, F.lit(False))
    lacking = F.col("any_obs").isNotNull() & F.col("has").isNull()
    missing = F.greatest(F.lit(0), F.coalesce("consecutive_missing", F.lit(0)))
    status = F.coalesce("observed_status", "status", F.lit("confirmed_active"))
    closed = lacking | (status == "closed") | (missing >= F.greatest(F.lit(2), F.coalesce("closure_threshold", F.lit(2)))) | expired
    doubtful = lacking | (status == "needs_review") | (missing >= 1)
    flags = rows.select("id", "source_id", "pos", closed.alias("closed"), doubtful.alias("doubtful"), missing.alias("m"), F.coalesce("seen_score", F.lit(0)).alias("s"))
    open_ = ~F.col("closed")
    order = F.struct(F.col("closed"), F.col("pos"), F.col("source_id"))
    folded = flags.groupBy("id").agg(
        F.min_by("source_id", order).alias("chosen"),
        F.min_by(F.when(open_, F.col("source_id")), order).alias("eligible_source"),
        F.bool_or("closed").alias("any_closed"),
        F.bool_or(open_).alias("any_open"),
        F.bool_or(open_ & F.col("doubtful")).alias("any_doubt"),
        F.max(F.when(open_, F.col("s"))).alias("top"),
        F.min(F.when(open_, F.col("m"))).alias("open_missing"),
        F.min("m").alias("all_missing"),
    )
    out = facts.join(folded, "id", "left")
    resolved = (
        F.when(F.col("chosen").isNull(), "quarantined")
        .when(F.col("any_obs").isNull(), F.when(expired, "closed").otherwise(F.coalesce("status", F.lit("needs_review"))))
        .when(~F.col("any_open"), "closed")
        .when(F.col("any_closed") | F.col("any_doubt"), "needs_review")
        .otherwise("confirmed_active")
    )
    score = F.when(F.col("resolved_status").isin("closed", "quarantined"), 0).otherwise(F.greatest(F.coalesce("active_score", F.lit(0)), F.coalesce("top", F.lit(0))))
    conflict = F.coalesce(F.col("any_obs") & F.col("any_open") & F.col("any_closed"), F.lit(False))
    return out.withColumn("resolved_status", resolved).select("id", F.col("chosen").alias("source_id"), "eligible_source", "resolved_status", score.alias("score"), F.coalesce("open_missing", "all_missing").cast("long").alias("missing"), conflict.alias("conflict"))


_VALID = "epoch_us(try_cast(valid_through AS TIMESTAMP))"
_RESOLVED = f"""(WITH j AS (SELECT id, source_id, status, active_score, {_VALID} < epoch_us(TIMESTAMP '{NOW}') AS gone FROM {_LATEST}), c AS (SELECT id, source_id, min(pos) AS pos FROM (SELECT id, source_id, 0 AS pos FROM j UNION ALL SELECT job_id, source_id, 1 FROM {_OBS}) WHERE source_id IN {_ACTIVE} GROUP BY ALL),
  x AS (SELECT c.id, c.source_id, c.pos, j.gone, j.status, j.active_score, EXISTS (SELECT 1 FROM {_OBS} a WHERE a.job_id = c.id) AS observed, o.* EXCLUDE (job_id, source_id, active_score), o.job_id IS NULL AS lacks, coalesce(o.active_score, 0) AS s, greatest(0, coalesce(o.consecutive_missing, 0)) AS m FROM c JOIN j ON j.id = c.id LEFT JOIN {_OBS} o ON o.job_id = c.id AND o.source_id = c.source_id),
  f AS (SELECT *, (observed AND lacks) OR coalesce(observed_status, status) = 'closed' OR m >= greatest(2, coalesce(closure_threshold, 2)) OR coalesce(gone, false) AS closed, (observed AND lacks) OR coalesce(observed_status, status) = 'needs_review' OR m >= 1 AS doubt FROM x),
  g AS (SELECT id, any_value(observed) AS observed, arg_min(source_id, (closed, pos, source_id)) AS chosen, arg_min(source_id, (pos, source_id)) FILTER (NOT closed) AS open_source, bool_or(closed) AS ac, bool_or(NOT closed) AS ao, bool_or(NOT closed AND doubt) AS ad, max(s) FILTER (NOT closed) AS top, coalesce(min(m) FILTER (NOT closed), min(m)) AS m FROM f GROUP BY id),
  r AS (SELECT j.*, g.* EXCLUDE (id), CASE WHEN chosen IS NULL THEN 'quarantined' WHEN NOT observed THEN CASE WHEN gone THEN 'closed' ELSE status END WHEN NOT ao THEN 'closed' WHEN ac OR ad THEN 'needs_review' ELSE 'confirmed_active' END AS rs FROM j LEFT JOIN g ON g.id = j.id)
  SELECT id, chosen AS source_id, open_source AS eligible_source, rs AS resolved_status, CASE WHEN rs IN ('closed', 'quarantined') THEN 0 ELSE greatest(coalesce(active_score, 0), coalesce(top, 0)) END AS score, CAST(m AS BIGINT) AS missing, coalesce(observed AND ao AND ac, false) AS conflict FROM r)"""


def valid_us(c):
    """The end of validity in microseconds; a mere date is its midnight, null if it is no date."""
    return F.unix_micros(F.try_to_timestamp(c))


def resolved(spark, d) -> DataFrame:
    jobs = latest(spark, d, "source_id", "status", "active_score", "valid_through").withColumn("valid_us", valid_us(F.col("valid_through")))
    return resolve_support(jobs, table(spark, d, "job_source_obs"), active_sources(spark, d).select(F.col("id").alias("source_id")), NOW_US)


@query(f"SELECT * FROM {_RESOLVED}")
def resolved_status(spark, d):
    """Support, status, score and missing count of every posting as of ``NOW``."""
    return resolved(spark, d)


@query(f"SELECT j.id, r.source_id, j.company, r.resolved_status AS status, r.score FROM {_LATEST} j JOIN {_RESOLVED} r ON r.id = j.id WHERE j.status <> 'quarantined' AND r.resolved_status = 'confirmed_active'")
def list_jobs(spark, d):
    """Active postings of approved and enabled sources, by the status resolved at read time."""
    shown = latest(spark, d, "company", "status").filter("status <> 'quarantined'").select("id", "company")
    return resolved(spark, d).filter("resolved_status = 'confirmed_active'").join(shown, "id").select("id", "source_id", "company", F.col("resolved_status").alias("status"), "score")


@query(f"SELECT r.id, r.resolved_status, s.stored_status FROM {_RESOLVED} r JOIN (SELECT job_id, CASE WHEN bool_and(observed_status = 'closed' OR consecutive_missing >= coalesce(closure_threshold, 2)) THEN 'closed' WHEN bool_or(observed_status IN ('closed', 'needs_review')) OR bool_and(consecutive_missing >= 1) THEN 'needs_review' ELSE 'confirmed_active' END AS stored_status FROM job_source_obs GROUP BY 1) s ON s.job_id = r.id WHERE s.stored_status <> r.resolved_status")
def status_disagreements(spark, d):
    """Where the status at read time and the stored one differ."""
    stored = R.supported_status(table(spark, d, "job_source_obs")).select(F.col("job_id").alias("id"), "stored_status")
    return resolved(spark, d).select("id", "resolved_status").join(stored, "id").filter("resolved_status <> stored_status")


@query(f"SELECT id, CASE WHEN status <> 'quarantined' AND {_VALID} < epoch_us(TIMESTAMP '{NOW}') THEN 'closed' ELSE status END AS status, coalesce({_VALID} < epoch_us(TIMESTAMP '{NOW}'), false) AS expired FROM {_LATEST}")
def effective_validity(spark, d):
    """Postings expire when they are read."""
    rows = latest(spark, d, "status", "valid_through").withColumn("expired", F.coalesce(valid_us(F.col("valid_through")) < NOW_US, F.lit(False)))
    return rows.select("id", F.when(F.col("expired") & (F.col("status") != "quarantined"), "closed").otherwise(F.col("status")).alias("status"), "expired")


@query(f"""SELECT j.id, CASE WHEN s.source_root_url IS NULL THEN {canonical_sql('j.source_url')} ELSE coalesce({canonical_sql('j.source_url')}, {canonical_sql('s.source_root_url')}) END AS source_url,
  coalesce({canonical_sql('j.apply_url')}, {canonical_sql('j.source_url')}, {canonical_sql('s.source_root_url')}) AS apply_url FROM {_LATEST} j LEFT JOIN sources s ON s.id = j.source_id""")
def hosted_urls(spark, d):
    """Which URLs a posting shows: its own, else those of its source's root."""
    roots = table(spark, d, "sources").select(F.col("id").alias("source_id"), U.canonical_url(F.col("source_root_url")).alias("root"))
    rows = latest(spark, d, "source_id", "source_url", "apply_url").select("id", "source_id", U.canonical_url(F.col("source_url")).alias("s"), U.canonical_url(F.col("apply_url")).alias("a")).join(F.broadcast(roots), "source_id", "left")
    return rows.select("id", F.coalesce("s", "root").alias("source_url"), F.coalesce("a", "s", "root").alias("apply_url"))


_TEXT = {"company": "发布单位待核验", "title": "未命名岗位", "location": "地点未提供", "department": "未分类", "employment_type": "未说明", "salary": "薪资未公开"}


@query("SELECT rec_id, " + ", ".join(f"coalesce(nullif({c}, ''), '{v}') AS {c}" for c, v in _TEXT.items()) + ", coalesce(active_score, 0) AS active_score FROM jobs")
def job_columns(spark, d):
    """Flat rows with a text in place of every null and empty one."""
    shown = [F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(v)).alias(c) for c, v in _TEXT.items()]
    return table(spark, d, "jobs").select("rec_id", *shown, F.coalesce("active_score", F.lit(0)).alias("active_score"))


@query("SELECT rec_id, left(description, 1200) AS description, length(description) > 1200 AS shortened, strlen(description) AS bytes FROM jobs WHERE description IS NOT NULL")
def compact_jobs(spark, d):
    """Descriptions cut to the length a projection carries, with the bytes of the whole."""
    c = F.col("description")
    return table(spark, d, "jobs").filter(c.isNotNull()).select("rec_id", F.substring(c, 1, 1200).alias("description"), (F.length(c) > 1200).alias("shortened"), F.octet_length(c).cast("long").alias("bytes"))


# When a source was last seen to list everything: its newest observation, as the tables hold no check times.
_WIDE = "(SELECT source_id, max(last_observed_at) AS at FROM job_source_obs WHERE missing_mode = 'authoritative' GROUP BY 1)"
_PER_JOB = "('ByteHire', 'FlyRecruit')"


def _recent_sql(c: str) -> str:
    return f"epoch_us({c}) BETWEEN epoch_us(TIMESTAMP '{NOW}') - {TTL_US} AND epoch_us(TIMESTAMP '{NOW}') + {SKEW_US}"


_FRESH = f"""(SELECT j.id, j.source_id, CASE WHEN {_recent_sql('o.at')} THEN 'job_source_observation' WHEN coalesce(s.provider, '') NOT IN {_PER_JOB} AND {_recent_sql('w.at')} THEN 'source_authoritative_full_collection' END AS basis FROM {_LATEST} j JOIN sources s ON s.id = j.source_id
  LEFT JOIN (SELECT job_id, source_id, max(last_observed_at) AS at FROM job_source_obs GROUP BY ALL) o ON o.job_id = j.id AND o.source_id = j.source_id LEFT JOIN {_WIDE} w ON w.source_id = j.source_id)"""


def fresh_basis(spark, d) -> DataFrame:
    """``id, source_id, basis``: why a support is fresh, null if it isn't."""
    recent = lambda c: F.coalesce(F.unix_micros(c).between(NOW_US - TTL_US, NOW_US + SKEW_US), F.lit(False))
    obs = table(spark, d, "job_source_obs")
    own = obs.groupBy(F.col("job_id").alias("id"), "source_id").agg(F.max("last_observed_at").alias("own"))
    wide = obs.filter("missing_mode = 'authoritative'").groupBy("source_id").agg(F.max("last_observed_at").alias("wide"))
    per_job = table(spark, d, "sources").select(F.col("id").alias("source_id"), F.coalesce("provider", F.lit("")).isin("ByteHire", "FlyRecruit").alias("per_job"))
    rows = latest(spark, d, "source_id").join(own, ["id", "source_id"], "left").join(F.broadcast(wide), "source_id", "left").join(F.broadcast(per_job), "source_id")
    return rows.select("id", "source_id", F.when(recent(F.col("own")), "job_source_observation").when(~F.col("per_job") & recent(F.col("wide")), "source_authoritative_full_collection").alias("basis"))


@query(f"SELECT * FROM {_FRESH} WHERE basis IS NOT NULL")
def support_freshness(spark, d):
    """Supports that are fresh, by an observation of the posting or of the whole source."""
    return fresh_basis(spark, d).filter("basis IS NOT NULL")


_TOP_SOURCES = f"""(SELECT id FROM sources ORDER BY CASE WHEN lifecycle = 'approved' AND review_status = 'approved' AND collection_enabled THEN 0 WHEN lifecycle = 'probed' AND review_status = 'pending' THEN 1 WHEN lifecycle = 'rejected' THEN 3 ELSE 2 END,
  coalesce(approved_at, discovered_at) DESC, id LIMIT {SOURCES})"""


@query(f"SELECT id FROM {_TOP_SOURCES}")
def projection_sources(spark, d):
    """The sixty sources a bounded export keeps."""
    approved = F.expr("lifecycle = 'approved' AND review_status = 'approved' AND collection_enabled")
    rank = F.when(approved, 0).when(F.expr("lifecycle = 'probed' AND review_status = 'pending'"), 1).when(F.col("lifecycle") == "rejected", 3).otherwise(2)
    return table(spark, d, "sources").orderBy(rank, F.desc(F.coalesce("approved_at", "discovered_at")), "id").limit(SOURCES).select("id")


_PROJECTED = f"""(SELECT j.id, r.source_id, r.resolved_status AS status, r.score, j.authenticity_score, epoch_us(j.observed_at) AS seen_us, strlen(j.title) + strlen(j.company) + coalesce(strlen(left(j.description, 1200)), 0) AS bytes,
  row_number() OVER (ORDER BY CASE r.resolved_status WHEN 'confirmed_active' THEN 0 WHEN 'needs_review' THEN 1 ELSE 2 END, r.score DESC, j.authenticity_score DESC, j.observed_at DESC, j.id) AS pos
  FROM {_LATEST} j JOIN {_RESOLVED} r ON r.id = j.id JOIN {_FRESH} f ON f.id = j.id AND f.basis IS NOT NULL AND f.source_id = r.source_id WHERE r.resolved_status NOT IN ('quarantined', 'closed') AND r.source_id IN (SELECT id FROM {_TOP_SOURCES}) QUALIFY pos <= {JOBS})"""


def _projected(spark, d) -> DataFrame:
    text = latest(spark, d, "title", "company", "description", "authenticity_score")
    size = F.octet_length("title") + F.octet_length("company") + F.coalesce(F.octet_length(F.substring("description", 1, 1200)), F.lit(0))
    facts = text.select("id", "authenticity_score", F.unix_micros("observed_at").alias("seen_us"), size.alias("bytes"))
    fresh = fresh_basis(spark, d).filter("basis IS NOT NULL").select("id", "source_id")
    kept = F.broadcast(projection_sources(spark, d).withColumnRenamed("id", "source_id"))
    live = resolved(spark, d).filter("resolved_status NOT IN ('quarantined', 'closed')").join(kept, "source_id", "left_semi").join(fresh, ["id", "source_id"], "left_semi").join(facts, "id")
    rank = F.when(F.col("resolved_status") == "confirmed_active", 0).when(F.col("resolved_status") == "needs_review", 1).otherwise(2)
    order = (rank, F.desc("score"), F.desc("authenticity_score"), F.desc("seen_us"), F.asc("id"))
    # Only the rows kept are numbered: three hundred of them.
    top = live.orderBy(*order).limit(JOBS)
    return top.withColumn("pos", F.row_number().over(W.orderBy(*order)).cast("long")).select("id", "source_id", F.col("resolved_status").alias("status"), "score", "authenticity_score", "seen_us", "bytes", "pos")


@query(f"SELECT id, source_id, status, score, pos FROM {_PROJECTED}")
def hosted_projection(spark, d):
    """The postings of a bounded export: of its sources, freshly supported, the three hundred best."""
    return _projected(spark, d).select("id", "source_id", "status", "score", "pos")


@query(f"SELECT id, pos, CAST(total AS BIGINT) AS total FROM (SELECT id, pos, sum(bytes) OVER (ORDER BY pos) AS total FROM {_PROJECTED}) WHERE total <= {BYTES}")
def byte_budget(spark, d):
    """The longest run of the best postings whose texts fit the byte budget."""
    return _projected(spark, d).select("id", "pos", F.sum("bytes").over(W.orderBy("pos")).cast("long").alias("total")).filter(F.col("total") <= BYTES)


@query(f"SELECT p.source_id AS from_id, p.id AS to_id, 'lists_job' AS type, count(*) AS observations FROM {_PROJECTED} p JOIN jobs j ON j.id = p.id AND j.source_id = p.source_id GROUP BY ALL ORDER BY max(j.observed_at) DESC, p.id LIMIT {EDGES}")
def projection_edges(spark, d):
    """Edges whose both ends the export keeps, the newest two hundred."""
    kept = F.broadcast(_projected(spark, d).select("id", "source_id"))
    edges = table(spark, d, "jobs").select("id", "source_id", "observed_at").join(kept, ["id", "source_id"], "left_semi").groupBy("source_id", "id").agg(F.count("*").alias("observations"), F.max("observed_at").alias("at"))
    return edges.orderBy(F.desc("at"), "id").limit(EDGES).select(F.col("source_id").alias("from_id"), F.col("id").alias("to_id"), F.lit("lists_job").alias("type"), "observations")


@query(f"""SELECT (SELECT count(*) FROM sources) AS sources_all, (SELECT count(*) FROM {_TOP_SOURCES}) AS sources_kept, (SELECT count(DISTINCT id) FROM jobs) AS jobs_all, (SELECT count(*) FROM {_PROJECTED}) AS jobs_kept, (SELECT count(*) FROM {_PROJECTED}) < (SELECT count(DISTINCT id) FROM jobs) AS truncated""")
def projection_manifest(spark, d):
    """How much of the tables an export keeps."""
    parts = [table(spark, d, "sources").agg(F.count("*").alias("sources_all")), projection_sources(spark, d).agg(F.count("*").alias("sources_kept")), table(spark, d, "jobs").agg(F.countDistinct("id").alias("jobs_all")), _projected(spark, d).agg(F.count("*").alias("jobs_kept"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p))  # one row each
    return out.withColumn("truncated", F.col("jobs_kept") < F.col("jobs_all"))
