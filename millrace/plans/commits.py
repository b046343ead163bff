"""Keyed folds: commits of a pass, missing postings, revoked support, graph edges, replicas, cursors, budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.functions import expressions as X
from millrace.functions import urls as U
from millrace.operators import relational as R
from millrace.plans.catalog_base import Catalog
from millrace.plans.geography import _PLACES, record_places
from millrace.plans.identity import NORMAL, canonical_sql
from millrace.session import materialize, table

CATALOG = Catalog()
query = CATALOG.query

#: What was observed before this instant is the stored state of the queries, the rest is the pass.
SPLIT, SPLIT_US = "2026-06-01 00:00:00", 1780272000000000
_SQL_SPLIT = f"epoch_us(TIMESTAMP '{SPLIT}')"


def _side_sql(op: str) -> str:
    return f"""(SELECT id, max_by(source_id, rec_id) AS source_id, max_by(coalesce(external_id, ''), rec_id) AS ext, max_by({canonical_sql('apply_url')}, rec_id) AS u, max_by({NORMAL.format('company')} || '|' || {NORMAL.format('title')}, rec_id) AS ident, max_by(content_hash, rec_id) AS h,
      max_by(status, rec_id) AS status, count(DISTINCT content_hash) AS version FROM jobs WHERE epoch_us(observed_at) {op} {_SQL_SPLIT} GROUP BY id)"""


def _side(spark, d, stored: bool) -> DataFrame:
    us = F.unix_micros("observed_at")
    rows = table(spark, d, "jobs").filter(us < SPLIT_US if stored else us >= SPLIT_US)
    kept = R.newest(rows.select("id", "rec_id", "source_id", F.coalesce("external_id", F.lit("")).alias("ext"), "apply_url", "company", "title", F.col("content_hash").alias("h"), "status"), ["id"], "rec_id")
    ident = F.concat_ws("|", X.normal_text(F.col("company")), X.normal_text(F.col("title")))
    versions = rows.groupBy("id").agg(F.countDistinct("content_hash").alias("version"))
    return kept.select("id", "source_id", "ext", U.canonical_url(F.col("apply_url")).alias("u"), ident.alias("ident"), "h", "status").join(versions, "id")


def commit_pass(stored: DataFrame, listed: DataFrame, approved: DataFrame, seen: DataFrame) -> DataFrame:
    """What a pass does to every posting: ``id, action, stored_id, version, missing, status``.

    ``stored`` and ``listed`` have ``id, source_id, ext, u, ident, h, status,
    version``; ``approved`` the sources that may commit (``source_id``), ``seen``
    ``id, missing, threshold`` of the stored ones.

    A row of a source that isn't approved is refused; so is the whole batch of a
    source whose external id stands for several URLs and identities.  The others
    match a stored posting by id, by source and external id, or by URL and
    identity, in this order, the smallest id first.  Matched rows update it (one
    version more if the content changed), others are inserted.  Stored postings
    of the sources that committed and that no row matched are missing once more
    and close at their threshold, two at least.
    """
    # Both sides are read several times.
    stored, listed = materialize(stored), materialize(listed)
    groups = stored.select("source_id", "ext", "u", "ident", "id").unionByName(listed.select("source_id", "ext", "u", "ident", "id"))
    conflicts = materialize(R.conflicting_keys(groups, ["source_id", "ext"], "u", "ident").select("source_id").distinct().withColumn("bad", F.lit(True)))
    new = listed.join(F.broadcast(approved.withColumn("ok", F.lit(True))), "source_id", "left").join(F.broadcast(conflicts), "source_id", "left")
    key = lambda df, p: df.select(*[F.col(c).alias(f"{p}{c}") for c in ("id", "source_id", "ext", "u", "ident")])
    i, e = key(new.filter("ok AND bad IS NULL"), "i_"), key(stored, "e_")
    # The smallest stored id of a key is the only one that can be chosen.
    first = lambda *by: e.groupBy(*by).agg(F.min("e_id").alias("e_id"))
    pairs = [
        i.join(e, F.col("i_id") == F.col("e_id")).select("i_id", F.lit(0).alias("rank"), "e_id"),
        i.filter("i_ext <> ''").join(first("e_source_id", "e_ext"), (F.col("i_source_id") == F.col("e_source_id")) & (F.col("i_ext") == F.col("e_ext"))).select("i_id", F.lit(1).alias("rank"), "e_id"),
        i.join(first("e_u", "e_ident"), (F.col("i_u") == F.col("e_u")) & (F.col("i_ident") == F.col("e_ident"))).select("i_id", F.lit(2).alias("rank"), "e_id"),
    ]
    match = materialize(pairs[0].unionByName(pairs[1]).unionByName(pairs[2]).groupBy("i_id").agg(F.min_by("e_id", F.struct("rank", "e_id")).alias("stored_id")))
    old = stored.select(F.col("id").alias("stored_id"), F.col("h").alias("old_h"), F.col("version").alias("old_version"))
    rows = new.join(match.withColumnRenamed("i_id", "id"), "id", "left").join(old, "stored_id", "left")
    refused = F.col("ok").isNull() | F.col("bad").isNotNull()
    action = F.when(F.col("ok").isNull(), "not_approved").when(F.col("bad").isNotNull(), "identity_conflict").when(F.col("stored_id").isNull(), "insert").when(F.col("h").eqNullSafe(F.col("old_h")), "unchanged").otherwise("update")
    version = F.when(F.col("stored_id").isNull(), 1).otherwise(F.col("old_version") + F.when(F.col("h").eqNullSafe(F.col("old_h")), 0).otherwise(1))
    done = rows.select("id", action.alias("action"), "stored_id", F.when(~refused, version).cast("long").alias("version"), F.when(~refused, F.lit(0)).cast("long").alias("missing"), F.when(~refused, F.col("status")).alias("status"))
    committed = new.filter("ok AND bad IS NULL").select("source_id").distinct()
    left = stored.join(F.broadcast(committed), "source_id", "left_semi").join(match.select(F.col("stored_id").alias("id")).distinct(), "id", "left_anti").filter("status <> 'closed'").join(seen, "id", "left")
    missed = F.coalesce("missing", F.lit(0)) + 1
    gone = missed >= F.greatest(F.lit(2), F.coalesce("threshold", F.lit(2)))
    absent = left.select("id", F.when(gone, "close").otherwise("missing").alias("action"), F.col("id").alias("stored_id"), F.col("version").cast("long").alias("version"), missed.cast("long").alias("missing"), F.when(gone, "closed").otherwise("needs_review").alias("status"))
    return done.unionByName(absent)


@query(f"""WITH e AS {_side_sql('<')}, i AS {_side_sql('>=')}, ok AS (SELECT id FROM sources WHERE lifecycle = 'approved' AND review_status = 'approved' AND collection_enabled),
  bad AS (SELECT DISTINCT source_id FROM (SELECT source_id, ext, u, ident FROM e UNION ALL SELECT source_id, ext, u, ident FROM i) WHERE ext <> '' AND source_id <> '' GROUP BY source_id, ext HAVING count(DISTINCT u) > 1 AND count(DISTINCT ident) > 1),
  a AS (SELECT * FROM i WHERE source_id IN (SELECT id FROM ok) AND source_id NOT IN (SELECT source_id FROM bad)),
  m AS (SELECT iid, arg_min(eid, (rk, eid)) AS eid FROM (SELECT a.id AS iid, 0 AS rk, e.id AS eid FROM a JOIN e ON e.id = a.id UNION ALL SELECT a.id, 1, e.id FROM a JOIN e ON e.source_id = a.source_id AND e.ext = a.ext AND a.ext <> '' UNION ALL SELECT a.id, 2, e.id FROM a JOIN e ON e.u = a.u AND e.ident = a.ident) GROUP BY iid),
  s AS (SELECT job_id, max(consecutive_missing) AS missing, max(closure_threshold) AS threshold FROM job_source_obs GROUP BY 1)
  SELECT i.id, CASE WHEN i.source_id NOT IN (SELECT id FROM ok) THEN 'not_approved' WHEN a.id IS NULL THEN 'identity_conflict' WHEN m.eid IS NULL THEN 'insert' WHEN e.h IS NOT DISTINCT FROM i.h THEN 'unchanged' ELSE 'update' END AS action, m.eid AS stored_id,
    CASE WHEN a.id IS NULL THEN NULL WHEN m.eid IS NULL THEN 1 WHEN e.h IS NOT DISTINCT FROM i.h THEN e.version ELSE e.version + 1 END AS version, CASE WHEN a.id IS NOT NULL THEN 0 END AS missing, CASE WHEN a.id IS NOT NULL THEN i.status END AS status
  FROM i LEFT JOIN a ON a.id = i.id LEFT JOIN m ON m.iid = i.id LEFT JOIN e ON e.id = m.eid
  UNION ALL SELECT e.id, CASE WHEN coalesce(s.missing, 0) + 1 >= greatest(2, coalesce(s.threshold, 2)) THEN 'close' ELSE 'missing' END, e.id, e.version, coalesce(s.missing, 0) + 1, CASE WHEN coalesce(s.missing, 0) + 1 >= greatest(2, coalesce(s.threshold, 2)) THEN 'closed' ELSE 'needs_review' END
  FROM e LEFT JOIN s ON s.job_id = e.id WHERE e.status <> 'closed' AND e.source_id IN (SELECT source_id FROM a) AND e.id NOT IN (SELECT eid FROM m)""")
def commit_actions(spark, d):
    """The commit of the later observations onto the state that the earlier ones left."""
    approved = table(spark, d, "sources").filter("lifecycle = 'approved' AND review_status = 'approved' AND collection_enabled").select(F.col("id").alias("source_id"))
    seen = table(spark, d, "job_source_obs").groupBy(F.col("job_id").alias("id")).agg(F.max("consecutive_missing").alias("missing"), F.max("closure_threshold").alias("threshold"))
    return commit_pass(_side(spark, d, True), _side(spark, d, False), approved, seen)


_OBS = "(SELECT DISTINCT job_id, source_id, consecutive_missing, observed_status, coalesce(active_score, 0) AS score, closure_threshold, missing_mode FROM job_source_obs)"


@query(f"""WITH o AS (SELECT o.*, EXISTS (SELECT 1 FROM jobs j WHERE j.id = o.job_id AND j.source_id = o.source_id AND epoch_us(j.observed_at) >= {_SQL_SPLIT}) AS seen, (SELECT count(*) FROM sources s WHERE s.id = o.source_id AND s.public_api_url IS NOT NULL) > 0 AS whole FROM {_OBS} o),
  n AS (SELECT *, CASE WHEN seen THEN 0 WHEN observed_status = 'closed' THEN consecutive_missing WHEN whole THEN CASE WHEN missing_mode = 'review_only' THEN 0 ELSE consecutive_missing END + 1 WHEN consecutive_missing = 0 THEN 1 ELSE consecutive_missing END AS m FROM o)
  SELECT job_id, source_id, m AS missing_after, CASE WHEN seen OR observed_status = 'closed' THEN missing_mode WHEN whole THEN 'authoritative' WHEN consecutive_missing = 0 THEN 'review_only' ELSE missing_mode END AS mode_after,
    CASE WHEN seen OR observed_status = 'closed' THEN observed_status WHEN whole AND m >= greatest(2, coalesce(closure_threshold, 2)) THEN 'closed' ELSE 'needs_review' END AS status_after,
    CASE WHEN NOT seen AND observed_status <> 'closed' AND whole AND m >= greatest(2, coalesce(closure_threshold, 2)) THEN 0 WHEN NOT seen AND observed_status <> 'closed' AND NOT whole THEN least(score, 50) ELSE score END AS score_after FROM n""")
def missing_pass(spark, d):
    """One pass over all supports: complete feeds count what they don't list and close it at its threshold, others only mark it."""
    seen = table(spark, d, "jobs").filter(F.unix_micros("observed_at") >= SPLIT_US).select(F.col("id").alias("job_id"), "source_id").distinct().withColumn("seen", F.lit(True))
    whole = table(spark, d, "sources").filter("public_api_url IS NOT NULL").select(F.col("id").alias("source_id"), F.lit(True).alias("whole"))
    obs = table(spark, d, "job_source_obs").drop("last_observed_at").distinct().join(seen, ["job_id", "source_id"], "left").join(F.broadcast(whole), "source_id", "left")
    flag = lambda c: F.coalesce(c, F.lit(False))
    return R.missing_advance(obs.withColumn("seen", flag("seen")).withColumn("whole", flag("whole")), F.col("seen"), F.col("whole"))


_REVOKED = "(SELECT source_id FROM job_source_obs GROUP BY 1 ORDER BY count(*) DESC, source_id LIMIT 1)"


@query(f"""WITH j AS (SELECT id, source_id FROM jobs QUALIFY row_number() OVER (PARTITION BY id ORDER BY observed_at DESC, rec_id DESC) = 1), left_ AS (SELECT * FROM {_OBS} WHERE source_id NOT IN {_REVOKED}),
  f AS (SELECT job_id, min(source_id) AS primary_source, bool_and(observed_status = 'closed' OR consecutive_missing >= coalesce(closure_threshold, 2)) AS ac, bool_or(observed_status IN ('closed', 'needs_review')) OR bool_and(consecutive_missing >= 1) AS doubt, max(score) AS top FROM left_ GROUP BY 1)
  SELECT j.id, f.primary_source AS source_id, CASE WHEN f.job_id IS NULL THEN 'quarantined' WHEN ac THEN 'closed' WHEN doubt THEN 'needs_review' ELSE 'confirmed_active' END AS status, CASE WHEN f.job_id IS NULL OR ac THEN 0 ELSE top END AS score
  FROM j LEFT JOIN f ON f.job_id = j.id WHERE j.source_id IN {_REVOKED}""")
def revoke_support(spark, d):
    """Postings of the busiest source after its support is withdrawn: the next source takes over, or they are quarantined."""
    obs = table(spark, d, "job_source_obs")
    revoked = F.broadcast(obs.groupBy("source_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source_id").limit(1).select("source_id"))
    rest = obs.drop("last_observed_at").distinct().join(revoked, "source_id", "left_anti")
    folded = R.supported_status(rest).join(rest.groupBy("job_id").agg(F.min("source_id").alias("primary")), "job_id")
    jobs = R.newest(table(spark, d, "jobs").select("id", "source_id", "observed_at", "rec_id"), ["id"], "observed_at", "rec_id").join(revoked, "source_id", "left_semi").select(F.col("id").alias("job_id"))
    got = jobs.join(folded, "job_id", "left")
    return got.select(F.col("job_id").alias("id"), F.col("primary").alias("source_id"), F.coalesce("stored_status", F.lit("quarantined")).alias("status"), F.coalesce("score", F.lit(0)).alias("score"))


_EDGES = f"""(SELECT source_id AS from_id, 'lists_job' AS type, id AS to_id, observed_at AS seen_at, len(list_filter(evidence, lambda e: e.kind = 'source_observation')) > 0 AS verified FROM jobs
  UNION ALL SELECT j.source_id, 'covers_region', p.region_code, j.observed_at, false FROM {_PLACES} p JOIN jobs j ON j.rec_id = p.rec_id
  UNION ALL SELECT source_id, 'discovered_by', provider, discovered_at, provider_evidence IS NOT NULL FROM discovery_hits WHERE source_id IS NOT NULL)"""


def edges(spark, d) -> DataFrame:
    jobs, hits = table(spark, d, "jobs"), table(spark, d, "discovery_hits")
    lists = jobs.select(F.col("source_id").alias("from_id"), F.lit("lists_job").alias("type"), F.col("id").alias("to_id"), F.col("observed_at").alias("at"), F.coalesce(F.exists("evidence", lambda e: e["kind"] == "source_observation"), F.lit(False)).alias("verified"))
    covers = record_places(spark, d).select("rec_id", "region_code").join(jobs.select("rec_id", "source_id", "observed_at"), "rec_id").select(F.col("source_id").alias("from_id"), F.lit("covers_region").alias("type"), F.col("region_code").alias("to_id"), F.col("observed_at").alias("at"), F.lit(False).alias("verified"))
    found = hits.filter("source_id IS NOT NULL").select(F.col("source_id").alias("from_id"), F.lit("discovered_by").alias("type"), F.col("provider").alias("to_id"), F.col("discovered_at").alias("at"), F.col("provider_evidence").isNotNull().alias("verified"))
    return lists.unionByName(covers).unionByName(found).groupBy("from_id", "type", "to_id").agg(F.count("*").alias("observations"), F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.bool_or("verified").alias("verified"))


@query(f"SELECT from_id, type, to_id, count(*) AS observations, epoch_us(min(seen_at)) AS first_us, epoch_us(max(seen_at)) AS last_us, bool_or(verified) AS verified FROM {_EDGES} GROUP BY ALL")
def graph_edges(spark, d):
    """Edges from sources to postings, places and discovery channels: how often, first and last; evidence once verified stays."""
    return edges(spark, d).select("from_id", "type", "to_id", "observations", F.unix_micros("first_at").alias("first_us"), F.unix_micros("last_at").alias("last_us"), "verified")


@query(f"""WITH e AS (SELECT from_id, type, to_id, bool_or(verified) AS verified FROM {_EDGES} GROUP BY ALL) SELECT type, count(*) AS edges, count(DISTINCT from_id) AS sources, count(DISTINCT to_id) AS targets, round(avg(CASE WHEN verified THEN 1.0 ELSE 0.0 END), 6) AS verified_share FROM e GROUP BY type
  UNION ALL SELECT 'all', (SELECT count(*) FROM e), (SELECT count(DISTINCT from_id) FROM e), (SELECT count(*) FROM (SELECT DISTINCT type, to_id FROM e)), (SELECT round(avg(CASE WHEN verified THEN 1.0 ELSE 0.0 END), 6) FROM e)""")
def graph_summary(spark, d):
    """Edges, nodes and the share of verified ones, by type and in all."""
    e = edges(spark, d).select("from_id", "type", F.struct("type", "to_id").alias("to"), F.col("verified").cast("double").alias("v"))
    # One pass for both grains.
    return e.rollup("type").agg(F.count("*").alias("edges"), F.countDistinct("from_id").alias("sources"), F.countDistinct("to").alias("targets"), F.round(F.avg("v"), 6).alias("verified_share")).withColumn("type", F.coalesce("type", F.lit("all")))


@query(f"SELECT from_id, to_id, epoch_us(max(seen_at)) AS last_us FROM {_EDGES} WHERE type = 'lists_job' GROUP BY ALL ORDER BY max(seen_at) DESC, from_id, to_id LIMIT 500 OFFSET 100")
def source_graph_page(spark, d):
    """A page of the edges of one type, the newest first."""
    rows = table(spark, d, "jobs").groupBy(F.col("source_id").alias("from_id"), F.col("id").alias("to_id")).agg(F.max("observed_at").alias("at"))
    return R.page(rows, 500, 100, F.desc("at"), F.asc("from_id"), F.asc("to_id")).select("from_id", "to_id", F.unix_micros("at").alias("last_us"))


_STRENGTH = "CASE lifecycle WHEN 'rejected' THEN 1 WHEN 'candidate' THEN 2 WHEN 'probed' THEN 3 ELSE 5 END"


@query(f"""WITH k AS (SELECT source_key, lifecycle, {_STRENGTH} AS strength FROM sources), h AS (SELECT 'site:' || regexp_extract({canonical_sql('url')}, '^https?://([^/?#]+)', 1) AS source_key, count(*) AS hits, list_sort(list(DISTINCT query_id)) AS q, min(coalesce(rank_no, 999)) AS best FROM discovery_hits GROUP BY 1)
  SELECT coalesce(k.source_key, h.source_key) AS source_key, CASE WHEN k.source_key IS NULL THEN 'insert' WHEN h.source_key IS NULL THEN 'kept' WHEN k.strength = 5 THEN 'evidence_only' ELSE 'merge' END AS action,
    CASE WHEN k.source_key IS NULL THEN 'candidate' ELSE k.lifecycle END AS lifecycle, greatest(coalesce(k.strength, 2), CASE WHEN h.best <= 3 THEN 4 ELSE 2 END * (h.source_key IS NOT NULL)::INT) AS strength, coalesce(h.hits, 0) AS hits, coalesce(array_to_string(h.q[1:200], ','), '') AS queries
  FROM k FULL JOIN h ON h.source_key = k.source_key""")
def upsert_candidates(spark, d):
    """Discovered hosts folded into the stored sources: new ones are inserted, approved ones only gather evidence, the strength of others never falls."""
    strength = F.when(F.col("lifecycle") == "rejected", 1).when(F.col("lifecycle") == "candidate", 2).when(F.col("lifecycle") == "probed", 3).otherwise(5)
    known = table(spark, d, "sources").select("source_key", "lifecycle", strength.alias("old"))
    hits = table(spark, d, "discovery_hits").select(F.concat(F.lit("site:"), U.host(U.canonical_url(F.col("url")))).alias("source_key"), "query_id", F.coalesce("rank_no", F.lit(999)).alias("rank"))
    found = hits.groupBy("source_key").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("query_id")).alias("q"), F.min("rank").alias("best"))
    both = known.join(found, "source_key", "full")
    action = F.when(F.col("old").isNull(), "insert").when(F.col("n").isNull(), "kept").when(F.col("old") == 5, "evidence_only").otherwise("merge")
    seen = F.when(F.col("n").isNull(), 0).when(F.col("best") <= 3, 4).otherwise(2)
    return both.select("source_key", action.alias("action"), F.coalesce("lifecycle", F.lit("candidate")).alias("lifecycle"), F.greatest(F.coalesce("old", F.lit(2)), seen).alias("strength"), F.coalesce("n", F.lit(0)).alias("hits"), F.coalesce(F.array_join(F.slice("q", 1, 200), ","), F.lit("")).alias("queries"))


@query(f"""WITH a AS (SELECT id, max_by(status, (observed_at, rec_id)) AS status, max(observed_at) AS at FROM jobs WHERE epoch_us(observed_at) < {_SQL_SPLIT} GROUP BY id), b AS (SELECT id, max_by(status, (observed_at, rec_id)) AS status, max(observed_at) AS at FROM jobs WHERE source_id <> {_REVOKED} GROUP BY id)
  SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'take_remote' WHEN b.id IS NULL THEN 'send_local' WHEN a.status IS NOT DISTINCT FROM b.status THEN 'equal' WHEN b.at > a.at THEN 'take_remote' WHEN a.at > b.at THEN 'send_local' ELSE 'conflict' END AS decision FROM a FULL JOIN b ON a.id = b.id""")
def replica_sync(spark, d):
    """Two replicas of a state compared row by row: the later observation wins, equal instants with different values conflict."""
    jobs, obs = table(spark, d, "jobs"), table(spark, d, "job_source_obs")
    busiest = obs.groupBy("source_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source_id").limit(1).select("source_id")
    state = lambda df, p: df.groupBy("id").agg(F.max_by("status", F.struct("observed_at", "rec_id")).alias(f"{p}_status"), F.max("observed_at").alias(f"{p}_at"))
    a, b = state(jobs.filter(F.unix_micros("observed_at") < SPLIT_US), "a"), state(jobs.join(F.broadcast(busiest), "source_id", "left_anti"), "b")
    decision = F.when(F.col("a_at").isNull(), "take_remote").when(F.col("b_at").isNull(), "send_local").when(F.col("a_status").eqNullSafe(F.col("b_status")), "equal").when(F.col("b_at") > F.col("a_at"), "take_remote").when(F.col("a_at") > F.col("b_at"), "send_local").otherwise("conflict")
    return a.join(b, "id", "full").select("id", decision.alias("decision"))


@query("""WITH c AS (SELECT source_id, count(DISTINCT id) AS total FROM jobs GROUP BY 1), p AS (SELECT source_id, total, unnest(generate_series(0, CAST(ceil(total / 50.0) AS BIGINT) - 1)) AS page FROM c)
  SELECT source_id, page, greatest(page * 50 - 10, 0) AS start_offset, least((page + 1) * 50, total) AS end_offset, CASE WHEN (page + 1) * 50 >= total THEN 0 ELSE greatest(page * 50, (page + 1) * 50 - 10) END AS next_offset, (page + 1) * 50 >= total AS cycle_end FROM p""")
def collection_segments(spark, d):
    """The pages a resumed collection reads of each source, with an overlap of ten rows; after the last one it begins anew."""
    size, overlap = 50, 10
    total = table(spark, d, "jobs").groupBy("source_id").agg(F.countDistinct("id").alias("total"))
    p = total.select("source_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("total") / size) - 1)).alias("page"))
    end = (F.col("page") + 1) * size
    last = end >= F.col("total")
    return p.select("source_id", "page", F.greatest(F.col("page") * size - overlap, F.lit(0)).alias("start_offset"), F.least(end, F.col("total")).alias("end_offset"), F.when(last, 0).otherwise(F.greatest(F.col("page") * size, end - overlap)).cast("long").alias("next_offset"), last.alias("cycle_end"))


@query("""SELECT day, event_type, event_id, n <= 100 AS granted, n AS position FROM (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, event_id, row_number() OVER (PARTITION BY CAST(ts AS DATE), event_type ORDER BY ts, event_id) AS n FROM events)""")
def reserve_requests(spark, d):
    """Each request of a day in order: granted up to the daily limit, refused beyond it; a day begins at zero."""
    w = W.partitionBy("day", "event_type").orderBy("ts", "event_id")
    rows = table(spark, d, "events").select(F.to_date("ts").cast("string").alias("day"), "event_type", "event_id", "ts").withColumn("position", F.row_number().over(w).cast("long"))
    return rows.select("day", "event_type", "event_id", (F.col("position") <= 100).alias("granted"), "position")


@query("""SELECT rec_id, sha256(concat_ws(chr(31), source_id, coalesce(external_id, chr(0)), company, title, coalesce(location, chr(0)), department, employment_type, workplace_type, coalesce(salary, chr(0)), coalesce(published_at, chr(0)), coalesce(valid_through, chr(0)), coalesce(description, chr(0)))) AS content FROM jobs""")
def content_hashes(spark, d):
    """A digest of the twelve fields whose change makes a new version; null differs from empty."""
    fields = ("source_id", "external_id", "company", "title", "location", "department", "employment_type", "workplace_type", "salary", "published_at", "valid_through", "description")
    joined = F.concat_ws("\x1f", *[F.coalesce(F.col(c), F.lit("\x00")) for c in fields])
    return table(spark, d, "jobs").select("rec_id", F.sha2(joined, 256).alias("content"))
