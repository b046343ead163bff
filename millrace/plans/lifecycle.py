"""Sources from discovery to collection: scores, backlog, transitions, due times, runs, receipts, identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.functions import expressions as X
from millrace.functions import urls as U
from millrace.plans.catalog_base import Catalog
from millrace.plans.geography import _PLACES, record_places
from millrace.plans.identity import _HIT_KEY, NORMAL, canonical_sql
from millrace.session import table

CATALOG = Catalog()
query = CATALOG.query

NOW, NOW_US, DAY = "2026-08-20 00:00:00", 1787184000000000, 86_400_000_000
_NOW = f"epoch_us(TIMESTAMP '{NOW}')"

# --- discovery -------------------------------------------------------------------------------------------------

#: ``signal, weight``, in the order they are reported.
# What speaks for and against a candidate.
WEIGHTS = (("known_ats", 27), ("government_domain", 30), ("china_scope", 16), ("recruitment_language", 12), ("community_hub", 6), ("park_association", 6), ("multi_query", 8), ("recent_result", 8), ("deterministic_api", 8), ("single_post_only", -12), ("access_restriction", -45), ("missing_china_signal", -18))
_TERMS = "招聘|岗位|职位|人才|就业|career|careers|hiring|job|jobs|recruit"


def candidate_scores(hits: DataFrame, known: DataFrame) -> DataFrame:
    """``source_key, score, signals, status, recency`` of every candidate, from its hits.

    ``hits`` has ``query_id, title, snippet, url, published_us, observed_us,
    in_china``; ``known`` the approved ``source_key``.  Ten points and the
    weights of the signals seen in any hit, within 0 and 100; the recency of the
    newest hit counts 8 up to thirty days and 4 up to half a year.
    """
    c = hits.withColumn("c", U.canonical_url(F.col("url"))).filter("c IS NOT NULL")
    keyed = c.withColumn("s", U.source_identity(F.col("c"))).withColumn("source_key", F.col("s.source_key"))
    text = F.concat_ws(" ", "title", "snippet", "url")
    age = F.floor((F.col("observed_us") - F.col("published_us")) / DAY)
    recent = F.when(age.between(0, 30), 8).when(age.between(31, 180), 4).otherwise(0)
    facts = keyed.groupBy("source_key").agg(
        F.bool_or(F.col("s.provider").isNotNull()).alias("known_ats"),
        F.bool_or(U.host(F.col("c")).rlike(r"(?:^|\.)gov\.cn$")).alias("government_domain"),
        F.bool_or("in_china").alias("china_scope"),
        F.bool_or(text.rlike(f"(?i){_TERMS}")).alias("recruitment_language"),
        F.bool_or(text.rlike("社区|街道|就业服务站|零工驿站")).alias("hub"),
        F.bool_or(text.rlike("产业园|园区|商圈|协会|商会")).alias("park"),
        (F.countDistinct("query_id") > 1).alias("multi_query"),
        F.max(F.coalesce(recent, F.lit(0))).alias("recency"),
        F.bool_or(F.col("s.api_url").isNotNull()).alias("deterministic_api"),
        F.bool_and(U.is_detail_url(F.col("c"))).alias("detail"),
        F.bool_or(text.rlike(r"(?i)/login(?:/|$)|/signin(?:/|$)|验证码|仅限登录|付费墙")).alias("access_restriction"),
    )
    hiring = F.col("china_scope") & F.col("recruitment_language")
    flags = {"community_hub": hiring & F.col("hub"), "park_association": hiring & F.col("park"), "recent_result": F.col("recency") > 0, "single_post_only": F.col("detail") & ~F.col("known_ats"), "missing_china_signal": ~F.col("china_scope")}
    weighted = [F.when(flags[name] if name in flags else F.col(name), F.struct(F.lit(name).alias("code"), (F.col("recency") if name == "recent_result" else F.lit(w)).cast("int").alias("w"))) for name, w in WEIGHTS]
    signals = F.filter(F.array(*weighted), lambda s: s.isNotNull())
    scored = facts.withColumn("signals", signals).join(F.broadcast(known.select("source_key").distinct().withColumn("known", F.lit(True))), "source_key", "left")
    total = F.aggregate("signals", F.lit(10), lambda a, s: a + s["w"])
    stable = ~F.col("detail")
    status = F.when(F.col("known"), "already_registered").when(F.col("access_restriction"), "rejected_access_restricted").when(hiring & (F.col("known_ats") | (F.col("government_domain") & stable)), "ready_for_probe").when(hiring, "needs_review").otherwise("backlog")
    return scored.select("source_key", F.greatest(F.lit(0), F.least(F.lit(100), total)).alias("score"), F.array_join(F.transform("signals", lambda s: s["code"]), ",").alias("signals"), status.alias("status"), F.col("recency").cast("int").alias("recency"))


_IN_CHINA = "regexp_matches(coalesce(title, '') || coalesce(snippet, '') || coalesce(query_text, ''), '中国|全国|大陆|内地|省|自治区|China')"
_TEXT = "concat_ws(' ', title, snippet, url)"


@query(f"""WITH f AS (SELECT source_key, bool_or({_IN_CHINA}) AS china, bool_or(regexp_matches({_TEXT}, '{_TERMS}', 'i')) AS rec, bool_or(regexp_matches({_TEXT}, '社区|街道|就业服务站|零工驿站')) AS hub, bool_or(regexp_matches({_TEXT}, '产业园|园区|商圈|协会|商会')) AS park, count(DISTINCT query_id) > 1 AS multi,
    max(CASE WHEN a BETWEEN 0 AND 30 THEN 8 WHEN a BETWEEN 31 AND 180 THEN 4 ELSE 0 END) AS recency, bool_and(regexp_matches(c, '/(jobs?|positions?)/[^/?]+(/detail)?/?$', 'i')) AS detail, bool_or(regexp_matches({_TEXT}, '/login(/|$)|/signin(/|$)|验证码|仅限登录|付费墙', 'i')) AS blocked
    FROM (SELECT *, floor((epoch_us(discovered_at) - epoch_us(try_cast(regexp_extract(published_at, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') AS TIMESTAMP))) / {DAY}.0) AS a FROM {_HIT_KEY}) GROUP BY 1),
  s AS (SELECT *, list_filter([CASE WHEN china THEN ('china_scope', 16) END, CASE WHEN rec THEN ('recruitment_language', 12) END, CASE WHEN china AND rec AND hub THEN ('community_hub', 6) END, CASE WHEN china AND rec AND park THEN ('park_association', 6) END, CASE WHEN multi THEN ('multi_query', 8) END, CASE WHEN recency > 0 THEN ('recent_result', recency) END,
    CASE WHEN detail THEN ('single_post_only', -12) END, CASE WHEN blocked THEN ('access_restriction', -45) END, CASE WHEN NOT china THEN ('missing_china_signal', -18) END], lambda x: x IS NOT NULL) AS g FROM f)
  SELECT s.source_key, greatest(0, least(100, 10 + list_sum(list_transform(g, lambda x: x[2])))) AS score, array_to_string(list_transform(g, lambda x: x[1]), ',') AS signals, CASE WHEN k.source_key IS NOT NULL THEN 'already_registered' WHEN blocked THEN 'rejected_access_restricted' WHEN china AND rec THEN 'needs_review' ELSE 'backlog' END AS status, recency
  FROM s LEFT JOIN (SELECT DISTINCT 'career:' || regexp_extract(lower(source_root_url), '^(https?://[^/?#]+)', 1) AS source_key FROM sources WHERE lifecycle = 'approved') k ON k.source_key = s.source_key""")
def candidate_priorities(spark, d):
    """The score, signals and status of every discovered host."""
    china = F.concat(*[F.coalesce(c, F.lit("")) for c in ("title", "snippet", "query_text")]).rlike("中国|全国|大陆|内地|省|自治区|China")
    hits = table(spark, d, "discovery_hits").select("query_id", "title", "snippet", "url", F.unix_micros(F.try_to_timestamp(F.regexp_extract("published_at", r"^\d{4}-\d{2}-\d{2}", 0))).alias("published_us"), F.unix_micros("discovered_at").alias("observed_us"), china.alias("in_china"))
    known = table(spark, d, "sources").filter("lifecycle = 'approved'").select(U.source_identity(U.canonical_url(F.col("source_root_url")))["source_key"].alias("source_key"))
    return candidate_scores(hits, known)


@query("""SELECT id, source_key, epoch_us(discovered_at) AS queued_us, row_number() OVER (ORDER BY discovered_at, id) AS place FROM sources WHERE NOT collection_enabled AND ((lifecycle = 'candidate' AND review_status = 'unreviewed') OR (lifecycle = 'probed' AND review_status = 'pending' AND epoch_us(discovered_at) <= epoch_us(TIMESTAMP '2026-08-20 00:00:00') - 86400000000))""")
def probe_backlog(spark, d):
    """Sources to probe: new ones, and failed ones a day later, the longest waiting first."""
    rows = table(spark, d, "sources").filter("NOT collection_enabled").filter(F.expr("lifecycle = 'candidate' AND review_status = 'unreviewed'") | (F.expr("lifecycle = 'probed' AND review_status = 'pending'") & (F.unix_micros("discovered_at") <= NOW_US - DAY)))
    # A dimension of bounded size; its order is its place.
    return rows.select("id", "source_key", F.unix_micros("discovered_at").alias("queued_us"), F.row_number().over(W.orderBy("discovered_at", "id")).cast("long").alias("place"))


@query("""SELECT id, lifecycle = 'approved' AND review_status = 'approved' AND collection_enabled AND approved_at IS NOT NULL AND source_root_url LIKE 'https://%' AS approved, CASE WHEN source_type = 'official_ats' THEN 99 WHEN source_type LIKE '%government%' OR source_type LIKE '%public%' THEN 98 WHEN source_type = 'company_career_site' THEN 92 ELSE 75 END AS trust,
  greatest(70, CASE WHEN source_type = 'official_ats' THEN 99 WHEN source_type LIKE '%government%' OR source_type LIKE '%public%' THEN 98 WHEN source_type = 'company_career_site' THEN 92 ELSE 75 END - 2) AS channel_score FROM sources""")
def source_trust(spark, d):
    """Whether a source is approved in every respect, and how far it is trusted."""
    kind = F.col("source_type")
    trust = F.when(kind == "official_ats", 99).when(kind.rlike("government|public"), 98).when(kind == "company_career_site", 92).otherwise(75)
    approved = F.expr("lifecycle = 'approved' AND review_status = 'approved' AND collection_enabled AND approved_at IS NOT NULL AND source_root_url LIKE 'https://%'")
    return table(spark, d, "sources").select("id", approved.alias("approved"), trust.alias("trust"), F.greatest(F.lit(70), trust - 2).alias("channel_score"))


@query(f"""SELECT id, sha256(source_key || '|' || coalesce(provider, '') || '|' || coalesce({canonical_sql('source_root_url')}, '') || '|' || coalesce({canonical_sql('public_api_url')}, '')) AS fingerprint FROM sources""")
def approval_identities(spark, d):
    """The digest of what an approval is bound to; a changed address needs a new review."""
    return table(spark, d, "sources").select("id", F.sha2(F.concat_ws("|", "source_key", F.coalesce("provider", F.lit("")), F.coalesce(U.canonical_url(F.col("source_root_url")), F.lit("")), F.coalesce(U.canonical_url(F.col("public_api_url")), F.lit(""))), 256).alias("fingerprint"))


_PROBED = f"(SELECT source_key, bool_or(source_id IS NOT NULL) AS verified, count(*) AS hits FROM (SELECT 'site:' || regexp_extract({canonical_sql('url')}, '^https?://([^/?#]+)', 1) AS source_key, source_id FROM discovery_hits) GROUP BY 1)"


@query(f"""SELECT s.id, CASE WHEN p.hits IS NULL THEN s.lifecycle WHEN s.lifecycle = 'approved' THEN CASE WHEN p.verified THEN 'approved' ELSE 'probed' END WHEN s.lifecycle = 'rejected' THEN 'rejected' ELSE 'probed' END AS lifecycle_after,
  CASE WHEN p.hits IS NULL OR s.lifecycle = 'rejected' THEN s.review_status WHEN p.verified THEN CASE WHEN s.lifecycle = 'approved' THEN 'approved' ELSE 'pending' END ELSE 'blocked' END AS review_after, s.revision + (p.hits IS NOT NULL AND s.lifecycle <> 'rejected')::INT AS revision_after FROM sources s LEFT JOIN {_PROBED} p ON p.source_key = s.source_key""")
def probe_transitions(spark, d):
    """What a round of probes makes of the sources: approved ones stay so only if verified, others wait for review or are blocked; rejected ones never come back."""
    key = F.concat(F.lit("site:"), U.host(U.canonical_url(F.col("url"))))
    probes = table(spark, d, "discovery_hits").select(key.alias("source_key"), "source_id").groupBy("source_key").agg(F.bool_or(F.col("source_id").isNotNull()).alias("verified"), F.lit(True).alias("probed"))
    rows = table(spark, d, "sources").select("id", "source_key", "lifecycle", "review_status", "revision").join(probes, "source_key", "left")
    untouched, ok, state = F.col("probed").isNull() | (F.col("lifecycle") == "rejected"), F.col("verified"), F.col("lifecycle")
    after = F.when(untouched, state).when((state == "approved") & ok, "approved").otherwise("probed")
    review = F.when(untouched, F.col("review_status")).when(~ok, "blocked").when(state == "approved", "approved").otherwise("pending")
    return rows.select("id", after.alias("lifecycle_after"), review.alias("review_after"), (F.col("revision") + F.when(untouched, 0).otherwise(1)).alias("revision_after"))


@query("""WITH r(id, expected, decision) AS (SELECT id, revision - (hash_parity)::INT, CASE WHEN lifecycle = 'rejected' THEN 'approve' ELSE 'reject' END FROM (SELECT *, revision % 3 = 0 AS hash_parity FROM sources))
  SELECT s.id, CASE WHEN r.expected <> s.revision THEN 'REVISION_CONFLICT' WHEN r.decision = 'approve' AND s.lifecycle <> 'probed' THEN 'NOT_VERIFIED' ELSE r.decision END AS outcome, CASE WHEN r.expected = s.revision AND r.decision = 'reject' THEN 'rejected' ELSE s.lifecycle END AS lifecycle_after FROM sources s JOIN r ON r.id = s.id""")
def review_outcomes(spark, d):
    """Reviews against the revision they saw: a stale one conflicts, an approval needs a verified probe."""
    s = table(spark, d, "sources").select("id", "revision", "lifecycle")
    reviews = s.select("id", (F.col("revision") - F.when(F.col("revision") % 3 == 0, 1).otherwise(0)).alias("expected"), F.when(F.col("lifecycle") == "rejected", "approve").otherwise("reject").alias("decision"))
    both = s.join(reviews, "id")
    outcome = F.when(F.col("expected") != F.col("revision"), "REVISION_CONFLICT").when((F.col("decision") == "approve") & (F.col("lifecycle") != "probed"), "NOT_VERIFIED").otherwise(F.col("decision"))
    return both.select("id", outcome.alias("outcome"), F.when((F.col("expected") == F.col("revision")) & (F.col("decision") == "reject"), "rejected").otherwise(F.col("lifecycle")).alias("lifecycle_after"))


# --- collection ------------------------------------------------------------------------------------------------

_HOURS = "CASE WHEN source_type = 'official_ats' THEN 6 WHEN source_type LIKE '%government%' OR source_type LIKE '%public%' THEN 12 ELSE 24 END"


@query(f"""SELECT id, cadence_hours, due_us, due FROM (SELECT s.id, {_HOURS} AS cadence_hours, epoch_us(a.at) + 3600000000 * {_HOURS} AS due_us, coalesce(epoch_us(a.at) + 3600000000 * {_HOURS} <= {_NOW}, true) AS due FROM sources s
  LEFT JOIN (SELECT source_id, max(observed_at) AS "at" FROM jobs GROUP BY 1) a ON a.source_id = s.id WHERE lifecycle = 'approved' AND collection_enabled) WHERE due ORDER BY due_us NULLS FIRST, id LIMIT 100""")
def due_sources(spark, d):
    """The hundred sources to collect first: never collected ones, then by their due time."""
    last = table(spark, d, "jobs").groupBy(F.col("source_id").alias("id")).agg(F.max("observed_at").alias("at"))
    kind = F.col("source_type")
    hours = F.when(kind == "official_ats", 6).when(kind.rlike("government|public"), 12).otherwise(24)
    rows = table(spark, d, "sources").filter("lifecycle = 'approved' AND collection_enabled").join(last, "id", "left")
    due = rows.select("id", hours.alias("cadence_hours"), (F.unix_micros("at") + F.lit(3_600_000_000) * hours).alias("due_us")).withColumn("due", F.coalesce(F.col("due_us") <= NOW_US, F.lit(True)))
    return due.filter("due").orderBy(F.asc_nulls_first("due_us"), "id").limit(100)


_RUNS = "(SELECT source_id || ':' || CAST(CAST(observed_at AS DATE) AS VARCHAR) AS run_id, source_id, CAST(observed_at AS DATE) AS day, count(*) AS rows_, count(*) FILTER (status = 'closed') AS closed, count(*) FILTER (description IS NULL) AS bad FROM jobs GROUP BY ALL)"


@query(f"""WITH r AS (SELECT *, CASE WHEN bad = rows_ THEN 'failed' WHEN bad > 0 THEN 'partial' WHEN rows_ = closed THEN 'no_work' ELSE 'completed' END AS status FROM {_RUNS}) SELECT source_id, count(*) AS runs, count(*) FILTER (status = 'completed') AS completed, count(*) FILTER (status = 'partial') AS partial, count(*) FILTER (status = 'failed') AS failed,
  CASE WHEN count(*) FILTER (status IN ('completed', 'no_work')) = count(*) THEN 'completed' WHEN count(*) FILTER (status = 'failed') = count(*) THEN 'failed' ELSE 'completed_with_errors' END AS outcome, CAST(max(day) FILTER (status = 'completed') AS VARCHAR) AS checkpoint FROM r GROUP BY 1""")
def run_summary(spark, d):
    """Runs of each source (its passes of one day), their statuses, the outcome over all and the last good one."""
    day = F.to_date("observed_at")
    runs = table(spark, d, "jobs").groupBy("source_id", day.alias("day")).agg(F.count("*").alias("n"), F.count_if(F.col("status") == "closed").alias("closed"), F.count_if(F.col("description").isNull()).alias("bad"))
    status = F.when(F.col("bad") == F.col("n"), "failed").when(F.col("bad") > 0, "partial").when(F.col("n") == F.col("closed"), "no_work").otherwise("completed")
    r = runs.withColumn("status", status)
    of = lambda *s: F.count_if(F.col("status").isin(*s))
    outcome = F.when(of("completed", "no_work") == F.count("*"), "completed").when(of("failed") == F.count("*"), "failed").otherwise("completed_with_errors")
    return r.groupBy("source_id").agg(F.count("*").alias("runs"), of("completed").alias("completed"), of("partial").alias("partial"), of("failed").alias("failed"), outcome.alias("outcome"), F.max(F.when(F.col("status") == "completed", F.col("day"))).cast("string").alias("checkpoint"))


@query(f"SELECT run_id, source_id, CAST(day AS VARCHAR) AS day, rows_ AS n FROM {_RUNS} QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY day DESC) <= 5")
def retained_runs(spark, d):
    """The five newest runs of each source."""
    runs = table(spark, d, "jobs").groupBy("source_id", F.to_date("observed_at").alias("day")).agg(F.count("*").alias("n"))
    kept = runs.withColumn("_r", F.row_number().over(W.partitionBy("source_id").orderBy(F.desc("day")))).filter("_r <= 5")
    return kept.select(F.concat_ws(":", "source_id", F.col("day").cast("string")).alias("run_id"), "source_id", F.col("day").cast("string").alias("day"), "n")


@query("""WITH w AS (SELECT run_id, source_id, n, row_number() OVER (PARTITION BY source_id ORDER BY run_id) AS k FROM (SELECT source_id || ':' || CAST(CAST(observed_at AS DATE) AS VARCHAR) AS run_id, source_id, count(*) AS n FROM jobs GROUP BY ALL)), c AS (SELECT DISTINCT source_id || ':' || CAST(CAST(ingested_at AS DATE) AS VARCHAR) AS run_id FROM jobs)
  SELECT w.run_id, CASE WHEN c.run_id IS NOT NULL THEN 'committed' ELSE 'interrupted' END AS state FROM w LEFT JOIN c ON c.run_id = w.run_id""")
def reconciled_runs(spark, d):
    """Runs that announced a commit, against what was really committed: those without are interrupted."""
    run = lambda c: F.concat_ws(":", "source_id", F.to_date(c).cast("string"))
    jobs = table(spark, d, "jobs")
    begun, done = jobs.select(run("observed_at").alias("run_id")).distinct(), jobs.select(run("ingested_at").alias("run_id")).distinct().withColumn("ok", F.lit(True))
    return begun.join(done, "run_id", "left").select("run_id", F.when(F.col("ok"), "committed").otherwise("interrupted").alias("state"))


@query("""SELECT provider, day, n, row_number() OVER (PARTITION BY provider ORDER BY day) AS receipt FROM (SELECT provider, CAST(CAST(discovered_at + INTERVAL 8 HOUR AS DATE) AS VARCHAR) AS day, count(*) AS n FROM discovery_hits GROUP BY ALL)""")
def daily_receipts(spark, d):
    """One receipt per provider and local day, however often the day ran."""
    local = F.to_date(F.col("discovered_at") + F.expr("INTERVAL 8 HOURS")).cast("string")
    days = table(spark, d, "discovery_hits").groupBy("provider", local.alias("day")).agg(F.count("*").alias("n"))
    return days.withColumn("receipt", F.row_number().over(W.partitionBy("provider").orderBy("day")).cast("long"))


@query("""WITH x AS (SELECT source_id, id, content_hash, observed_at, rec_id, lag(content_hash) OVER (PARTITION BY id ORDER BY observed_at, rec_id) AS before FROM jobs) SELECT source_id, count(*) FILTER (before IS NULL) AS new, count(*) FILTER (before = content_hash) AS not_modified, count(*) FILTER (before <> content_hash) AS changed, epoch_us(max(observed_at) FILTER (before = content_hash)) AS last_not_modified_us,
  epoch_us(max(observed_at) FILTER (before IS NULL OR before <> content_hash)) AS last_collected_us FROM x GROUP BY 1""")
def not_modified(spark, d):
    """Passes that brought nothing new touch only their own instant; the last collection stays where it was."""
    before = F.lag("content_hash").over(W.partitionBy("id").orderBy("observed_at", "rec_id"))
    x = table(spark, d, "jobs").select("source_id", "id", "content_hash", "observed_at", "rec_id").withColumn("before", before)
    new, same = F.col("before").isNull(), F.coalesce(F.col("before") == F.col("content_hash"), F.lit(False))
    return x.groupBy("source_id").agg(F.count_if(new).alias("new"), F.count_if(same).alias("not_modified"), F.count_if(~new & ~same).alias("changed"), F.unix_micros(F.max(F.when(same, F.col("observed_at")))).alias("last_not_modified_us"), F.unix_micros(F.max(F.when(~same, F.col("observed_at")))).alias("last_collected_us"))


# --- postings --------------------------------------------------------------------------------------------------


@query("SELECT rec_id, CASE WHEN regexp_matches(valid_through, '^\\d{4}-\\d{2}-\\d{2}$') THEN epoch_us(try_cast(valid_through AS TIMESTAMP)) + 86399999000 END AS end_us FROM jobs WHERE valid_through IS NOT NULL")
def validity_ends(spark, d):
    """A mere date is valid to its last millisecond."""
    day = F.col("valid_through").rlike(r"^\d{4}-\d{2}-\d{2}$")
    return table(spark, d, "jobs").filter("valid_through IS NOT NULL").select("rec_id", F.when(day, F.unix_micros(F.try_to_timestamp("valid_through")) + 86_399_999_000).alias("end_us"))


@query(f"""WITH p AS (SELECT * FROM {_PLACES}), g AS (SELECT rec_id, bool_and(level_name = 'nation') AS generic FROM p GROUP BY 1), s AS (SELECT j.source_id, p.province_code, count(*) AS n FROM p JOIN jobs j ON j.rec_id = p.rec_id WHERE p.province_code IS NOT NULL GROUP BY ALL), b AS (SELECT source_id, arg_max(province_code, (n, province_code)) AS province FROM s GROUP BY 1)
  SELECT j.rec_id, CASE WHEN g.rec_id IS NULL AND b.province IS NOT NULL AND t.source_type IN ('government', 'official_ats') THEN 'source_scope' WHEN g.rec_id IS NULL THEN 'unknown' WHEN g.generic THEN 'national' ELSE 'explicit' END AS basis, CASE WHEN g.rec_id IS NULL AND t.source_type IN ('government', 'official_ats') THEN b.province END AS inferred
  FROM jobs j LEFT JOIN g ON g.rec_id = j.rec_id LEFT JOIN b ON b.source_id = j.source_id LEFT JOIN sources t ON t.id = j.source_id""")
def location_basis(spark, d):
    """Where a record's places come from: named ones, the whole country, or the scope of an authoritative source for records that name none."""
    found = record_places(spark, d)
    generic = found.groupBy("rec_id").agg(F.bool_and(F.col("level_name") == "nation").alias("generic"))
    jobs = table(spark, d, "jobs").select("rec_id", "source_id")
    per = found.filter("province_code IS NOT NULL").select("rec_id", "province_code").join(jobs, "rec_id").groupBy("source_id", "province_code").agg(F.count("*").alias("n"))
    scope = per.groupBy("source_id").agg(F.max_by("province_code", F.struct("n", "province_code")).alias("province"))
    trusted = table(spark, d, "sources").select(F.col("id").alias("source_id"), F.col("source_type").isin("government", "official_ats").alias("trusted"))
    rows = jobs.join(generic, "rec_id", "left").join(F.broadcast(scope), "source_id", "left").join(F.broadcast(trusted), "source_id", "left")
    inferred = F.when(F.col("generic").isNull() & F.coalesce("trusted", F.lit(False)), F.col("province"))
    basis = F.when(F.col("generic").isNull() & inferred.isNotNull(), "source_scope").when(F.col("generic").isNull(), "unknown").when(F.col("generic"), "national").otherwise("explicit")
    return rows.select("rec_id", basis.alias("basis"), inferred.alias("inferred"))


_VISIBLE = f"s.lifecycle = 'approved' AND s.review_status = 'approved' AND s.collection_enabled AND j.status NOT IN ('closed', 'quarantined') AND coalesce(epoch_us(try_cast(j.valid_through AS TIMESTAMP)) >= {_NOW}, true)"


@query(f"SELECT j.rec_id, coalesce({_VISIBLE}, false) AS displayable, strlen(j.source_url) <= 8192 AND strlen(j.apply_url) <= 8192 AS urls_safe, coalesce(strlen(j.description), 0) + strlen(j.title) + strlen(j.company) <= 1500000 AS row_safe FROM jobs j LEFT JOIN sources s ON s.id = j.source_id")
def displayable_jobs(spark, d):
    """Records that may be shown now, and whether their addresses and texts are within the limits of a hosted row."""
    s = table(spark, d, "sources").select(F.col("id").alias("source_id"), F.expr("lifecycle = 'approved' AND review_status = 'approved' AND collection_enabled").alias("ok"))
    rows = table(spark, d, "jobs").join(F.broadcast(s), "source_id", "left")
    valid = F.coalesce(F.unix_micros(F.try_to_timestamp("valid_through")) >= NOW_US, F.lit(True))
    bytes_ = lambda c: F.octet_length(c)
    return rows.select("rec_id", F.coalesce(F.col("ok") & ~F.col("status").isin("closed", "quarantined") & valid, F.lit(False)).alias("displayable"), ((bytes_("source_url") <= 8192) & (bytes_("apply_url") <= 8192)).alias("urls_safe"), (F.coalesce(bytes_("description"), F.lit(0)) + bytes_("title") + bytes_("company") <= 1_500_000).alias("row_safe"))


@query("""SELECT source_id, provider, array_to_string(list_distinct(list(url ORDER BY discovered_at DESC, hit_id DESC))[1:20], ' ') IS NOT NULL AS any_url, least(count(DISTINCT url), 20) AS kept_urls, least(count(*), 50) AS kept_evidence FROM discovery_hits WHERE source_id IS NOT NULL GROUP BY ALL""")
def capped_history(spark, d):
    """What a source keeps of its history: twenty addresses, fifty items of evidence."""
    return table(spark, d, "discovery_hits").filter("source_id IS NOT NULL").groupBy("source_id", "provider").agg((F.count("url") > 0).alias("any_url"), F.least(F.countDistinct("url"), F.lit(20)).alias("kept_urls"), F.least(F.count("*"), F.lit(50)).alias("kept_evidence"))


@query(f"SELECT id, 'employer-cn-' || substr(sha256({NORMAL.format('name')}), 1, 20) AS stable_id, length({NORMAL.format('name')}) >= 2 AS sound FROM employer_targets")
def employer_ids(spark, d):
    """Stable ids of listed employers; a name of less than two letters has none that is sound."""
    key = X.canonical_name(F.col("name"))
    return table(spark, d, "employer_targets").select("id", F.concat(F.lit("employer-cn-"), F.substring(F.sha2(key, 256), 1, 20)).alias("stable_id"), (F.length(key) >= 2).alias("sound"))


@query(f"""SELECT check_id, violations, violations = 0 AS passed FROM (SELECT 'ids_unique' AS check_id, (SELECT count(*) - count(DISTINCT id) FROM employer_targets) AS violations UNION ALL SELECT 'names_present', (SELECT count(*) FROM employer_targets WHERE name IS NULL OR name = '') UNION ALL SELECT 'names_unique', (SELECT count(*) - count(DISTINCT {NORMAL.format('name')}) FROM employer_targets)
  UNION ALL SELECT 'tiers_known', (SELECT count(*) FROM employer_targets WHERE tier NOT IN ('A', 'B')) UNION ALL SELECT 'regions_known', (SELECT count(*) FROM employer_targets WHERE region_code IS NOT NULL AND region_code NOT IN (SELECT region_code FROM regions)) UNION ALL SELECT 'websites_on_domains', (SELECT count(*) FROM employer_targets WHERE official_website IS NOT NULL AND NOT list_contains(official_domains, regexp_extract(official_website, '^https?://([^/]+)', 1))))""")
def universe_checks(spark, d):
    """Constraints of the list of employers, in one aggregation."""
    known = F.broadcast(table(spark, d, "regions").select("region_code", F.lit(True).alias("_known")))
    rows = table(spark, d, "employer_targets").join(known, "region_code", "left")
    yes = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    checks = {
        "ids_unique": F.count("*") - F.countDistinct("id"), "names_present": yes(F.col("name").isNull() | (F.col("name") == "")), "names_unique": F.count("*") - F.countDistinct(X.normal_text(F.col("name"))), "tiers_known": yes(~F.col("tier").isin("A", "B")),
        "regions_known": yes(F.col("region_code").isNotNull() & F.col("_known").isNull()), "websites_on_domains": yes(F.col("official_website").isNotNull() & ~F.array_contains("official_domains", F.regexp_extract("official_website", "^https?://([^/]+)", 1))),
    }
    one = rows.agg(*[v.cast("long").alias(k) for k, v in checks.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("check_id"), F.col(k).alias("violations")) for k in checks]))).withColumn("passed", F.col("violations") == 0)


@query("""SELECT query_id, r.pos + 1 AS position, coalesce(r.rank_no, r.pos + 1) AS rank, r.url, r.kind FROM (SELECT query_id, unnest(list_transform(range(len(x)), lambda i: {'pos': i, 'rank_no': x[i + 1].rank_no, 'url': x[i + 1].url, 'kind': x[i + 1].kind})) AS r FROM (SELECT query_id, list({'rank_no': rank_no, 'url': url, 'kind': provider_evidence['kind']} ORDER BY hit_id) AS x FROM discovery_hits GROUP BY 1))""")
def imported_results(spark, d):
    """Nested results of imported queries, flattened; a result without a rank has its position."""
    item = F.struct("hit_id", "rank_no", "url", F.col("provider_evidence")["kind"].alias("kind"))
    nested = table(spark, d, "discovery_hits").groupBy("query_id").agg(F.array_sort(F.collect_list(item)).alias("results"))
    flat = nested.select("query_id", F.posexplode("results").alias("pos", "r"))
    position = (F.col("pos") + 1).cast("long")
    return flat.select("query_id", position.alias("position"), F.coalesce("r.rank_no", position).alias("rank"), "r.url", "r.kind")
