"""Queries on plans, queues, coverage, retention and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.functions import expressions as X
from millrace.functions import urls as U
from millrace.operators import relational as R
from millrace.plans.catalog_base import Catalog
from millrace.plans.geography import _PLACES, record_places
from millrace.plans.identity import NORMAL
from millrace.session import table

CATALOG = Catalog()
query = CATALOG.query

NOW, NOW_US = "2026-08-20 00:00:00", 1787184000000000
_NOW = f"epoch_us(TIMESTAMP '{NOW}')"
SPLIT_US = 1780272000000000
DAY = 86_400_000_000

# --- query plans -----------------------------------------------------------------------------------------------

_TEMPLATES = ("{city} 招聘", "{city} 校园招聘", "{city} jobs {year}")
_YEARS = (2025, 2026)


@query("""WITH t(template) AS (VALUES ('{city} 招聘'), ('{city} 校园招聘'), ('{city} jobs {year}')), x AS (SELECT DISTINCT replace(t.template, '{city}', r.name_zh) AS q FROM t, regions r WHERE r.level_name = 'city' AND t.template NOT LIKE '%{year}%'
    UNION SELECT DISTINCT replace(replace(t.template, '{city}', r.name_zh), '{year}', CAST(y AS VARCHAR)) FROM t, regions r, (VALUES (2025), (2026)) ys(y) WHERE r.level_name = 'city' AND t.template LIKE '%{year}%'), a AS (SELECT 'cities' AS bucket, q FROM x UNION SELECT 'seen', query_text FROM discovery_hits WHERE query_text <> '')
  SELECT bucket, q AS query_text, bucket || ':' || lpad(CAST(row_number() OVER (PARTITION BY bucket ORDER BY q) AS VARCHAR), 5, '0') AS task_id FROM a""")
def expanded_tasks(spark, d):
    """The plan: templates over their dimensions together with given queries, numbered per bucket; a template without a placeholder gives one task."""
    cities = F.broadcast(table(spark, d, "regions").filter("level_name = 'city'").select("name_zh"))
    named = cities.select("name_zh", F.explode(F.array(*map(F.lit, _TEMPLATES))).alias("t")).select(F.replace("t", F.lit("{city}"), F.col("name_zh")).alias("t"))
    years = F.when(F.col("t").contains("{year}"), F.array(*map(F.lit, map(str, _YEARS)))).otherwise(F.array(F.lit("")))
    text = named.select("t", F.explode(years).alias("y")).select(F.lit("cities").alias("bucket"), F.replace("t", F.lit("{year}"), F.col("y")).alias("query_text"))
    given = table(spark, d, "discovery_hits").filter("query_text <> ''").select(F.lit("seen").alias("bucket"), "query_text")
    n = F.row_number().over(W.partitionBy("bucket").orderBy("query_text"))
    return text.unionByName(given).distinct().withColumn("task_id", F.concat("bucket", F.lit(":"), F.lpad(n.cast("string"), 5, "0")))


_TASKS = f"""(SELECT split_part(query_id, ':', 1) AS bucket, query_id, list_sort(list(DISTINCT provider)) AS providers, bool_or(epoch_us(discovered_at) < {SPLIT_US}) AS done, max(discovered_at) FILTER (epoch_us(discovered_at) < {SPLIT_US}) AS last_at FROM discovery_hits GROUP BY ALL)"""


def tasks(spark, d) -> DataFrame:
    """``bucket, query_id, providers, done, last_at``: the tasks of the plan, done if they were run before the split."""
    early = F.unix_micros("discovered_at") < SPLIT_US
    hits = table(spark, d, "discovery_hits").select(F.split_part("query_id", F.lit(":"), F.lit(1)).alias("bucket"), "query_id", "provider", "discovered_at")
    return hits.groupBy("bucket", "query_id").agg(F.array_sort(F.collect_set("provider")).alias("providers"), F.bool_or(early).alias("done"), F.max(F.when(early, F.col("discovered_at"))).alias("last_at"))


@query(f"""SELECT bucket, count(*) AS planned, count(*) FILTER (done) AS completed, bool_and(done) AS complete, CASE WHEN bool_and(done) THEN count(*) ELSE count(*) FILTER (NOT done) END AS remaining,
  NOT bool_and(done) OR coalesce(epoch_us(max(last_at)) + 60 * {DAY} <= {_NOW}, true) AS due FROM {_TASKS} GROUP BY bucket""")
def due_buckets(spark, d):
    """Progress of each bucket; one is due if it was begun, never completed, or completed longer ago than its cadence."""
    rows = tasks(spark, d).groupBy("bucket").agg(F.count("*").alias("planned"), F.count_if("done").alias("completed"), F.bool_and("done").alias("complete"), F.max("last_at").alias("at"))
    due = ~F.col("complete") | F.coalesce(F.unix_micros("at") + 60 * DAY <= NOW_US, F.lit(True))
    return rows.select("bucket", "planned", "completed", "complete", F.when(F.col("complete"), F.col("planned")).otherwise(F.col("planned") - F.col("completed")).alias("remaining"), due.alias("due"))


@query(f"SELECT query_id, bucket, list_has_any(providers, ['kite_api', 'crawl_index']) AS runnable FROM {_TASKS} WHERE NOT done")
def runnable_tasks(spark, d):
    """Open tasks that an available provider can run; the others are blocked."""
    can = F.arrays_overlap("providers", F.array(F.lit("kite_api"), F.lit("crawl_index")))
    return tasks(spark, d).filter("NOT done").select("query_id", "bucket", can.alias("runnable"))


@query(f"SELECT bucket, query_id, round FROM (SELECT bucket, query_id, row_number() OVER (PARTITION BY bucket ORDER BY query_id) AS round FROM {_TASKS} WHERE NOT done) ORDER BY round, bucket LIMIT 100")
def fair_schedule(spark, d):
    """The next hundred open tasks, one per bucket and round."""
    ranked = tasks(spark, d).filter("NOT done").select("bucket", "query_id", F.row_number().over(W.partitionBy("bucket").orderBy("query_id")).alias("round"))
    # A bucket can't have more than the limit among the first; the filter also bounds the window.
    return ranked.filter("round <= 100").orderBy("round", "bucket").limit(100).select("bucket", "query_id", F.col("round").cast("long").alias("round"))


@query("""WITH h AS (SELECT provider || ':' || query_id AS group_id, hit_id, coalesce(rank_no, CAST(row_number() OVER (PARTITION BY provider, query_id ORDER BY hit_id) AS INT)) AS r, discovered_at FROM discovery_hits)
  SELECT group_id, hit_id, row_number() OVER (PARTITION BY group_id ORDER BY r, hit_id) AS rank FROM h""")
def provider_results(spark, d):
    """Hits of all providers grouped by provider and query and ranked anew; one without a rank stands where it arrived."""
    arrived = F.row_number().over(W.partitionBy("provider", "query_id").orderBy("hit_id"))
    rows = table(spark, d, "discovery_hits").select(F.concat_ws(":", "provider", "query_id").alias("group_id"), "hit_id", F.coalesce("rank_no", arrived).alias("r"))
    return rows.select("group_id", "hit_id", F.row_number().over(W.partitionBy("group_id").orderBy("r", "hit_id")).cast("long").alias("rank"))


@query("""SELECT provider, count(*) AS hits, count(source_id) AS matched, CASE WHEN count(source_id) = 0 THEN 'failed' WHEN count(source_id) < count(*) THEN 'partial' ELSE 'completed' END AS status, count(DISTINCT CAST(discovered_at AS DATE)) AS days, count(DISTINCT CAST(discovered_at AS DATE)) >= 2 AS mature,
  count(*) >= 100 AND bool_or(provider_evidence IS NOT NULL) AS live FROM discovery_hits GROUP BY 1""")
def provider_status(spark, d):
    """Status ladder, receipt days and liveness of each provider's runs."""
    matched, n, days = F.count("source_id"), F.count("*"), F.countDistinct(F.to_date("discovered_at"))
    return table(spark, d, "discovery_hits").groupBy("provider").agg(n.alias("hits"), matched.alias("matched"), F.when(matched == 0, "failed").when(matched < n, "partial").otherwise("completed").alias("status"), days.alias("days"), (days >= 2).alias("mature"), ((n >= 100) & F.bool_or(F.col("provider_evidence").isNotNull())).alias("live"))


# --- employers -------------------------------------------------------------------------------------------------

_HOST = "regexp_extract(lower({0}), '^https?://([^/?#@:]+)', 1)"
_MATCHES = f"""(SELECT DISTINCT t.id AS target_id, s.id AS source_id, s.lifecycle FROM employer_targets t JOIN sources s ON list_bool_or(list_transform(t.official_domains, lambda x: {_HOST.format('s.source_root_url')} = x OR ends_with({_HOST.format('s.source_root_url')}, '.' || x)))
    OR list_bool_or(list_transform(list_concat([t.name], coalesce(t.aliases, [])), lambda a: length({NORMAL.format('a')}) >= 2 AND contains({NORMAL.format('s.name')}, {NORMAL.format('a')}))))"""


def target_matches(spark, d) -> DataFrame:
    """``target_id, source_id, lifecycle``: sources of an employer by domain or, for names, by containment.

    Domains are a hash join on the suffixes of each host.  Names are a hash join
    too: of a source's normal name all substrings are listed, since names are
    short; nothing is compared pair by pair.
    """
    targets, sources = table(spark, d, "employer_targets"), table(spark, d, "sources")
    domains = targets.select(F.col("id").alias("target_id"), F.explode("official_domains").alias("k")).distinct()
    hosts = sources.select(F.col("id").alias("source_id"), "lifecycle", F.explode(X.suffixes(U.host(F.col("source_root_url")))).alias("k"))
    names = targets.select(F.col("id").alias("target_id"), F.explode(F.transform(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))), X.normal_text)).alias("k")).filter("length(k) >= 2").distinct()
    # Only lengths that occur among the names are cut out.
    lengths = F.broadcast(names.select(F.length("k").alias("n")).distinct())
    normal = sources.select(F.col("id").alias("source_id"), "lifecycle", X.normal_text(F.col("name")).alias("s")).join(lengths, F.col("n") <= F.length("s"))
    parts = normal.select("source_id", "lifecycle", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - F.col("n") + 1), lambda i: F.substring(F.col("s"), i, F.col("n")))).alias("k")).distinct()
    return domains.join(hosts, "k").unionByName(names.join(parts, "k")).select("target_id", "source_id", "lifecycle").distinct()


@query(f"SELECT target_id, source_id FROM {_MATCHES}")
def employer_sources(spark, d):
    return target_matches(spark, d).select("target_id", "source_id")


_COVERAGE = f"""(SELECT t.id AS target_id, t.tier, coalesce(array_to_string(list_sort(list(DISTINCT m.source_id) FILTER (m.source_id IS NOT NULL)), ','), '') AS source_ids, CASE WHEN bool_or(m.lifecycle = 'approved') THEN 'covered' WHEN bool_or(m.lifecycle = 'probed') THEN 'awaiting_approval' WHEN count(m.source_id) > 0 THEN 'discovered' ELSE 'missing' END AS coverage,
    count(DISTINCT m.source_id) FILTER (m.lifecycle = 'rejected') AS failures FROM employer_targets t LEFT JOIN {_MATCHES} m ON m.target_id = t.id GROUP BY ALL)"""


def coverage_of(spark, d) -> DataFrame:
    rank = F.when(F.col("lifecycle") == "approved", 3).when(F.col("lifecycle") == "probed", 2).otherwise(1)
    found = target_matches(spark, d).groupBy("target_id").agg(F.array_join(F.array_sort(F.collect_set("source_id")), ",").alias("source_ids"), F.max(rank).alias("r"), F.count_if(F.col("lifecycle") == "rejected").alias("failures"))
    label = F.when(F.col("r") == 3, "covered").when(F.col("r") == 2, "awaiting_approval").when(F.col("r") == 1, "discovered").otherwise("missing")
    return table(spark, d, "employer_targets").select(F.col("id").alias("target_id"), "tier").join(found, "target_id", "left").select("target_id", "tier", F.coalesce("source_ids", F.lit("")).alias("source_ids"), label.alias("coverage"), F.coalesce("failures", F.lit(0)).alias("failures"))


@query(f"SELECT target_id, source_ids, coverage, CASE coverage WHEN 'covered' THEN '' WHEN 'missing' THEN 'NO_SOURCE' ELSE 'NO_APPROVED_SOURCE' END AS gap FROM {_COVERAGE}")
def employer_coverage(spark, d):
    """Each employer's sources, its coverage and what is lacking."""
    gap = F.when(F.col("coverage") == "covered", "").when(F.col("coverage") == "missing", "NO_SOURCE").otherwise("NO_APPROVED_SOURCE")
    return coverage_of(spark, d).select("target_id", "source_ids", "coverage", gap.alias("gap"))


_SEEN = f"""(SELECT DISTINCT t.id FROM employer_targets t JOIN (SELECT DISTINCT {NORMAL.format('company')} AS c FROM jobs) j ON length(j.c) >= 2 AND length({NORMAL.format('t.name')}) >= 2 AND contains({NORMAL.format('t.name')}, j.c))"""


@query(f"SELECT id AS target_id, id IN {_SEEN} AS seen FROM employer_targets")
def employers_in_jobs(spark, d):
    """Whether an employer's name holds or equals the company of any record, both of two letters at least."""
    seen = seen_targets(spark, d).withColumn("seen", F.lit(True))
    return table(spark, d, "employer_targets").select(F.col("id").alias("target_id")).join(seen, "target_id", "left").select("target_id", F.coalesce("seen", F.lit(False)).alias("seen"))


def seen_targets(spark, d) -> DataFrame:
    names = table(spark, d, "employer_targets").select(F.col("id").alias("target_id"), X.normal_text(F.col("name")).alias("s")).filter("length(s) >= 2")
    n = F.length("s")
    parts = names.select("target_id", F.explode(F.flatten(F.transform(F.sequence(F.lit(2), n), lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(F.col("s"), i, k))))).alias("c")).distinct()
    companies = table(spark, d, "jobs").select(X.normal_text(F.col("company")).alias("c")).distinct()
    return parts.join(companies, "c", "left_semi").select("target_id").distinct()


_PRIORITY = f"""(SELECT c.target_id, c.tier, CASE c.tier WHEN 'A' THEN 1000 WHEN 'B' THEN 500 ELSE 100 END + CASE c.coverage WHEN 'missing' THEN 400 WHEN 'discovered' THEN 250 WHEN 'awaiting_approval' THEN 100 ELSE 0 END + CASE WHEN c.target_id IN {_SEEN} THEN 0 ELSE 500 END
    + CASE WHEN t.official_website IS NOT NULL OR len(t.official_domains) > 0 THEN 150 ELSE 0 END - least(300, 30 * c.failures) AS score, c.coverage FROM {_COVERAGE} c JOIN employer_targets t ON t.id = c.target_id)"""


def priorities(spark, d) -> DataFrame:
    rooted = table(spark, d, "employer_targets").select(F.col("id").alias("target_id"), (F.col("official_website").isNotNull() | (F.coalesce(F.size("official_domains"), F.lit(0)) > 0)).alias("rooted"))
    rows = coverage_of(spark, d).join(rooted, "target_id").join(seen_targets(spark, d).withColumn("seen", F.lit(True)), "target_id", "left")
    score = (
        F.when(F.col("tier") == "A", 1000).when(F.col("tier") == "B", 500).otherwise(100)
        + F.when(F.col("coverage") == "missing", 400).when(F.col("coverage") == "discovered", 250).when(F.col("coverage") == "awaiting_approval", 100).otherwise(0)
        + F.when(F.col("seen"), 0).otherwise(500)
        + F.when(F.col("rooted"), 150).otherwise(0)
        - F.least(F.lit(300), 30 * F.col("failures"))
    )
    return rows.select("target_id", "tier", score.cast("long").alias("score"), "coverage")


@query(f"SELECT target_id, score FROM {_PRIORITY} WHERE coverage <> 'covered' ORDER BY score DESC, tier, target_id LIMIT 300")
def target_queue(spark, d):
    """The three hundred employers to visit first, those covered aside."""
    return priorities(spark, d).filter("coverage <> 'covered'").orderBy(F.desc("score"), "tier", "target_id").limit(300).select("target_id", "score")


@query(f"SELECT coverage, count(*) AS targets, count(*) FILTER (score >= 1000) AS urgent, max(score) AS best FROM {_PRIORITY} GROUP BY 1")
def queue_summary(spark, d):
    """The queue by coverage."""
    return priorities(spark, d).groupBy("coverage").agg(F.count("*").alias("targets"), F.count_if(F.col("score") >= 1000).alias("urgent"), F.max("score").alias("best"))


@query("SELECT 'tier' AS facet, coalesce(tier, 'unknown') AS value, count(*) AS n FROM employer_targets GROUP BY ALL UNION ALL SELECT 'kind', coalesce(kind, 'unknown'), count(*) FROM employer_targets GROUP BY ALL UNION ALL SELECT 'industry', coalesce(industry, 'unknown'), count(*) FROM employer_targets GROUP BY ALL")
def universe_stats(spark, d):
    """Employers by tier, kind and industry, in one pass."""
    sets = table(spark, d, "employer_targets").select(F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.coalesce(c, F.lit("unknown")).alias("value")) for c in ("tier", "kind", "industry")])).alias("x"))
    return sets.groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))


# --- channels and regions --------------------------------------------------------------------------------------

#: ``channel, source types, any provider, on demand``.
_CHANNELS = (("public_ats", ("official_ats",), False, False), ("government", ("government",), False, False), ("campus", ("campus_board",), False, False), ("directories", ("public_board", "aggregator_board"), False, False), ("career_sites", ("company_career_site",), False, False), ("hosted", (), True, False), ("submissions", (), False, True))
_CH_SQL = "(VALUES " + ", ".join(f"('{c}', [{', '.join(repr(t) for t in ts)}]::VARCHAR[], {str(p).lower()}, {str(o).lower()})" for c, ts, p, o in _CHANNELS) + ") c(channel, types, hosted, on_demand)"


@query(f"""SELECT channel, count(s.id) AS matched, count(s.id) FILTER (s.lifecycle = 'approved') AS approved, coalesce(array_to_string(list_sort(list(s.id) FILTER (s.lifecycle = 'approved')), ','), '') AS approved_ids,
  CASE WHEN any_value(on_demand) THEN 'observed_on_demand' WHEN count(s.id) FILTER (s.lifecycle = 'approved') > 0 THEN 'covered' WHEN count(s.id) > 0 THEN 'NO_APPROVED_SOURCE' ELSE 'NO_SOURCE' END AS state
  FROM {_CH_SQL} LEFT JOIN sources s ON list_contains(c.types, s.source_type) OR (c.hosted AND s.provider IS NOT NULL) GROUP BY channel""")
def channel_coverage(spark, d):
    """Sources by channel; one that declares no facet matches none, and one on demand has no gap."""
    channels = spark.createDataFrame([(c, list(t), p, o) for c, t, p, o in _CHANNELS], "channel string, types array<string>, hosted boolean, on_demand boolean")
    sources = table(spark, d, "sources").select("id", "lifecycle", "source_type", "provider")
    rows = channels.join(sources, F.array_contains("types", F.col("source_type")) | (F.col("hosted") & F.col("provider").isNotNull()), "left")
    ok = F.col("lifecycle") == "approved"
    agg = rows.groupBy("channel").agg(F.count("id").alias("matched"), F.count_if(ok).alias("approved"), F.array_join(F.array_sort(F.collect_list(F.when(ok, F.col("id")))), ",").alias("approved_ids"), F.bool_or("on_demand").alias("o"))
    state = F.when(F.col("o"), "observed_on_demand").when(F.col("approved") > 0, "covered").when(F.col("matched") > 0, "NO_APPROVED_SOURCE").otherwise("NO_SOURCE")
    return agg.select("channel", "matched", "approved", "approved_ids", state.alias("state"))


_REGION_COVER = f"""(WITH p AS (SELECT j.id, j.source_id, p.region_code, p.province_code FROM {_PLACES} p JOIN jobs j ON j.rec_id = p.rec_id), x AS (SELECT region_code AS code, id, source_id FROM p UNION ALL SELECT province_code, id, source_id FROM p WHERE province_code IS NOT NULL AND province_code <> region_code),
    t AS (SELECT region_code AS code, count(*) AS n FROM employer_targets WHERE region_code IS NOT NULL GROUP BY 1)
  SELECT r.region_code, r.level_name, count(DISTINCT x.source_id) AS sources, count(DISTINCT x.id) AS jobs, coalesce(any_value(t.n), 0) AS employers FROM regions r LEFT JOIN x ON x.code = r.region_code LEFT JOIN t ON t.code = r.region_code WHERE r.level_name IN ('province', 'city') GROUP BY ALL)"""


def region_cover(spark, d) -> DataFrame:
    ids = table(spark, d, "jobs").select("rec_id", "id", "source_id")
    places = record_places(spark, d).join(ids, "rec_id")
    codes = F.explode(F.array_distinct(F.filter(F.array("region_code", "province_code"), lambda c: c.isNotNull())))
    found = places.select(codes.alias("region_code"), "id", "source_id").groupBy("region_code").agg(F.countDistinct("source_id").alias("sources"), F.countDistinct("id").alias("jobs"))
    here = table(spark, d, "employer_targets").filter("region_code IS NOT NULL").groupBy("region_code").agg(F.count("*").alias("employers"))
    rows = table(spark, d, "regions").filter("level_name IN ('province', 'city')").select("region_code", "level_name").join(found, "region_code", "left").join(here, "region_code", "left")
    return rows.na.fill(0, ["sources", "jobs", "employers"])


@query(f"SELECT *, sources = 0 AS no_source, jobs = 0 AS no_job, employers = 0 AS no_employer FROM {_REGION_COVER}")
def region_coverage(spark, d):
    """Sources, postings and employers of each province and city, with what is lacking."""
    rows = region_cover(spark, d)
    return rows.select("region_code", "level_name", "sources", "jobs", "employers", (F.col("sources") == 0).alias("no_source"), (F.col("jobs") == 0).alias("no_job"), (F.col("employers") == 0).alias("no_employer"))


@query(f"SELECT level_name, count(*) AS places, count(*) FILTER (jobs = 0) AS gaps, coalesce(array_to_string(list_sort(list(region_code) FILTER (jobs = 0)), ','), '') AS gap_ids FROM {_REGION_COVER} GROUP BY 1")
def coverage_summary(spark, d):
    gone = F.col("jobs") == 0
    return region_cover(spark, d).groupBy("level_name").agg(F.count("*").alias("places"), F.count_if(gone).alias("gaps"), F.array_join(F.array_sort(F.collect_list(F.when(gone, F.col("region_code")))), ",").alias("gap_ids"))


# --- retention, backoff, merging -------------------------------------------------------------------------------


@query("""SELECT rec_id, id FROM (SELECT rec_id, id, row_number() OVER (PARTITION BY id ORDER BY observed_at DESC, rec_id DESC) AS own, row_number() OVER (ORDER BY observed_at DESC, rec_id DESC) AS n FROM jobs) WHERE own = 1 OR n <= greatest(2000, (SELECT count(DISTINCT id) FROM jobs))""")
def retained_versions(spark, d):
    """The newest record of each posting, and the newest of all up to two thousand or the number of postings.

    The cut is an instant found from counts per second, so no row is ranked
    against all others; only the rows of the cut's second are.
    """
    jobs = table(spark, d, "jobs").select("rec_id", "id", F.unix_micros("observed_at").alias("us"))
    own = R.newest(jobs, ["id"], "us", "rec_id").select("rec_id", "id")
    limit = max(2000, jobs.agg(F.countDistinct("id").alias("n")).first()["n"])
    per_day = jobs.groupBy(F.floor(F.col("us") / DAY).alias("day")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.orderBy(F.desc("day")))  # one row per day
    cut = per_day.withColumn("upto", total).filter(F.col("upto") <= limit).agg(F.min("day").alias("day"), F.max("upto").alias("kept")).first()
    day, kept = (cut["day"], cut["kept"]) if cut["day"] is not None else (1 << 40, 0)
    whole = jobs.filter(F.floor(F.col("us") / DAY) >= day)
    rest = jobs.filter(F.floor(F.col("us") / DAY) < day).orderBy(F.desc("us"), F.desc("rec_id")).limit(limit - kept)
    return own.unionByName(whole.unionByName(rest).select("rec_id", "id")).distinct()


@query("""WITH e AS (SELECT source_id, hit_id, provider, discovered_at, provider_evidence IS NULL AS critical, row_number() OVER (PARTITION BY source_id, provider, provider_evidence IS NULL ORDER BY discovered_at DESC, hit_id DESC) AS k FROM discovery_hits WHERE source_id IS NOT NULL)
  SELECT source_id, hit_id FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY (critical AND k = 1) DESC, discovered_at DESC, hit_id DESC) AS n FROM e) WHERE n <= 12""")
def compact_evidence(spark, d):
    """Twelve items of evidence a source keeps: the latest critical one of each kind first, then the newest."""
    rows = table(spark, d, "discovery_hits").filter("source_id IS NOT NULL").select("source_id", "hit_id", "provider", "discovered_at", F.col("provider_evidence").isNull().alias("critical"))
    newest = (F.desc("discovered_at"), F.desc("hit_id"))
    k = F.row_number().over(W.partitionBy("source_id", "provider", "critical").orderBy(*newest))
    first = rows.withColumn("first", F.col("critical") & (k == 1))
    return first.withColumn("n", F.row_number().over(W.partitionBy("source_id").orderBy(F.desc("first"), *newest))).filter("n <= 12").select("source_id", "hit_id")


@query("""WITH p AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, value FROM events) SELECT user_id, event_type, min(pos) AS first_pos, max_by(value, pos) AS last_value FROM p GROUP BY ALL""")
def map_merge(spark, d):
    """Merged maps: a key keeps its first position and takes its last value."""
    pos = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    rows = table(spark, d, "events").select("user_id", "event_type", "value", pos.alias("pos"))
    return rows.groupBy("user_id", "event_type").agg(F.min("pos").alias("first_pos"), F.max_by("value", "pos").alias("last_value"))


@query("""WITH x AS (SELECT user_id, event_id, ts, event_type, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events),
  f AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id, island ORDER BY ts, event_id) - CASE WHEN island > 0 THEN 1 ELSE 0 END AS f, event_type FROM x QUALIFY event_type = 'error')
  SELECT event_id, CAST(f AS BIGINT) AS failures, least(30, CAST(2 ** least(5, f - 1) AS BIGINT)) AS retry_days, epoch_us(ts) + 3600000000 * least(24, CAST(2 ** least(6, f - 1) AS BIGINT)) + 60000000 * (('0x' || substr(sha256(CAST(user_id AS VARCHAR)), 1, 4))::BIGINT % 31) AS next_us,
    CASE WHEN f >= 4 THEN 'source_unreachable' WHEN f >= 2 THEN 'degraded' ELSE 'healthy' END AS health FROM f""")
def failure_backoff(spark, d):
    """After each failure: the run of failures, days and hours to wait (doubling, capped, with a jitter from the key) and the health it leaves."""
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    x = table(spark, d, "events").withColumn("island", F.sum(F.when(F.col("event_type") != "error", 1).otherwise(0)).over(w))
    f = (F.row_number().over(W.partitionBy("user_id", "island").orderBy("ts", "event_id")) - F.when(F.col("island") > 0, 1).otherwise(0)).cast("long")
    rows = x.withColumn("failures", f).filter("event_type = 'error'")
    power = lambda most: F.pow(F.lit(2.0), F.least(F.lit(most), F.col("failures") - 1)).cast("long")
    jitter = F.conv(F.substring(F.sha2(F.col("user_id").cast("string"), 256), 1, 4), 16, 10).cast("long") % 31
    next_us = F.unix_micros(F.col("ts").cast("timestamp")) + 3_600_000_000 * F.least(F.lit(24), power(6)) + 60_000_000 * jitter
    return rows.select("event_id", "failures", F.least(F.lit(30), power(5)).alias("retry_days"), next_us.alias("next_us"), F.when(F.col("failures") >= 4, "source_unreachable").when(F.col("failures") >= 2, "degraded").otherwise("healthy").alias("health"))


@query("""SELECT event_id, (SELECT count(*) FROM events b WHERE b.event_type = a.event_type AND epoch_us(b.ts) // 1000000 BETWEEN epoch_us(a.ts) // 1000000 - 59 AND epoch_us(a.ts) // 1000000) AS in_minute FROM events a""")
def sliding_rate(spark, d):
    """Calls of a kind within the last sixty seconds of each; time is cut into minutes, so a kind is spread over many groups."""
    seconds = table(spark, d, "events").select("event_id", "event_type", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("s"))
    per_second = seconds.groupBy("event_type", "s").agg(F.count("*").alias("n"))
    # Each second stands in its own minute and, for what looks back, in the next.
    minute = F.floor(F.col("s") / 60)
    spread = per_second.select("event_type", "s", "n", F.explode(F.array(minute, minute + 1)).alias("m"))
    run = F.sum("n").over(W.partitionBy("event_type", "m").orderBy("s").rangeBetween(-59, 0))
    counted = spread.withColumn("in_minute", run).filter(F.col("m") == minute).select("event_type", "s", "in_minute")
    return seconds.join(counted, ["event_type", "s"]).select("event_id", "in_minute")


# --- audit -----------------------------------------------------------------------------------------------------

_CHECKS = {
    "sources": {
        "source_keys_present": ("integrity", "source_key IS NULL OR source_key = ''"), "approved_have_time": ("integrity", "lifecycle = 'approved' AND approved_at IS NULL"), "approved_are_reviewed": ("integrity", "lifecycle = 'approved' AND review_status <> 'approved'"),
        "enabled_are_approved": ("integrity", "collection_enabled AND lifecycle <> 'approved'"), "rejected_are_blocked": ("integrity", "lifecycle = 'rejected' AND review_status <> 'blocked'"), "roots_are_https": ("implementation", "NOT source_root_url LIKE 'https://%'"),
        "zones_present": ("implementation", "feed_zone IS NULL OR feed_locale IS NULL"), "approved_after_discovery": ("integrity", "approved_at < discovered_at"), "revisions_positive": ("implementation", "revision < 1"),
    },
    "jobs": {
        "titles_present": ("implementation", "title IS NULL OR title = ''"), "companies_present": ("implementation", "company IS NULL OR company = ''"), "scores_in_range": ("integrity", "NOT active_score BETWEEN 0 AND 100 OR NOT authenticity_score BETWEEN 0 AND 100"),
        "statuses_known": ("integrity", "status NOT IN ('confirmed_active', 'needs_review', 'closed', 'quarantined')"), "ingested_after_observed": ("operational", "ingested_at < observed_at"), "evidence_present": ("integrity", "evidence IS NULL"), "hashes_are_sha256": ("implementation", "length(content_hash) <> 64"),
        "closed_score_zero": ("operational", "status = 'closed' AND active_score > 0"), "apply_urls_https": ("implementation", "NOT apply_url LIKE 'https://%'"),
    },
    "job_source_obs": {"missing_not_negative": ("integrity", "consecutive_missing < 0"), "thresholds_at_least_two": ("integrity", "closure_threshold < 2"), "modes_known": ("integrity", "missing_mode NOT IN ('authoritative', 'review_only')"), "scores_present": ("operational", "active_score IS NULL")},
    "discovery_hits": {"ranks_positive": ("implementation", "rank_no < 1"), "urls_present": ("integrity", "url IS NULL OR url = ''"), "hits_have_source": ("maturity", "source_id IS NULL"), "evidence_given": ("maturity", "provider_evidence IS NULL")},
}


def _audit_sql() -> str:
    rows = [f"SELECT '{name}' AS check_id, '{kind}' AS category, (SELECT count(*) FROM {t} WHERE {bad}) AS violations" for t, checks in _CHECKS.items() for name, (kind, bad) in checks.items()]
    rows += ["SELECT 'rec_ids_unique', 'integrity', (SELECT count(*) - count(DISTINCT rec_id) FROM jobs)", "SELECT 'source_ids_unique', 'integrity', (SELECT count(*) - count(DISTINCT id) FROM sources)", "SELECT 'jobs_have_source', 'integrity', (SELECT count(*) FROM jobs WHERE source_id NOT IN (SELECT id FROM sources))"]
    return " UNION ALL ".join(rows)


def audit_checks(spark, d) -> DataFrame:
    """``check_id, category, violations``: all checks of a table in one aggregation over it."""

    def checks(name: str, extra: list[tuple[str, str, Column]] = (), rows: DataFrame | None = None) -> DataFrame:
        each = [(k, kind, F.count_if(F.coalesce(F.expr(bad), F.lit(False)))) for k, (kind, bad) in _CHECKS[name].items()] + list(extra)
        one = (table(spark, d, name) if rows is None else rows).agg(*[v.cast("long").alias(k) for k, _, v in each])
        return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("check_id"), F.lit(kind).alias("category"), F.col(k).alias("violations")) for k, kind, _ in each])))

    known = F.broadcast(table(spark, d, "sources").select(F.col("id").alias("source_id"), F.lit(True).alias("_known")).distinct())
    jobs = table(spark, d, "jobs").join(known, "source_id", "left")
    parts = [
        checks("sources", [("source_ids_unique", "integrity", F.count("*") - F.countDistinct("id"))]),
        checks("jobs", [("rec_ids_unique", "integrity", F.count("*") - F.countDistinct("rec_id")), ("jobs_have_source", "integrity", F.count_if(F.col("_known").isNull()))], jobs),
        checks("job_source_obs"),
        checks("discovery_hits"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(f"SELECT check_id, category, violations, violations = 0 AS passed FROM ({_audit_sql()})")
def audit(spark, d):
    """The data checks with their violations."""
    return audit_checks(spark, d).withColumn("passed", F.col("violations") == 0)


@query(f"SELECT category, count(*) AS checks, count(*) FILTER (violations = 0) AS passed, bool_and(violations = 0) AS operational FROM ({_audit_sql()}) GROUP BY 1")
def audit_summary(spark, d):
    ok = F.col("violations") == 0
    return audit_checks(spark, d).groupBy("category").agg(F.count("*").alias("checks"), F.count_if(ok).alias("passed"), F.bool_and(ok).alias("operational"))
