"""Queries on URLs and identities: canonical forms, source keys, ownership, stable ids, conflicts and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import expressions as X
from millrace.functions import urls as U
from millrace.operators import relational as R
from millrace.plans.catalog_base import Catalog
from millrace.session import table

CATALOG = Catalog()
query = CATALOG.query

_TRACK = "('fbclid', 'from', 'gh_src', 'gclid', 'lever-source', 'ref', 'referrer', 'source', 'spm')"


def canonical_sql(url: str) -> str:
    """The canonical form in SQL, for URLs without credentials, ports and escapes, as the tables hold them."""
    path = f"regexp_replace(regexp_extract(trim({url}), '^https?://[^/?#]+([^?#]*)', 1, 'i'), '/{{2,}}', '/', 'g')"
    kept = f"list_sort(list_filter(string_split(regexp_extract(trim({url}), '\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(lower(x), 'utm_') AND NOT split_part(lower(x), '=', 1) IN {_TRACK}))"
    return f"""CASE WHEN regexp_matches(trim({url}), '^https?://[^/?#@:]+', 'i') THEN lower(regexp_extract(trim({url}), '^(https?://[^/?#]+)', 1, 'i'))
      || CASE WHEN {path} IN ('', '/') THEN '/' ELSE regexp_replace({path}, '/$', '') END || coalesce('?' || nullif(array_to_string({kept}, '&'), ''), '') END"""


NORMAL = r"regexp_replace(lower(coalesce({0}, '')), '[\s\p{{Z}}\p{{P}}\p{{S}}]+', '', 'g')"


@query(f"SELECT rec_id, {canonical_sql('apply_url')} AS apply_canonical, {canonical_sql('source_url')} AS source_canonical FROM jobs")
def canonical_urls(spark, d):
    return table(spark, d, "jobs").select("rec_id", U.canonical_url(F.col("apply_url")).alias("apply_canonical"), U.canonical_url(F.col("source_url")).alias("source_canonical"))


_HOSTS = {
    "localhost": True, "x.localhost": True, "printer.local": True, "": True, "example.com": False, "10.0.0.1": True, "100.64.0.1": True, "100.128.0.1": False, "127.9.9.9": True, "172.15.0.1": False,
    "172.31.255.255": True, "192.0.1.1": False, "192.168.1.1": True, "198.19.0.1": True, "198.20.0.1": False, "223.255.255.255": False, "224.0.0.1": True, "[::1]": True, "::ffff:10.0.0.1": True,
    "::ffff:8.8.8.8": False, "0:0:0:0:0:ffff:7f00:1": True, "2606:4700::1111": False, "2001:db8::1": True, "fd00::1": True, "fe80::1": True, "febf::1": True, "64:ff9b::1": True, "LOCALHOST.": True,
}


@query("SELECT host, private FROM (VALUES " + ", ".join(f"('{h}', {str(p).lower()})" for h, p in _HOSTS.items()) + ") t(host, private)")
def private_hosts(spark, d):
    """The judgement on hosts of every kind; the SQL states the expected ones."""
    return spark.createDataFrame([(h,) for h in _HOSTS], "host string").select("host", U.is_private_host(F.col("host")).alias("private"))


_BOARD_URLS = {
    "https://jobs.lever.co/Acme/1": ("Lever", "ats:lever:acme", "https://jobs.lever.co/Acme"), "https://api.lever.co/v0/postings/acme?mode=json": ("Lever", "ats:lever:acme", "https://jobs.lever.co/acme"),
    "https://boards.greenhouse.io/Acme/jobs/2": ("Greenhouse", "ats:greenhouse:acme", "https://job-boards.greenhouse.io/Acme"), "https://api.ashbyhq.com/posting-api/job-board/Ac": ("Ashby", "ats:ashby:ac", "https://jobs.ashbyhq.com/Ac"),
    "https://acme.wd3.myworkdayjobs.com/en/x": ("Workday", "ats:workday:acme.wd3.myworkdayjobs.com", "https://acme.wd3.myworkdayjobs.com"), "https://acme.example/careers/eng/7": (None, "career:https://acme.example", "https://acme.example/careers"),
    "https://acme.example/campus/positions/9/detail": (None, "career:https://acme.example", "https://acme.example/campus/positions"), "https://hr.x.gov.cn/zp/202601/t20260102_5.html": (None, "url:https://hr.x.gov.cn/zp", "https://hr.x.gov.cn/zp"),
    "https://acme.example/About?b=1": (None, "url:https://acme.example/about?b=1", "https://acme.example/About?b=1"),
}


def _literal(v: str | None) -> str:
    return "NULL" if v is None else f"'{v}'"


@query("SELECT * FROM (VALUES " + ", ".join(f"({', '.join(map(_literal, (u, *v)))})" for u, v in _BOARD_URLS.items()) + ") t(url, provider, source_key, root_url)")
def board_identities(spark, d):
    """Source keys of URLs of known boards, career sites, government directories and other pages; the SQL states the expected ones."""
    got = spark.createDataFrame([(u,) for u in _BOARD_URLS], "url string").withColumn("s", U.source_identity(U.canonical_url(F.col("url"))))
    return got.select("url", "s.provider", "s.source_key", "s.root_url")


_HIT_KEY = f"""(SELECT *, CASE WHEN regexp_matches(c, '/(jobs?|careers?|recruit(ment)?|positions?|experienced|campus)(/|$)', 'i') OR regexp_matches(c, '^https?://(jobs?|careers?|recruit|recruitment)\\.') THEN 'career:' || regexp_extract(c, '^(https?://[^/?#]+)', 1) ELSE 'url:' || lower(c) END AS source_key
  FROM (SELECT *, {canonical_sql('url')} AS c FROM discovery_hits) WHERE c IS NOT NULL)"""


@query(f"""SELECT source_key, count(*) AS hits, array_to_string(list_sort(list(DISTINCT query_id)), ',') AS queries, max(published_at) AS latest, min_by(hit_id, (coalesce(rank_no, 999999), hit_id)) AS primary_hit,
  array_to_string(list(c ORDER BY hit_id), ' ') AS urls FROM {_HIT_KEY} GROUP BY source_key""")
def candidate_groups(spark, d):
    """Hits by the source their URL belongs to: queries, the latest stamp as text, the hit of best rank, URLs in order of arrival."""
    hits = table(spark, d, "discovery_hits").select("hit_id", "query_id", "rank_no", "published_at", U.canonical_url(F.col("url")).alias("c")).filter("c IS NOT NULL")
    keyed = hits.withColumn("source_key", U.source_identity(F.col("c"))["source_key"])
    return keyed.groupBy("source_key").agg(
        F.count("*").alias("hits"),
        F.array_join(F.array_sort(F.collect_set("query_id")), ",").alias("queries"),
        F.max("published_at").alias("latest"),
        F.min_by("hit_id", F.struct(F.coalesce("rank_no", F.lit(999999)), "hit_id")).alias("primary_hit"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("hit_id", "c"))), lambda x: x["c"]), " ").alias("urls"),
    )


@query(f"""SELECT h.source_key, h.hits, s.id AS known_source, s.lifecycle FROM (SELECT source_key, count(*) AS hits FROM {_HIT_KEY} GROUP BY 1) h
  LEFT JOIN (SELECT 'career:' || regexp_extract(lower(source_root_url), '^(https?://[^/?#]+)', 1) AS k, max_by(id, discovered_at) AS id, max_by(lifecycle, discovered_at) AS lifecycle FROM sources WHERE lifecycle = 'approved' GROUP BY 1) s ON s.k = h.source_key""")
def known_candidates(spark, d):
    """Candidate keys against the approved sources; of sources with one key the last discovered counts."""
    keys = table(spark, d, "discovery_hits").select(U.source_identity(U.canonical_url(F.col("url")))["source_key"].alias("source_key")).filter("source_key IS NOT NULL").groupBy("source_key").agg(F.count("*").alias("hits"))
    known = table(spark, d, "sources").filter("lifecycle = 'approved'").select(U.source_identity(U.canonical_url(F.col("source_root_url")))["source_key"].alias("source_key"), "id", "lifecycle", "discovered_at")
    known = R.newest(known, ["source_key"], "discovered_at").select("source_key", F.col("id").alias("known_source"), "lifecycle")
    return keys.join(known, "source_key", "left")


@query(f"""SELECT j.rec_id, starts_with(u, 'https://') AND regexp_extract(u, '^(https?://[^/?#]+)', 1) IN (regexp_extract(lower(s.source_root_url), '^(https?://[^/?#]+)', 1), coalesce(regexp_extract(lower(s.public_api_url), '^(https?://[^/?#]+)', 1), '')) AS owned
  FROM (SELECT rec_id, source_id, {canonical_sql('apply_url')} AS u FROM jobs) j JOIN sources s ON s.id = j.source_id""")
def owned_urls(spark, d):
    """Whether the source of a record may publish its application URL."""
    sources = table(spark, d, "sources").select(F.col("id").alias("source_id"), "source_root_url", "public_api_url", "provider")
    rows = table(spark, d, "jobs").select("rec_id", "source_id", U.canonical_url(F.col("apply_url")).alias("u")).join(sources, "source_id")
    return rows.select("rec_id", U.owns_url(F.col("u"), F.col("source_root_url"), F.col("public_api_url"), F.col("provider"), F.lit(None).cast("string")).alias("owned"))


@query(f"""SELECT rec_id, regexp_matches(last, '^(|apply|careers?|jobs?|openings?|positions?|recruit|recruitment)$') AS generic, regexp_matches(c, '/(jobs?|positions?)/[^/?]+(/detail)?/?$', 'i') OR regexp_matches(c, '/(article/)?[0-9]+\\.s?html$', 'i') AS detail
  FROM (SELECT rec_id, c, regexp_extract(lower(c), '/([^/?]*)(\\?.*)?$', 1) AS last FROM (SELECT rec_id, {canonical_sql('source_url')} AS c FROM jobs))""")
def url_kinds(spark, d):
    """Which source URLs name a list instead of a posting, and which look like the page of one."""
    c = table(spark, d, "jobs").select("rec_id", U.canonical_url(F.col("source_url")).alias("c"))
    return c.select("rec_id", U.is_generic_url(F.col("c")).alias("generic"), U.is_detail_url(F.col("c")).alias("detail"))


@query(f"""SELECT rec_id, 'job-' || substr(sha256(source_id || chr(0) || CASE WHEN coalesce(external_id, '') <> '' THEN external_id ELSE coalesce({canonical_sql('apply_url')}, 'no-explicit-url') || chr(0) || company || chr(0) || title || chr(0) || coalesce(location, '') END), 1, 20) AS stable_id FROM jobs""")
def stable_ids(spark, d):
    """The id of a posting: of its source and external id, or else of its URL, company, title and location."""
    url = F.coalesce(U.canonical_url(F.col("apply_url")), F.lit("no-explicit-url"))
    own = F.concat_ws("\x00", url, F.coalesce("company", F.lit("")), F.coalesce("title", F.lit("")), F.coalesce("location", F.lit("")))
    key = F.when(F.coalesce("external_id", F.lit("")) != "", F.col("external_id")).otherwise(own)
    return table(spark, d, "jobs").select("rec_id", F.concat(F.lit("job-"), F.substring(F.sha2(F.concat("source_id", F.lit("\x00"), key), 256), 1, 20)).alias("stable_id"))


_NAMED = "(SELECT DISTINCT region_code, level_name, province_code, unnest(list_concat([name_zh, name_en, label], aliases)) AS nm FROM regions)"
_ONE_NAME = f"(SELECT nm, min(region_code) AS region_code, min(level_name) AS level_name, min(province_code) AS province_code FROM {_NAMED} GROUP BY nm HAVING count(DISTINCT region_code) = 1)"


def unique_names(regions):
    """``nm, region_code, level_name, province_code`` of the names that only one place has."""
    names = regions.select("region_code", "level_name", "province_code", F.explode(F.concat(F.array("name_zh", "name_en", "label"), "aliases")).alias("nm")).distinct()
    return names.groupBy("nm").agg(F.min("region_code").alias("region_code"), F.min("level_name").alias("level_name"), F.min("province_code").alias("province_code"), F.countDistinct("region_code").alias("m")).filter("m = 1").drop("m")


_IDENTITY = f"""(SELECT j.rec_id, j.id, j.status, j.source_id, j.external_id, j.apply_url, j.source_url, j.authenticity_score, {NORMAL.format('j.company')} AS c, {NORMAL.format('j.title')} AS t, coalesce(p.places, {NORMAL.format('j.location')}) AS l FROM jobs j
  LEFT JOIN (SELECT rec_id, array_to_string(list_sort(list(DISTINCT coalesce(u.province_code, 'CN') || ':' || CASE WHEN u.level_name = 'city' THEN u.region_code ELSE 'ALL' END)), ',') AS places
    FROM (SELECT rec_id, unnest(work_locations_raw) AS v FROM jobs) w JOIN {_ONE_NAME} u ON u.nm = w.v GROUP BY rec_id) p ON p.rec_id = j.rec_id)"""


def with_identity(spark, d):
    """Records with their soft identity: normal company, title, and places (as listed, else as typed)."""
    jobs, names = table(spark, d, "jobs"), unique_names(table(spark, d, "regions"))
    code = F.concat(F.coalesce("province_code", F.lit("CN")), F.lit(":"), F.when(F.col("level_name") == "city", F.col("region_code")).otherwise("ALL"))
    places = jobs.select("rec_id", F.explode("work_locations_raw").alias("nm")).join(F.broadcast(names), "nm").groupBy("rec_id").agg(F.array_join(F.array_sort(F.collect_set(code)), ",").alias("places"))
    columns = ("rec_id", "id", "status", "source_id", "external_id", "apply_url", "source_url", "authenticity_score")
    rows = jobs.select(*columns, "location", X.normal_text(F.col("company")).alias("c"), X.normal_text(F.col("title")).alias("t")).join(places, "rec_id", "left")
    return rows.select(*columns, "c", "t", F.coalesce("places", X.normal_text(F.col("location"))).alias("l"))


@query(f"SELECT c || '|' || t || '|' || l AS identity, count(DISTINCT id) AS ids, array_to_string(list_sort(list(DISTINCT id)), ',') AS members FROM {_IDENTITY} WHERE status <> 'closed' GROUP BY 1 HAVING count(DISTINCT id) > 1")
def soft_duplicate_groups(spark, d):
    """Postings that are open and read alike, place included; for review, never merged."""
    rows = with_identity(spark, d).filter("status <> 'closed'").groupBy(F.concat_ws("|", "c", "t", "l").alias("identity")).agg(F.countDistinct("id").alias("ids"), F.array_join(F.array_sort(F.collect_set("id")), ",").alias("members"))
    return rows.filter("ids > 1")


@query(f"""SELECT source_id, query_id, count(DISTINCT c) AS urls, count(DISTINCT t) AS identities, array_to_string(list_sort(list(DISTINCT hit_id))[1:20], ',') AS sample
  FROM (SELECT hit_id, source_id, query_id, {canonical_sql('url')} AS c, {NORMAL.format('title')} AS t FROM discovery_hits WHERE source_id IS NOT NULL AND query_id <> '') GROUP BY ALL HAVING count(DISTINCT c) > 1 AND count(DISTINCT t) > 1""")
def hit_id_conflicts(spark, d):
    """The conflict rule on hits: one source and query key that stands for different URLs and different titles."""
    hits = table(spark, d, "discovery_hits").select("source_id", "query_id", "hit_id", U.canonical_url(F.col("url")).alias("c"), X.normal_text(F.col("title")).alias("t"))
    return R.key_conflicts(hits, ["source_id", "query_id"], "c", "t", "hit_id")


@query(f"SELECT source_id, external_id, count(DISTINCT u) AS urls, count(DISTINCT c || '|' || t) AS identities, array_to_string(list_sort(list(DISTINCT rec_id))[1:20], ',') AS sample FROM (SELECT *, {canonical_sql('apply_url')} AS u FROM {_IDENTITY}) WHERE external_id <> '' GROUP BY ALL HAVING count(DISTINCT u) > 1 AND count(DISTINCT c || '|' || t) > 1")
def external_id_conflicts(spark, d):
    """External ids of a source that stand for different URLs and different identities."""
    rows = with_identity(spark, d).select("source_id", "external_id", "rec_id", U.canonical_url(F.col("apply_url")).alias("u"), F.concat_ws("|", "c", "t").alias("i"))
    return R.key_conflicts(rows, ["source_id", "external_id"], "u", "i", "rec_id")


@query(f"""WITH g AS (SELECT *, {canonical_sql('apply_url')} AS u FROM {_IDENTITY}), k AS (SELECT *, CASE WHEN l <> '' THEN l ELSE coalesce(min(nullif(l, '')) OVER (PARTITION BY u, c, t), '') END AS place FROM g WHERE u IS NOT NULL AND c <> '' AND t <> '')
  SELECT rec_id AS kept, n AS merged, 'apply:' || u AS merge_key FROM (SELECT rec_id, u, count(*) OVER p AS n, row_number() OVER (PARTITION BY u, c, t, place ORDER BY authenticity_score DESC, rec_id) AS rn FROM k WINDOW p AS (PARTITION BY u, c, t, place)) WHERE rn = 1""")
def exact_merge(spark, d):
    """One record per posting: same canonical URL, company and title and compatible places; the most authentic, the first at a tie.

    A record without a place goes with the first place of its URL, company and
    title, so the merge is an equivalence whatever the order of arrival.
    """
    rows = with_identity(spark, d).withColumn("u", U.canonical_url(F.col("apply_url"))).filter("u IS NOT NULL AND c <> '' AND t <> ''")
    first = rows.filter("l <> ''").groupBy("u", "c", "t").agg(F.min("l").alias("first"))
    placed = rows.join(first, ["u", "c", "t"], "left").withColumn("place", F.when(F.col("l") != "", F.col("l")).otherwise(F.coalesce("first", F.lit(""))))
    best = F.max_by("rec_id", F.struct("authenticity_score", -F.col("rec_id")))
    return placed.groupBy("u", "c", "t", "place").agg(best.alias("kept"), F.count("*").alias("merged")).select("kept", "merged", F.concat(F.lit("apply:"), "u").alias("merge_key"))
