"""Queries on recorded responses: bodies in each format made of all postings, parsed back; robots files; connector expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from millrace.functions import expressions as X
from millrace.functions import robots as B
from millrace.functions import search as S
from millrace.functions import urls as U
from millrace.plans.catalog_base import Catalog
from millrace.plans.identity import NORMAL, canonical_sql
from millrace.sources import feeds, snapshots
from millrace.session import table

CATALOG = Catalog()
query = CATALOG.query


def _escape(c):
    """Text as it stands in a feed."""
    for ch, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(ch), F.lit(name))
    return c


def _responses(spark, d, body, name: str = "jobs", key: str = "rec_id") -> DataFrame:
    rows = table(spark, d, name)
    return rows.select(F.col(key).cast("string").alias("source_id"), F.lit("https://feeds.example/list/page").alias("url"), body(rows).alias("body"))


def _squeezed(c: str) -> str:
    """What plain text becomes of a title: runs of blanks and tabs are one blank, ends are cut."""
    return rf"regexp_replace(regexp_replace({c}, '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g')"


@query(f"SELECT CAST(rec_id AS VARCHAR) AS source_id, {canonical_sql('apply_url')} AS url, {_squeezed('title')} AS title, nullif({_squeezed('published_at')}, '') AS published, CAST(rec_id AS VARCHAR) AS external_id FROM jobs WHERE title NOT LIKE '%<%'")
def feed_postings(spark, d):
    """RSS items of every posting read back."""
    item = lambda r: F.concat(F.lit("<rss><channel><item><title><![CDATA["), _escape(F.col("title")), F.lit("]]></title><link>"), _escape(F.col("apply_url")), F.lit("</link><guid>"), F.col("rec_id").cast("string"), F.lit("</guid><pubDate>"), F.coalesce(_escape(F.col("published_at")), F.lit("")), F.lit("</pubDate></item></channel></rss>"))
    rows = feeds.feed_items(_responses(spark, d, item)).join(table(spark, d, "jobs").filter("NOT title LIKE '%<%'").select(F.col("rec_id").cast("string").alias("source_id")), "source_id", "left_semi")
    return rows.select("source_id", "url", "title", "published", "external_id")


@query("SELECT CAST(rec_id AS VARCHAR) AS source_id, id AS external_id, title, company, coalesce(location, '') AS location, published_at AS published, valid_through FROM jobs")
def json_ld_jobs(spark, d):
    """JobPosting objects, half of them inside a nested graph, read back."""

    def body(_):
        place = F.when(F.col("location").isNotNull(), F.struct(F.struct(F.col("location").alias("addressLocality")).alias("address")))
        posting = F.struct(F.lit("JobPosting").alias("@type"), F.col("id").alias("identifier"), "title", F.struct(F.col("company").alias("name")).alias("hiringOrganization"), F.col("published_at").alias("datePosted"), F.col("valid_through").alias("validThrough"), place.alias("jobLocation"))
        # Escaped as the page would hold it.
        text = _escape(F.to_json(posting))
        nested = F.concat(F.lit('{"@graph":[{"@type":"Thing"},{"@graph":['), text, F.lit("]}]}"))
        return F.concat(F.lit('<html><script type="application/ld+json">'), F.when(F.col("rec_id") % 2 == 0, text).otherwise(nested), F.lit('</script><script type="application/ld+json">{broken</script></html>'))

    got = feeds.json_ld_postings(_responses(spark, d, body))
    return got.select("source_id", "external_id", "title", "company", "location", "published", "valid_through")


@query(f"SELECT CAST(hit_id AS VARCHAR) AS source_id, {canonical_sql('url')} AS url, trim(regexp_replace({_squeezed('title')}, '\\s+', ' ', 'g')) AS title, '2026-03-09' AS published FROM discovery_hits WHERE length(trim(regexp_replace({_squeezed('title')}, '\\s+', ' ', 'g'))) >= 4 AND title NOT LIKE '%<%'")
def listing_links(spark, d):
    """Anchors of list pages made of the hits, with the date that stands beside them; pages also hold a login link and a repeated one."""

    def body(_):
        link = F.concat(F.lit('<a class="x" href="'), _escape(F.col("url")), F.lit('">'), _escape(F.col("title")), F.lit("</a>"))
        return F.concat(F.lit('<title>Jobs</title><a href="/login">sign in to jobs</a><p>'), link, F.lit(" 2026年3月9日</p>"), link)

    whole = table(spark, d, "discovery_hits").filter("NOT title LIKE '%<%'").select(F.col("hit_id").cast("string").alias("source_id"))
    return feeds.html_listing(_responses(spark, d, body, "discovery_hits", "hit_id")).join(whole, "source_id", "left_semi").select("source_id", "url", "title", "published")


@query("SELECT CAST(hit_id AS VARCHAR) AS source_id, 'Jobs' AS title, 'https://feeds.example/feed.xml' AS feeds, 'https://feeds.example/list/sitemap.xml' AS sitemaps, true AS recruitment, snippet LIKE '%验证码%' AS login FROM discovery_hits WHERE snippet IS NOT NULL")
def page_signals(spark, d):
    """Title, feeds, sitemaps, words of recruitment and login of pages made of the snippets."""
    head = '<title> Jobs </title><link rel="alternate" type="application/rss+xml" href="/feed.xml"/><link rel="x" href="sitemap.xml?utm_source=a"/><p>'
    got = feeds.page_signals(_responses(spark, d, lambda _: F.concat(F.lit(head), F.col("snippet")), "discovery_hits", "hit_id"))
    return got.select("source_id", "title", F.array_join("feeds", " ").alias("feeds"), F.array_join("sitemaps", " ").alias("sitemaps"), "recruitment", "login")


@query("SELECT CAST(rec_id AS VARCHAR) AS source_id, external_id, nullif(title, '') AS title, nullif(company, '') AS company, nullif(location, '') AS location, apply_url AS url, nullif(published_at, '') AS published FROM jobs")
def json_postings(spark, d):
    """JSON payloads of three shapes, by record, read back through one table of paths."""

    def body(_):
        row = lambda *c: F.to_json(F.struct(*c))
        lever = row(F.col("external_id").alias("id"), F.col("title").alias("text"), F.col("company").alias("company"), F.struct("location").alias("categories"), F.col("apply_url").alias("hostedUrl"), F.col("published_at").alias("publishedAt"))
        board = row(F.col("external_id").alias("id"), "title", "company", F.struct(F.col("location").alias("name")).alias("location"), F.col("apply_url").alias("absolute_url"), F.col("published_at").alias("updated_at"))
        public = row(F.col("external_id").alias("jobId"), F.col("title").alias("jobName"), F.col("company").alias("companyName"), F.col("location").alias("areaName"), F.col("apply_url").alias("url"), F.col("published_at").alias("publishDate"))
        kind = F.col("rec_id") % 3
        return F.when(kind == 0, F.concat(F.lit("["), lever, F.lit("]"))).when(kind == 1, F.concat(F.lit('{"jobs":['), board, F.lit("]}"))).otherwise(F.concat(F.lit('{"data":{"count":1,"list":['), public, F.lit("]}}")))

    return feeds.postings(_responses(spark, d, body)).select("source_id", "external_id", "title", "company", "location", "url", "published")


_FORMATS = (
    ("a", '{"total":7,"jobs":[]}', None, "json", 7, 5), ("b", " [1,2]", None, "json", None, 2), ("c", '{"data":{"count":null,"total":3}}', "text/html", "json", 3, 6), ("d", "{broken", "application/json", "invalid_json", None, 1),
    ("e", '<?xml version="1.0"?><rss/>', None, "xml", None, 0), ("f", "<html>{}</html>", None, "html", None, 1), ("g", "", "text/xml", "xml", None, 0), ("h", '{"a":"[{,:\\\\\\"","total":-1}', None, "json", None, 4),
)


def _lit(v) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"


@query("SELECT * FROM (VALUES " + ", ".join(f"({_lit(k)}, {_lit(f)}, CAST({_lit(t)} AS BIGINT), CAST({_lit(n)} AS BIGINT))" for k, _, _, f, t, n in _FORMATS) + ") t(k, format, total, tokens)")
def payload_formats(spark, d):
    """Format, advertised total and structure of bodies of every kind; the SQL states the expected ones."""
    rows = spark.createDataFrame([(k, b, c) for k, b, c, *_ in _FORMATS], "k string, body string, content_type string")
    return rows.select("k", feeds.payload_format(F.col("body"), F.col("content_type")).alias("format"), feeds.advertised_total(F.col("body")).alias("total"), feeds.structural_tokens(F.col("body")).cast("long").alias("tokens"))


_RULES = "User-agent: crawl\\nUser-Agent: MILLRACE\\nDisallow: /closed\\nAllow: /closed/open$\\nDisallow: /*.zip$\\nDisallow: /a*b*c\\n\\nUser-agent: *\\nDisallow: /\\nSitemap: https://x.example/map.xml"
_FETCHES = (
    (200, _RULES, "/closed/door", False, "robots_disallowed"), (200, _RULES, "/closed/open", True, "robots_allowed"), (200, _RULES, "/closed/open/er", False, "robots_disallowed"), (200, _RULES, "/x/file.zip", False, "robots_disallowed"), (200, _RULES, "/x/file.zip?q", True, "robots_allowed"),
    (200, _RULES, "/axxbyyc/z", False, "robots_disallowed"), (200, _RULES, "/axxcyyb", True, "robots_allowed"), (200, "User-agent: other\\nDisallow: /", "/x", True, "robots_allowed"), (200, "", "/x", True, "robots_allowed"), (404, None, "/x", True, "robots_absent"), (410, _RULES, "/closed", True, "robots_absent"),
    (503, None, "/x", False, "robots_unavailable_fail_closed"), (200, "User-agent: *\\nDisallow: /x\\nAllow: /x", "/x", True, "robots_allowed"), (200, "User-agent: *\\nDisallow:", "/x", True, "robots_allowed"), (200, "User-agent: *\\nDisallow: /" + "*" * 129, "/x", False, "robots_disallowed"),
)


@query("SELECT * FROM (VALUES " + ", ".join(f"({i}::BIGINT, {str(a).lower()}, '{r}')" for i, (*_, a, r) in enumerate(_FETCHES)) + ") t(k, allowed, reason)")
def robots_decisions(spark, d):
    """What fetched robots files allow; the SQL states the expected decisions."""
    rows = spark.createDataFrame([(i, s, t and t.replace("\\n", "\n"), p) for i, (s, t, p, *_) in enumerate(_FETCHES)], "k long, status int, robots string, path string")
    got = rows.withColumn("r", B.robots_decision(F.col("status"), F.col("robots"), F.col("path"), "Millrace/1.0 (test)"))
    return got.select("k", "r.allowed", "r.reason")


@query(r"SELECT rec_id, NOT contains(u, '/j/0-1') OR contains(u, '/j/0-1') AND contains(u, '0-11') AS allowed FROM (SELECT rec_id, regexp_extract(apply_url, '^https?://[^/]+(.*)$', 1) AS u FROM jobs)")
def robots_over_jobs(spark, d):
    """One file's rules applied to the paths of all postings."""
    rules = "User-agent: *\nDisallow: /*/j/0-1\nAllow: /*/j/*0-11"
    return table(spark, d, "jobs").select("rec_id", B.robots_allow(F.lit(rules), F.regexp_extract("apply_url", "^https?://[^/]+(.*)$", 1)).alias("allowed"))


@query("SELECT hit_id, 2 * length(query_text) - length(regexp_replace(query_text, '[^\\x00-\\x7f]', '', 'g')) AS units, CASE WHEN regexp_matches(title, '[^ ]') THEN regexp_extract(query_text, '^(.*)$', 1) END IS NOT NULL AS titled, regexp_extract(url, '^https?://([^/]+)', 1) || '/*' AS pattern FROM discovery_hits")
def query_lengths(spark, d):
    """Query lengths with wide signs counted twice, and the site pattern of each hit's host."""
    term = F.concat(F.lit("jobs site:https://"), F.regexp_extract("url", "^https?://([^/]+)", 1), F.lit("/"))
    return table(spark, d, "discovery_hits").select("hit_id", S.query_units(F.col("query_text")).cast("long").alias("units"), F.col("title").rlike("[^ ]").alias("titled"), S.site_pattern(term).alias("pattern"))


@query("""WITH c AS (SELECT hit_id, unnest(string_split(trim(title), '')) AS ch, unnest(range(1, length(trim(title)) + 1)) AS i FROM discovery_hits), s AS (SELECT hit_id, i, ch, sum(CASE WHEN regexp_matches(ch, '[^\\x00-\\x7f]') THEN 2 ELSE 1 END) OVER (PARTITION BY hit_id ORDER BY i) AS u FROM c)
  SELECT h.hit_id, trim(coalesce((SELECT string_agg(ch, '' ORDER BY i) FROM s WHERE s.hit_id = h.hit_id AND u <= 24), '')) AS shortened, replace(h.snippet, h.query_id, '[REDACTED]') AS redacted FROM discovery_hits h""")
def shortened_queries(spark, d):
    """Titles cut to the units of a query, and snippets without a secret."""
    rows = table(spark, d, "discovery_hits")
    return rows.select("hit_id", S.truncate_query(F.col("title"), 24).alias("shortened"), F.replace("snippet", F.col("query_id"), F.lit("[REDACTED]")).alias("redacted"))


@query("SELECT sha256(description) AS hash, strlen(description) AS bytes, count(*) AS observations, count(DISTINCT source_id) AS sources FROM jobs WHERE description IS NOT NULL GROUP BY ALL")
def artifact_store(spark, d):
    """Every body once under its digest, verified, with its observations."""
    responses = table(spark, d, "jobs").select("source_id", F.col("source_url").alias("url"), F.col("description").alias("body"))
    stored, seen = snapshots.artifacts(responses)
    counts = seen.groupBy("hash").agg(F.count("*").alias("observations"), F.countDistinct("source_id").alias("sources"))
    return snapshots.intact(stored).select("hash", "bytes").join(counts, "hash")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY observed_at, rec_id) - 1 AS n FROM jobs), p AS (SELECT source_id, n // 50 AS page, count(*) AS rows_, sum(coalesce(strlen(description), 0)) AS bytes, string_agg(content_hash, ',' ORDER BY n) AS sig FROM r GROUP BY ALL),
  g AS (SELECT *, page + 1 AS pages, sum(rows_) OVER w AS total_rows, CAST(sum(bytes) OVER w AS BIGINT) AS total_bytes, sig = lag(sig) OVER w AS repeated FROM p WINDOW w AS (PARTITION BY source_id ORDER BY page))
  SELECT source_id, page, CAST(total_rows AS BIGINT) AS total_rows, total_bytes, CASE WHEN coalesce(repeated, false) THEN 'repeated_page_guard' WHEN total_bytes > 200000 THEN 'byte_budget_reached' WHEN pages >= 5 THEN 'page_limit_reached' WHEN rows_ < 50 THEN 'short_terminal_page' ELSE 'next' END AS stop_reason FROM g""")
def page_guards(spark, d):
    """Where a paged collection stops: repeated page, byte budget, page limit or a short last page."""
    n = F.row_number().over(W.partitionBy("source_id").orderBy("observed_at", "rec_id")) - 1
    rows = table(spark, d, "jobs").select("source_id", "content_hash", F.coalesce(F.octet_length("description"), F.lit(0)).alias("b"), n.alias("n")).withColumn("page", F.floor(F.col("n") / 50))
    pages = rows.groupBy("source_id", "page").agg(F.count("*").alias("rows"), F.sum("b").alias("bytes"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "content_hash"))), lambda x: x["content_hash"]), ","), 256).alias("sig"))
    w = W.partitionBy("source_id").orderBy("page")
    total = pages.select("source_id", "page", "rows", F.sum("rows").over(w).alias("total_rows"), F.sum("bytes").over(w).alias("total_bytes"), F.coalesce(F.lag("sig").over(w) == F.col("sig"), F.lit(False)).alias("repeated"))
    reason = F.when(F.col("repeated"), "repeated_page_guard").when(F.col("total_bytes") > 200_000, "byte_budget_reached").when(F.col("page") + 1 >= 5, "page_limit_reached").when(F.col("rows") < 50, "short_terminal_page").otherwise("next")
    return total.select("source_id", "page", "total_rows", "total_bytes", reason.alias("stop_reason"))


_KEYS = f"(SELECT DISTINCT id, {NORMAL.format('k')} AS key FROM (SELECT id, unnest(list_concat([name], coalesce(aliases, []))) AS k FROM employer_targets) WHERE {NORMAL.format('k')} <> '')"


@query(f"""WITH p AS (SELECT DISTINCT a.id AS a, b.id AS b FROM {_KEYS} a JOIN {_KEYS} b ON a.key = b.key) SELECT p.a AS target_id, min(p.b) AS group_id, count(*) - 1 AS others,
  EXISTS (SELECT 1 FROM p x JOIN p y ON y.a = x.a AND x.a = p.a AND x.b < y.b AND x.b <> p.a AND y.b <> p.a WHERE NOT EXISTS (SELECT 1 FROM p z WHERE z.a = x.b AND z.b = y.b)) AS bridges FROM p GROUP BY p.a""")
def employer_merge(spark, d):
    """Listed employers that share a name or an alias; one that joins two others which share none bridges them, which is an error."""
    names = F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))))
    keys = table(spark, d, "employer_targets").select("id", names.alias("k")).select("id", X.normal_text(F.col("k")).alias("key")).filter("key <> ''").distinct()
    pairs = keys.withColumnRenamed("id", "a").join(keys.withColumnRenamed("id", "b"), "key").select("a", "b").distinct()
    groups = pairs.groupBy("a").agg(F.min("b").alias("group_id"), (F.count("*") - 1).alias("others"))
    around = pairs.filter("a <> b")
    apart = around.join(around.withColumnRenamed("b", "c"), "a").filter("b < c").join(pairs.select(F.col("a").alias("b"), F.col("b").alias("c")), ["b", "c"], "left_anti").select("a").distinct().withColumn("bridges", F.lit(True))
    return groups.join(apart, "a", "left").select(F.col("a").alias("target_id"), "group_id", "others", F.coalesce("bridges", F.lit(False)).alias("bridges"))


@query("SELECT id AS target_id FROM employer_targets WHERE len(official_domains) > 0 AND NOT EXISTS (SELECT 1 FROM sources WHERE list_contains(official_domains, regexp_extract(lower(source_root_url), '^https?://([^/?#:@]+)', 1)))")
def catalog_gaps(spark, d):
    """Employers none of whose hosts the catalogue of sources has."""
    hosts = table(spark, d, "sources").select(U.host(F.col("source_root_url")).alias("host"))
    domains = table(spark, d, "employer_targets").select(F.col("id").alias("target_id"), F.explode("official_domains").alias("host"))
    known = domains.join(F.broadcast(hosts), "host", "left_semi").select("target_id").distinct()
    return domains.select("target_id").distinct().join(known, "target_id", "left_anti")


@query("SELECT id, '| ' || replace(replace(name, '|', '\\|'), chr(10), ' ') || ' | ' || lifecycle || ' | ' || coalesce(provider, '-') || ' |' AS line FROM sources")
def report_lines(spark, d):
    """The lines of a report table, cells escaped."""
    cell = F.replace(F.replace("name", F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))
    return table(spark, d, "sources").select("id", F.concat(F.lit("| "), cell, F.lit(" | "), "lifecycle", F.lit(" | "), F.coalesce("provider", F.lit("-")), F.lit(" |")).alias("line"))
