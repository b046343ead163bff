"""Parsers of recorded responses, one row per posting or link.

Input is a table of responses (``source_id, url, body``); each parser explodes
the body with built-in expressions, so no body leaves the JVM.  Null, empty and
broken bodies give no rows; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.urls import canonical_url

# Words of recruitment, and of pages behind a login.
RECRUITMENT = r"(?i)招聘|岗位|职位|招考|录用|career|job|hiring|position|opening"
LOGIN = r"(?i)/login(?:/|$)|/signin(?:/|$)|验证码|仅限登录|付费墙"
# Where payloads keep their rows and their totals, in order.
ROW_PATHS = ("$", "$.jobs", "$.data.jobs", "$.data.job_post_list", "$.data.list", "$.data.records", "$.result.jobs", "$.result.list", "$.returnData.tblb", "$.rows")
TOTAL_PATHS = ("$.total", "$.totalCount", "$.data.count", "$.data.total", "$.data.totalCount", "$.result.total", "$.returnData.total")
# Limits of one body.
MAX_ROWS, MAX_TOKENS, MAX_FEED, MAX_LISTING, MAX_SITEMAPS, MAX_LINKS = 5_000, 250_000, 500, 200, 50, 50


def _element(block: Column, tag: str) -> Column:
    """Text of the first element ``tag``, CDATA unwrapped, null if missing or empty."""
    raw = F.regexp_extract(block, rf"(?is)<(?:\w+:)?{tag}(?:\s[^>]*)?>(.*?)</(?:\w+:)?{tag}>", 1)
    text = plain_text(F.regexp_replace(raw, r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1"))
    return F.when(text != "", text)


def decode_entities(text: Column) -> Column:
    t = text
    for name, ch in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&quot;", '"'), ("&(?:#39|apos);", "'"), ("&nbsp;", " ")):
        t = F.regexp_replace(t, f"(?i){name}", ch)
    return t


def plain_text(html: Column) -> Column:
    """Entities decoded, then a blank for each tag; breaks and ends of blocks become lines."""
    t = F.regexp_replace(F.regexp_replace(decode_entities(html), r"(?i)<br\s*/?\s*>|</(?:p|li|h\d|div)>", "\n"), r"<[^>]+>", " ")
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"\r", ""), r"[ \t]+", " "), r"\n\s+", "\n")
    return F.regexp_replace(t, r"^\s+|\s+$", "")


def compact(text: Column, most: int = 900) -> Column:
    """Plain text cut to ``most`` characters, with a mark if it was longer."""
    plain = plain_text(text)
    return F.when(F.length(plain) > most, F.concat(F.rtrim(F.substring(plain, 1, most)), F.lit("…"))).otherwise(plain)


def _resolve(href: Column, base: Column) -> Column:
    """An absolute address; relative ones from the base's origin or folder."""
    root = F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"^(https?://[^/]+(?:/.*)?)/[^/]*$", "$1")
    absolute = F.when(href.rlike(r"(?i)^[a-z][a-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(F.regexp_extract(base, "^(https?:)", 1), href)).when(href.startswith("/"), F.concat(root, href))
    return F.coalesce(absolute, F.concat(folder, F.lit("/"), href))


def _first_by_url(rows: DataFrame, most: int) -> DataFrame:
    """The first row of each address and body, ``most`` of a body."""
    first = rows.groupBy("source_id", "body_id", "url").agg(F.min_by(F.struct(*[c for c in rows.columns if c not in ("source_id", "body_id", "url")]), "pos").alias("r"))
    packed = first.groupBy("source_id", "body_id").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.col("r.pos").alias("pos"), "url", "r"))), 1, most).alias("p"))
    return packed.select("source_id", F.explode("p").alias("p")).select("source_id", "p.url", "p.r.*")


def _bodies(responses: DataFrame) -> DataFrame:
    return responses.filter(F.length("body") > 0).select("source_id", "url", "body", F.xxhash64("source_id", "url", "body").alias("body_id"))


def feed_items(responses: DataFrame) -> DataFrame:
    """RSS items and Atom entries that speak of jobs: ``source_id, url, pos, title, published, summary, external_id``."""
    blocks = F.regexp_extract_all("body", F.lit(r"(?is)<(item|entry)(?:\s[^>]*)?>.*?</\1>"), F.lit(0))
    rows = _bodies(responses).select("source_id", "body_id", F.col("url").alias("base"), F.posexplode(blocks).alias("pos", "b"))
    b = F.col("b")
    href = F.nullif(F.regexp_extract(b, r"""(?is)<link\b[^>]*\bhref\s*=\s*["']([^"']+)["']""", 1), F.lit(""))
    link = canonical_url(_resolve(F.coalesce(href, _element(b, "link")), F.col("base")))
    got = rows.select("source_id", "body_id", "pos", link.alias("url"), _element(b, "title").alias("title"), F.coalesce(_element(b, "pubDate"), _element(b, "published"), _element(b, "updated")).alias("published"), F.coalesce(_element(b, "description"), _element(b, "summary"), _element(b, "content")).alias("summary"), F.coalesce(_element(b, "guid"), _element(b, "id")).alias("external_id"))
    said = F.concat_ws(" ", "title", "summary", "url").rlike(RECRUITMENT)
    return _first_by_url(got.filter(F.col("url").isNotNull() & said), MAX_FEED).withColumn("external_id", F.coalesce("external_id", "url"))


def sitemap_urls(responses: DataFrame) -> DataFrame:
    """``source_id, kind, loc``: kind is ``index`` for child sitemaps, ``url`` for pages; both bounded per body."""
    kind = F.when(F.col("body").rlike(r"(?i)<sitemapindex"), "index").otherwise("url")
    locs = F.regexp_extract_all("body", F.lit(r"(?is)<loc>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</loc>"), F.lit(1))
    rows = _bodies(responses).select("source_id", F.col("url").alias("base"), kind.alias("kind"), F.explode(F.slice(F.array_distinct(locs), F.lit(1), F.when(kind == "index", MAX_SITEMAPS).otherwise(MAX_FEED))).alias("l"))
    return rows.select("source_id", "kind", canonical_url(_resolve(decode_entities(F.col("l")), F.col("base"))).alias("loc")).filter("loc IS NOT NULL")


def json_ld_postings(responses: DataFrame) -> DataFrame:
    """JobPosting objects of ld+json scripts: at the top, in a list, or in ``@graph`` up to two levels deep; broken scripts give none."""
    scripts = F.regexp_extract_all("body", F.lit(r"""(?is)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1))
    parsed = _bodies(responses).select("source_id", F.col("url").alias("base"), F.explode(scripts).alias("s")).select("source_id", "base", F.try_parse_json(decode_entities(F.col("s"))).alias("v")).filter("v IS NOT NULL")
    many = lambda v, path: F.coalesce(F.try_variant_get(v, path, "array<variant>"), F.array().cast("array<variant>"))
    top = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    below = lambda vs: F.concat(vs, F.flatten(F.transform(vs, lambda v: many(v, "$['@graph']"))))
    level1 = parsed.select("source_id", "base", below(top).alias("vs"))
    inner = F.flatten(F.transform(F.slice("vs", 1, MAX_ROWS), lambda v: many(v, "$['@graph']")))
    objects = level1.select("source_id", "base", F.explode(F.concat("vs", F.flatten(F.transform(inner, lambda v: many(v, "$['@graph']"))))).alias("v"))
    get = lambda path: F.try_variant_get("v", path, "string")
    kinds = F.coalesce(F.try_variant_get("v", "$['@type']", "array<string>"), F.array(get("$['@type']")))
    places = F.coalesce(F.try_variant_get("v", "$.jobLocation", "array<variant>"), F.filter(F.array(F.try_variant_get("v", "$.jobLocation", "variant")), lambda x: x.isNotNull()))
    place = lambda p: F.coalesce(F.nullif(F.concat_ws(", ", *[F.try_variant_get(p, f"$.address.{k}", "string") for k in ("addressLocality", "addressRegion", "addressCountry")]), F.lit("")), F.try_variant_get(p, "$.name", "string"))
    listed = F.filter(F.transform(places, place), lambda x: x.isNotNull())
    url = F.coalesce(get("$.url"), get("$.sameAs"))
    return objects.filter(F.exists(kinds, lambda k: F.lower(k) == "jobposting")).select(
        "source_id",
        F.coalesce(get("$.identifier.value"), get("$.identifier"), get("$['@id']")).alias("external_id"),
        F.coalesce(get("$.title"), get("$.name")).alias("title"),
        get("$.hiringOrganization.name").alias("company"),
        F.array_join(listed, " · ").alias("location"),
        get("$.datePosted").alias("published"),
        get("$.validThrough").alias("valid_through"),
        get("$.description").alias("description"),
        _resolve(F.coalesce(url, F.col("base")), F.col("base")).alias("url"),
        url.isNull().alias("url_is_fallback"),
    )


def page_links(responses: DataFrame) -> DataFrame:
    """Anchors of HTML pages: ``source_id, url, pos, text, published``, the date found within 120 characters around; each address once per page."""
    parts = _bodies(responses).select("source_id", "body_id", F.col("url").alias("base"), F.split("body", r"(?i)<a\b").alias("p"))
    rows = parts.filter(F.size("p") > 1).select("source_id", "body_id", "base", "p", F.posexplode("p").alias("pos", "b")).filter("pos > 0")
    before = F.element_at("p", F.col("pos"))
    href = F.regexp_extract("b", r"""(?is)^[^>]*\bhref\s*=\s*["']([^"']*)["']""", 1)
    inside, after = F.regexp_extract("b", r"(?is)^[^>]*>(.*?)</a>", 1), F.regexp_extract("b", r"(?is)</a>(.{0,120})", 1)
    around = plain_text(F.concat(F.expr("right(element_at(p, pos), 120)"), F.lit(" "), inside, F.lit(" "), after))
    stamp = lambda i: F.lpad(F.regexp_extract("around", r"(20\d{2})[-/.年](\d{1,2})[-/.月](\d{1,2})", i), 2, "0")
    got = rows.filter(before.isNotNull() & (href != "")).select("source_id", "body_id", "pos", canonical_url(_resolve(decode_entities(href), F.col("base"))).alias("url"), F.regexp_replace(plain_text(inside), r"\s+", " ").alias("text"), around.alias("around"))
    year = F.regexp_extract("around", r"(20\d{2})[-/.年]\d{1,2}[-/.月]\d{1,2}", 1)
    dated = got.withColumn("published", F.when(year != "", F.concat_ws("-", year, stamp(2), stamp(3)))).drop("around")
    return _first_by_url(dated.filter("url IS NOT NULL"), MAX_ROWS)


def html_listing(responses: DataFrame) -> DataFrame:
    """Links that read like postings, at most ``MAX_LISTING`` of a page: four characters at least, words of recruitment, no login."""
    links = page_links(responses)
    kept = links.filter((F.length("text") >= 4) & F.concat_ws(" ", "text", "url").rlike(RECRUITMENT) & ~F.col("url").rlike("(?i)login|signin"))
    return kept.select("source_id", "url", "pos", F.col("text").alias("title"), "published")


def page_signals(responses: DataFrame) -> DataFrame:
    """``source_id, title, feeds, sitemaps, recruitment, login`` of HTML pages."""
    heads = F.regexp_extract_all("body", F.lit(r"(?is)<link\b[^>]*>"), F.lit(0))
    href = lambda t: F.regexp_extract(t, r"""(?is)\bhref\s*=\s*["']([^"']*)["']""", 1)
    feed = lambda t: t.rlike(r"""(?i)\btype\s*=\s*["'][^"']*(?:rss|atom)""") | (t.rlike(r"""(?i)\brel\s*=\s*["'][^"']*alternate""") & href(t).contains("feed"))
    address = lambda ts: F.array_sort(F.array_distinct(F.filter(F.transform(ts, lambda t: canonical_url(_resolve(href(t), F.col("url")))), lambda u: u.isNotNull())))
    title = plain_text(F.regexp_extract("body", r"(?is)<title\b[^>]*>(.*?)</title>", 1))
    text = F.concat_ws(" ", title, plain_text(F.col("body")))
    rows = _bodies(responses).withColumn("_heads", heads)
    return rows.select("source_id", title.alias("title"), address(F.filter("_heads", feed)).alias("feeds"), address(F.filter("_heads", lambda t: ~feed(t) & href(t).rlike("(?i)sitemap"))).alias("sitemaps"), text.rlike(RECRUITMENT).alias("recruitment"), text.rlike(LOGIN).alias("login"))


def ndjson_rows(responses: DataFrame, most: int | None = None) -> DataFrame:
    """``source_id, line, v``: one variant per non-blank line; a broken line, or more than ``most`` rows, is an error that names it."""
    lines = responses.select("source_id", F.posexplode(F.split("body", r"\r?\n")).alias("pos", "s"), F.size(F.filter(F.split("body", r"\r?\n"), lambda x: F.trim(x) != "")).alias("n")).filter(F.trim("s") != "")
    parsed = F.try_parse_json("s")
    number = F.col("pos") + 1
    row = F.when(parsed.isNotNull(), parsed).otherwise(F.raise_error(F.concat(F.lit("broken JSON on line "), number.cast("string"))))
    if most is not None:
        row = F.when(F.col("n") > most, F.raise_error(F.lit(f"more than {most} rows")).cast("variant")).otherwise(row)
    return lines.select("source_id", number.alias("line"), row.alias("v"))


def structural_tokens(body: Column) -> Column:
    """Braces, brackets, commas and colons of a JSON text outside its strings."""
    return F.regexp_count(F.regexp_replace(body, r'"(?:[^"\\]|\\.)*+"?', '""'), F.lit(r"[{\[,:]"))


def payload_format(body: Column, content_type: Column) -> Column:
    """``json``, ``invalid_json``, ``over_budget``, ``xml`` or ``html``, by content type and first sign."""
    text = F.coalesce(body, F.lit(""))
    json = F.coalesce(content_type.rlike("(?i)json"), F.lit(False)) | text.rlike(r"^\s*[\[{]")
    xml = F.coalesce(content_type.rlike("(?i)xml"), F.lit(False)) | text.rlike(r"(?i)^\s*<(?:\?xml|(?:rss|feed|urlset|sitemapindex)\b)")
    kind = F.when(structural_tokens(text) > MAX_TOKENS, "over_budget").when(F.try_parse_json(text).isNull(), "invalid_json").otherwise("json")
    return F.when(json, kind).when(xml, "xml").otherwise("html")


def payload_rows(responses: DataFrame) -> DataFrame:
    """``source_id, row_no, v`` of JSON payloads: the first of the known places that holds a list; more than ``MAX_ROWS`` give none."""
    v = F.try_parse_json("body")
    lists = F.coalesce(*[F.try_variant_get("_v", path, "array<variant>") for path in ROW_PATHS])
    rows = responses.filter(structural_tokens(F.col("body")) <= MAX_TOKENS).select("source_id", v.alias("_v")).select("source_id", lists.alias("_r")).filter(F.size("_r") <= MAX_ROWS)
    return rows.select("source_id", F.posexplode("_r").alias("row_no", "v"))


def advertised_total(body: Column) -> Column:
    """The first number not below zero that a payload gives as its total; null is no number."""
    v = F.try_parse_json(body)
    return F.coalesce(*[F.when(n >= 0, n) for n in (F.try_variant_get(v, path, "bigint") for path in TOTAL_PATHS)])


def postings(responses: DataFrame) -> DataFrame:
    """``source_id, external_id, title, company, location, url, published, description`` of JSON payloads of any known shape."""
    rows = payload_rows(responses)

    def scalar(path: str) -> Column:
        """A text or number, null for objects and lists."""
        kind = F.schema_of_variant(F.try_variant_get("v", f"$.{path}", "variant"))
        return F.when(~kind.rlike("^(?:OBJECT|ARRAY|VOID)"), F.nullif(F.try_variant_get("v", f"$.{path}", "string"), F.lit("")))

    get = lambda *paths: F.coalesce(*map(scalar, paths))
    return rows.select(
        "source_id",
        get("id", "jobId", "externalId", "code").alias("external_id"),
        get("title", "text", "jobName", "name", "position").alias("title"),
        get("company", "companyName", "employer").alias("company"),
        get("location.name", "location", "categories.location", "areaName", "city_info.name", "city").alias("location"),
        get("hostedUrl", "absolute_url", "jobUrl", "applyUrl", "url", "link").alias("url"),
        get("publishedAt", "updated_at", "publishDate", "createdAt").alias("published"),
        get("descriptionPlain", "description", "content").alias("description"),
    )
