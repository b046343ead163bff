"""URLs as columns: parts, canonical form, private hosts, identities. All built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.expressions import let

# Query parameters that only track (besides utm_*).
TRACKING = ("fbclid", "from", "gh_src", "gclid", "lever-source", "ref", "referrer", "source", "spm")
# IPv4 networks that no public source lives in, with their prefix lengths.
PRIVATE_V4 = (
    ("0.0.0.0", 8), ("10.0.0.0", 8), ("100.64.0.0", 10), ("127.0.0.0", 8), ("169.254.0.0", 16), ("172.16.0.0", 12), ("192.0.0.0", 24), ("192.0.2.0", 24),
    ("192.88.99.0", 24), ("192.168.0.0", 16), ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24), ("224.0.0.0", 4), ("240.0.0.0", 4),
)
# The same of IPv6, as patterns on the 32 hex digits (::/96, 64:ff9b::/96, 64:ff9b:1::/48, 100::/64, 2001::/32, 2001:db8::/32, 2002::/16, fc00::/7, fec0::/10, fe80::/10, ff00::/8).
PRIVATE_V6 = "^(?:0{24}|0064ff9b0{16}|0064ff9b0001|01000{12}|20010000|20010db8|2002|f[cd]|fe[89a-f]|ff)"
# Last path segments and query keys that do or don't name one posting.
GENERIC_SEGMENTS = ("", "apply", "career", "careers", "job", "jobs", "opening", "openings", "position", "positions", "recruit", "recruitment")
POSTING_KEY = r"(?i)(?:^|_)(?:id|jobid|job_id|jid|positionid|position_id|zpgwid)$"

_URL = r"(?i)^(https?)://([^/?#]*)([^?#]*)(\?[^#]*)?(?:#.*)?$"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _URL, group)


def _nonempty(c: Column) -> Column:
    return F.when(c != "", c)


def _trimmed(url: Column) -> Column:
    return F.regexp_replace(url, r"^[\s\x00]+|[\s\x00]+$", "")


def host(url: Column) -> Column:
    """Lower-cased host of an http(s) URL without credentials, else null."""
    return _nonempty(F.lower(F.regexp_extract(_part(_trimmed(url), 2), r"^(\[[^\]@]*\]|[^:@\[\]]+)(?::\d*)?$", 1)))


def _v4(text: Column) -> Column:
    """A dotted quad as a number, else null."""
    ok = text.rlike(r"^(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)$")
    digits = F.transform(F.split(text, r"\."), lambda d: d.try_cast("long"))
    return F.when(ok, F.aggregate(digits, F.lit(0).cast("long"), lambda a, d: a * 256 + d))


def _private_v4(number: Column) -> Column:
    out = F.lit(False)
    for network, bits in PRIVATE_V4:
        first = sum(int(x) << s for x, s in zip(network.split("."), (24, 16, 8, 0)))
        out = out | number.between(first, first + (1 << (32 - bits)) - 1)
    return out


def _hex32(text: Column) -> Column:
    """An IPv6 address as 32 hex digits, else null; a dotted tail counts as two groups."""
    quad = _v4(F.regexp_extract(text, r":(\d+\.\d+\.\d+\.\d+)$", 1))
    tail = F.concat(F.hex(F.shiftright(quad, 16)), F.lit(":"), F.hex(quad.bitwiseAND(0xFFFF)))
    plain = F.when(quad.isNull(), text).otherwise(F.concat(F.regexp_extract(text, r"^(.*:)\d+\.\d+\.\d+\.\d+$", 1), tail))

    def expand(p: Column) -> Column:
        groups = lambda s: F.filter(F.split(s, ":"), lambda g: g != "")
        sides = F.struct(groups(F.substring_index(p, "::", 1)).alias("l"), F.when(p.contains("::"), groups(F.substring_index(p, "::", -1))).otherwise(F.array().cast("array<string>")).alias("r"))
        sound = p.rlike("^[0-9A-Fa-f:]*$") & p.rlike(":.*:") & ~p.rlike("::.*::|:::")

        def join(x: Column) -> Column:
            missing = 8 - F.size(x["l"]) - F.size(x["r"])
            whole = F.concat(x["l"], F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), x["r"])
            ok = sound & F.forall(whole, lambda g: F.length(g) <= 4) & F.when(p.contains("::"), missing >= 1).otherwise(missing == 0)
            return F.when(ok, F.lower(F.array_join(F.transform(whole, lambda g: F.lpad(g, 4, "0")), "")))

        return let(sides, join)

    return let(plain, expand)


def is_private_host(hostname: Column) -> Column:
    """Local names and private, reserved and documentation networks; IPv4 mapped into IPv6 counts as IPv4; null and '' are private."""
    bare = F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(hostname, F.lit("")), r"^\[|\]$", ""), r"\.+$", ""))

    def by_digits(h: Column, digits: Column) -> Column:
        mapped = F.when(digits.startswith("0" * 20 + "ffff"), F.conv(F.substring(digits, 25, 8), 16, 10).cast("long"))
        return F.coalesce(let(F.coalesce(_v4(h), mapped), _private_v4), digits.rlike(PRIVATE_V6), F.lit(False))

    local = lambda h: (h == "") | h.rlike(r"^(?:.*\.)?(?:localhost|local)$")
    return let(bare, lambda h: local(h) | let(F.when(h.contains(":"), _hex32(h)), lambda d: by_digits(h, d)))


def _decoded(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def parameters(url: Column) -> Column:
    """Query parameters as ``array<struct<k, v>>``, decoded."""
    pairs = F.filter(F.split(F.regexp_replace(_part(url, 4), r"^\?", ""), "&"), lambda p: p != "")
    return F.transform(pairs, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.when(p.contains("="), F.regexp_replace(p, "^[^=]*=", "")).otherwise("")).alias("v")))


def canonical_url(url: Column) -> Column:
    """The canonical form of an http(s) URL; null for other schemes, credentials and private hosts.

    Scheme and host in lower case, no default port and fragment, no doubled
    slashes and no trailing one but the root's, no tracking parameters, the
    others sorted by key and value and encoded alike.  Sorting is by code point.
    """

    def build(u: Column) -> Column:
        port = F.regexp_extract(_part(u, 2), r":(\d+)$", 1)
        return let(F.struct(u.alias("u"), F.lower(_part(u, 1)).alias("s"), host(u).alias("h"), port.alias("p")), lambda x: _canonical(x["u"], x["s"], x["h"], x["p"]))

    return let(_trimmed(url), build)


def _canonical(u: Column, scheme: Column, name: Column, port: Column) -> Column:
    shown = F.when((port == "") | ((scheme == "https") & (port == "443")) | ((scheme == "http") & (port == "80")), "").otherwise(F.concat(F.lit(":"), port))
    path = F.regexp_replace(_part(u, 3), "/{2,}", "/")
    path = F.when(path.isin("", "/"), "/").otherwise(F.regexp_replace(path, "/$", ""))
    kept = F.filter(parameters(u), lambda p: ~F.lower(p["k"]).startswith("utm_") & ~F.lower(p["k"]).isin(*TRACKING))
    query = F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(F.url_encode(p["k"]), F.lit("="), F.url_encode(p["v"]))), "&")
    return F.when(name.isNotNull() & ~is_private_host(name), F.concat(scheme, F.lit("://"), name, shown, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


def origin(canonical: Column) -> Column:
    """Scheme, host and port of a canonical URL."""
    return _nonempty(F.regexp_extract(canonical, "^(https?://[^/?#]+)", 1))


def segments(canonical: Column) -> Column:
    """Non-empty path segments of a canonical URL."""
    return F.filter(F.split(_part(canonical, 3), "/"), lambda s: s != "")


def is_generic_url(canonical: Column) -> Column:
    """Whether a canonical URL names a list or form instead of one posting; null is generic."""

    def judge(url: Column) -> Column:
        keyed = F.exists(parameters(url), lambda p: p["k"].rlike(POSTING_KEY))
        return F.when(url.isNull(), True).when(keyed, False).otherwise(let(F.transform(segments(url), F.lower), by_path))

    def by_path(parts: Column) -> Column:
        last = F.regexp_replace(F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit("")), r"\.(?:html?|aspx?|php)$", "")
        return F.when((last == "apply") & (F.size(parts) >= 2), F.try_element_at(parts, F.lit(-2)).isin(*GENERIC_SEGMENTS)).otherwise(last.isin(*GENERIC_SEGMENTS))

    return let(canonical, judge)


def is_career_url(canonical: Column) -> Column:
    """Hosts and paths that speak of jobs."""
    return F.coalesce(host(canonical).rlike(r"^(?:jobs?|careers?|recruit|recruitment)\.") | _part(canonical, 3).rlike(r"(?i)/(?:jobs?|careers?|recruit(?:ment)?|positions?|experienced|campus)(?:/|$)"), F.lit(False))


def is_detail_url(canonical: Column) -> Column:
    """Pages of one posting or article, as told by their path."""
    path = _part(canonical, 3)
    listing = path.rlike(r"(?i)(?:index(?:_\d+)?|list[^/]*)\.s?html$") | path.rlike(r"(?i)/kyjp\.html$")
    numbered = path.rlike(r"(?i)/(?:article/)?\d+\.s?html$") | path.rlike(r"(?i)/t20\d{6}_\d+\.s?html$")
    dated = path.rlike(r"(?i)\.s?html$") & path.rlike(r"(?i)20\d{4}|detail|info\d+")
    below = path.rlike(r"(?i)/(?:jobs?|positions?)/[^/]+(?:/detail)?/?$") & ~path.rlike(r"(?i)/(?:jobs?|positions?)/?$")
    return F.coalesce(~listing & (numbered | dated | below), F.lit(False))


#: ``provider, host pattern, path pattern with the tenant, key, root, API``: public job boards and how a URL names the tenant (``{t}``, ``{l}`` in lower case, ``{h}`` the host).
# Hosts and addresses of the boards.
BOARDS = (
    ("Lever", r"^jobs\.lever\.co$", "^/([^/]+)", "ats:lever:{l}", "https://jobs.lever.co/{t}", "https://api.lever.co/v0/postings/{t}?mode=json"),
    ("Lever", r"^api\.lever\.co$", "^/v0/postings/([^/]+)", "ats:lever:{l}", "https://jobs.lever.co/{t}", "https://api.lever.co/v0/postings/{t}?mode=json"),
    ("Greenhouse", r"^(?:job-boards|boards)\.greenhouse\.io$", "^/([^/]+)", "ats:greenhouse:{l}", "https://job-boards.greenhouse.io/{t}", "https://boards-api.greenhouse.io/v1/boards/{t}/jobs?content=false"),
    ("Greenhouse", r"^boards-api\.greenhouse\.io$", "^/v1/boards/([^/]+)", "ats:greenhouse:{l}", "https://job-boards.greenhouse.io/{t}", "https://boards-api.greenhouse.io/v1/boards/{t}/jobs?content=false"),
    ("Ashby", r"^jobs\.ashbyhq\.com$", "^/([^/]+)", "ats:ashby:{l}", "https://jobs.ashbyhq.com/{t}", "https://api.ashbyhq.com/posting-api/job-board/{t}"),
    ("Ashby", r"^api\.ashbyhq\.com$", "^/posting-api/job-board/([^/]+)", "ats:ashby:{l}", "https://jobs.ashbyhq.com/{t}", "https://api.ashbyhq.com/posting-api/job-board/{t}"),
    ("Workday", r"^([^.]+)\..*myworkdayjobs\.com$", "", "ats:workday:{h}", "https://{h}", ""),
    ("SmartRecruiters", r"^careers\.smartrecruiters\.com$", "^/([^/]+)", "ats:smartrecruiters:{l}", "https://careers.smartrecruiters.com/{t}", ""),
)


def _identity(canonical: Column, boards) -> Column:
    name, path = host(canonical), _part(canonical, 3)
    found = F.lit(None).cast("struct<provider:string,tenant:string,source_key:string,root_url:string,api_url:string>")
    for provider, hosts, tenant_path, key, root, api in reversed(boards):
        tenant = F.regexp_extract(path, tenant_path, 1) if tenant_path else F.regexp_extract(name, hosts, 1)

        def fill(template: str) -> Column:
            out = F.lit(template)
            for mark, value in (("{t}", tenant), ("{l}", F.lower(tenant)), ("{h}", name)):
                out = F.replace(out, F.lit(mark), value)
            return _nonempty(out)

        row = F.struct(F.lit(provider).alias("provider"), tenant.alias("tenant"), fill(key).alias("source_key"), fill(root).alias("root_url"), fill(api).alias("api_url"))
        found = F.when(name.rlike(hosts) & (tenant != ""), row).otherwise(found)
    government = name.rlike(r"(?:^|\.)gov\.cn$")
    marker = r"(?i)^((?:/[^/]+)*?/(?:(?:experienced|campus)/(?:jobs?|positions?)|jobs?|careers?|recruit(?:ment)?|positions?|experienced|campus))(?:/|$)"
    career_root = F.concat(origin(canonical), F.coalesce(_nonempty(F.regexp_extract(path, marker, 1)), F.lit("/")))
    directory = F.regexp_replace(F.regexp_replace(path, r"/20\d{4}/.*$|/20\d{4}$", ""), r"(?i)/t20\d{6}_\d+\.html$", "")
    page = F.when(government & (directory != path), F.concat(origin(canonical), F.when(directory == "", "/").otherwise(directory))).otherwise(canonical)
    none = F.lit(None).cast("string")
    plain = lambda key, root: F.struct(none.alias("provider"), none.alias("tenant"), key.alias("source_key"), root.alias("root_url"), none.alias("api_url"))
    other = F.when(~government & is_career_url(canonical), plain(F.concat(F.lit("career:"), F.lower(origin(canonical))), career_root)).otherwise(plain(F.concat(F.lit("url:"), F.lower(page)), page))
    return F.when(canonical.isNotNull(), F.coalesce(found, other))


def source_identity(canonical: Column, boards=BOARDS) -> Column:
    """``struct<provider, tenant, source_key, root_url, api_url>`` of a canonical URL.

    A known board gives its tenant's key; a career page of any other host the
    host's origin, with the path up to the word that speaks of jobs as root;
    another page is its own source.  A government page counts with its
    directory.
    """
    return let(canonical, lambda c: _identity(c, boards))


def owns_url(canonical: Column, root: Column, api: Column, provider: Column, tenant: Column, boards=BOARDS) -> Column:
    """Whether a source may publish a posting under an https URL: the same tenant of a board with tenants, else the origin of its root or API."""

    def judge(c: Column) -> Column:
        same_tenant = let(source_identity(c, boards), lambda x: (x["provider"] == provider) & (F.lower(x["tenant"]) == F.lower(tenant)))
        same_origin = F.coalesce(origin(c) == origin(canonical_url(root)), F.lit(False)) | F.coalesce(origin(c) == origin(canonical_url(api)), F.lit(False))
        return F.coalesce(c.startswith("https://"), F.lit(False)) & F.coalesce(F.when(provider.isin("Lever", "Greenhouse", "Ashby"), same_tenant).otherwise(same_origin), F.lit(False))

    return let(canonical, judge)
