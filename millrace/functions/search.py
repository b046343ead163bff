"""Small expressions of search connectors: query lengths, site patterns, redaction, validators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.expressions import let


def query_units(text: Column) -> Column:
    """Length of a query in which signs beyond ASCII count twice."""
    t = F.coalesce(text, F.lit(""))
    return 2 * F.length(t) - F.length(F.regexp_replace(t, r"[^\x00-\x7f]", ""))


def truncate_query(text: Column, units: int = 72) -> Column:
    """The longest beginning of a query within ``units``."""
    chars = F.filter(F.split(F.trim(text), ""), lambda c: c != "")
    size = lambda c: F.when(c.rlike(r"[^\x00-\x7f]"), 2).otherwise(1)
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("k"))
    fold = F.aggregate(chars, start, lambda s, c: F.struct((s["n"] + size(c)).alias("n"), (s["k"] + F.when(s["n"] + size(c) <= units, 1).otherwise(0)).alias("k")), lambda s: s["k"])
    return let(F.struct(chars.alias("c"), fold.alias("k")), lambda x: F.trim(F.array_join(F.slice(x["c"], F.lit(1), x["k"]), "")))


def site_pattern(query: Column) -> Column:
    """``host/*`` of a query's ``site:`` term, null without a sound one."""
    raw = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_extract(query, r"(?i)(?:^|\s)site:([^\s\"']+)", 1), r"(?i)^https?://", ""), r"^\*\.", ""), r"/+$", "")
    return F.when((raw != "") & ~raw.contains(".."), F.concat(raw, F.lit("/*")))


def redact(text: Column, secret: str) -> Column:
    """A text without the secret and without any bearer token or key."""
    t = F.replace(text, F.lit(secret), F.lit("[REDACTED]")) if secret else text
    t = F.regexp_replace(t, r"(?i)\bBearer\s+[^\s,;\"'<>]+", "Bearer [REDACTED]")
    return F.regexp_replace(t, r"(?i)\bbce-v3/[^\s,;\"'<>]+", "[REDACTED]")
