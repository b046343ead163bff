"""Robots rules as columns: one linear pass over the lines, one over the pieces of each pattern."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.expressions import let

# A file beyond these limits is invalid and forbids everything.
MAX_GROUPS, MAX_RULES, MAX_PATTERN, MAX_STARS, MAX_AGENT = 64, 2_000, 2_048, 128, 256

_STATE = "struct<spec:int,groups:int,fresh:boolean,best:int,n:int,bad:boolean,rules:array<struct<spec:int,allow:boolean,path:string>>>"


def glob_matches(pattern: Column, path: Column) -> Column:
    """Whether ``pattern`` (``*`` for anything, ``$`` at the end to close it) matches ``path`` from its start.

    Its literal pieces are looked for one after the other, each behind the last,
    so the time grows with the lengths, not with the number of stars.
    """
    anchored = pattern.endswith("$")
    pieces = F.split(F.when(anchored, F.regexp_replace(pattern, r"\$$", "")).otherwise(pattern), r"\*", -1)

    def walk(p: Column) -> Column:
        n = F.size(p)
        head, tail = F.get(p, F.lit(0)), F.get(p, n - 1)
        # With an end, the last piece must stand there and isn't searched for.
        middle = F.slice(p, F.lit(2), F.greatest(F.lit(0), n - F.when(anchored, 2).otherwise(1)))

        def step(at: Column, piece: Column) -> Column:
            found = F.call_function("locate", piece, path, at)
            return F.when(at == 0, 0).when(found == 0, 0).otherwise(found + F.length(piece))

        reached = F.aggregate(middle, F.when(path.startswith(head), F.length(head) + 1).otherwise(F.lit(0)).cast("int"), step)
        closed = F.when(n == 1, path == head).otherwise((reached > 0) & path.endswith(tail) & (F.length(path) - F.length(tail) + 1 >= reached))
        return F.when(anchored, closed).otherwise(reached > 0)

    return let(pieces, walk)


def robots_allow(robots: Column, path: Column, agent: str = "millrace") -> Column:
    """Whether the rules let ``agent`` fetch ``path`` (with its query).

    The groups that name the agent's product most closely hold, ``*`` least; of
    their matching rules the one with the longest pattern (signs aside) decides,
    an allowance at a tie.  No group and no rule allow; null is an empty file.
    """
    token = agent.lower().split("/")[0].split()[0]
    fields = F.filter(
        F.transform(
            F.transform(F.split(F.coalesce(robots, F.lit("")), r"\r?\n"), lambda s: F.trim(F.regexp_replace(s, "#.*$", ""))),
            lambda s: F.struct(F.lower(F.trim(F.substring_index(s, ":", 1))).alias("f"), F.when(s.contains(":"), F.trim(F.regexp_replace(s, "^[^:]*:", ""))).alias("v")),
        ),
        lambda x: x["v"].isNotNull() & x["f"].isin("user-agent", "allow", "disallow"),
    )
    none = F.array().cast("array<struct<spec:int,allow:boolean,path:string>>")
    start = F.struct(F.lit(-1).alias("spec"), F.lit(0).alias("groups"), F.lit(False).alias("fresh"), F.lit(-1).alias("best"), F.lit(0).alias("n"), F.lit(False).alias("bad"), none.alias("rules")).cast(_STATE)

    def step(s: Column, x: Column) -> Column:
        name = F.lower(x["v"])
        own = F.when(name == "*", 0).when(F.contains(F.lit(token), name), F.length(name)).otherwise(-1)
        spec = F.when(s["fresh"], F.greatest(s["spec"], own)).otherwise(own)
        groups = s["groups"] + F.when(s["fresh"], 0).otherwise(1)
        asked = F.struct(spec.alias("spec"), groups.alias("groups"), F.lit(True).alias("fresh"), F.greatest(s["best"], own).alias("best"), s["n"].alias("n"), (s["bad"] | (groups > MAX_GROUPS) | (F.length(x["v"]) > MAX_AGENT)).alias("bad"), s["rules"].alias("rules"))
        stars = F.length(x["v"]) - F.length(F.replace(x["v"], F.lit("*"), F.lit("")))
        bad = s["bad"] | (s["n"] >= MAX_RULES) | (F.length(x["v"]) > MAX_PATTERN) | (stars > MAX_STARS)
        rule = F.struct(s["spec"].alias("spec"), (x["f"] == "allow").alias("allow"), x["v"].alias("path"))
        ruled = F.struct(s["spec"].alias("spec"), s["groups"].alias("groups"), F.lit(False).alias("fresh"), s["best"].alias("best"), (s["n"] + 1).alias("n"), bad.alias("bad"), F.when(bad, s["rules"]).otherwise(F.concat(s["rules"], F.array(rule))).alias("rules"))
        return F.when(x["f"] == "user-agent", asked.cast(_STATE)).when(s["groups"] == 0, s).otherwise(ruled.cast(_STATE))

    def decide(s: Column) -> Column:
        hits = F.filter(s["rules"], lambda r: (r["spec"] == s["best"]) & (r["path"] != "") & glob_matches(r["path"], path))
        ranked = F.transform(hits, lambda r: F.struct(F.length(F.regexp_replace(r["path"], "[*$]", "")).alias("n"), r["allow"].alias("allow")))
        return F.when(s["bad"], False).when(s["best"] < 0, True).otherwise(F.coalesce(F.array_max(ranked)["allow"], F.lit(True)))

    return let(F.aggregate(fields, start, step), decide)


def robots_decision(status: Column, robots: Column, path: Column, agent: str = "millrace") -> Column:
    """``struct<allowed, reason>`` of a fetched file: a missing one allows, any other failure forbids."""
    rules = robots_allow(robots, path, agent)
    absent, ok = status.isin(404, 410), status.between(200, 299)
    allowed = F.coalesce(absent | (ok & rules), F.lit(False))
    reason = F.when(absent, "robots_absent").when(ok & rules, "robots_allowed").when(ok, "robots_disallowed").otherwise("robots_unavailable_fail_closed")
    return F.struct(allowed.alias("allowed"), reason.alias("reason"))


def sitemaps(robots: Column) -> Column:
    """The sitemap addresses a file names."""
    return F.regexp_extract_all(F.coalesce(robots, F.lit("")), F.lit(r"(?im)^\s*sitemap\s*:\s*(\S+)"), F.lit(1))
