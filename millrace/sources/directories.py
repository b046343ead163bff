"""Directories of employers: strict readers of recorded payloads, and a refresh that publishes all or nothing."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import canonical_name
from millrace.session import materialize
from millrace.sources.feeds import plain_text
from millrace.sources.snapshots import SnapshotStore


class DirectoryError(ValueError):
    """A directory that doesn't hold what it should."""


@dataclass(frozen=True)
class Directory:
    """How a payload lists employers and how many it must have.

    ``rows`` is the path of the list, ``code`` and ``name`` the fields every row
    needs, ``short`` an optional other name; ``keep`` are conditions on fields
    (patterns) that select rows, ``drop`` those that leave rows out.
    """

    id: str
    rows: str
    code: str
    name: str
    short: str | None = None
    code_pattern: str = r"^\d{6}$"
    keep: dict[str, str] = field(default_factory=dict)
    drop: dict[str, str] = field(default_factory=dict)
    least: int = 1
    most: int = 10_000


def _name(c: Column) -> Column:
    """A name without tags and listing marks, blanks between Chinese letters dropped; null if nothing is left."""
    t = F.trim(F.regexp_replace(F.regexp_replace(plain_text(c), r"\s+", " "), r"(?i)^S?\*?ST\s*(?=\P{Alpha})", ""))
    return F.nullif(F.when(t.rlike("[㐀-鿿]"), F.regexp_replace(t, r"\s+", "")).otherwise(t), F.lit(""))


def read_directory(responses: DataFrame, directory: Directory) -> DataFrame:
    """``directory, code, name, short_name`` of a recorded payload (``body``).

    A row without a sound code or name, a code that stands twice, or a number of
    rows outside the bounds is an error that says which.
    """
    v = F.try_parse_json("body")
    rows = responses.select(F.explode(F.coalesce(F.try_variant_get(v, directory.rows, "array<variant>"), F.array().cast("array<variant>"))).alias("v"))
    get = lambda f: F.try_variant_get("v", f"$.{f}", "string")
    for f, pattern in directory.keep.items():
        rows = rows.filter(F.coalesce(get(f), F.lit("")).rlike(pattern))
    for f, pattern in directory.drop.items():
        rows = rows.filter(~F.coalesce(get(f), F.lit("")).rlike(pattern))
    short = _name(get(directory.short)) if directory.short else F.lit(None).cast("string")
    found = materialize(rows.select(F.lit(directory.id).alias("directory"), F.trim(get(directory.code)).alias("code"), _name(get(directory.name)).alias("name"), short.alias("short_name")))
    bad = F.count_if(F.coalesce(~F.col("code").rlike(directory.code_pattern), F.lit(True)) | F.col("name").isNull())
    n, broken, codes = found.agg(F.count("*"), bad, F.countDistinct("code")).first()
    issues = [f"{broken} rows without a sound code or name"] * (broken > 0) + [f"{n - codes} codes stand twice"] * (not broken and codes < n) + [f"{n} rows, expected {directory.least} to {directory.most}"] * (not directory.least <= n <= directory.most)
    if issues:
        raise DirectoryError(f"{directory.id}: {'; '.join(issues)}")
    return found


def merge_directories(parts: list[DataFrame]) -> DataFrame:
    """``employer_id, name, aliases, evidence``: rows of all directories that share a name or short name are one employer.

    A row whose names belong to two employers that have nothing else in common
    would bridge them, which is an error.
    """
    rows = reduce(DataFrame.unionByName, parts).withColumn("row_id", F.concat_ws(":", "directory", "code"))
    keys = rows.select("row_id", F.explode(F.array_distinct(F.filter(F.transform(F.array("name", "short_name"), canonical_name), lambda k: F.length(k) > 1))).alias("key")).distinct()
    owner = keys.groupBy("key").agg(F.min("row_id").alias("group_id"))
    groups = materialize(keys.join(owner, "key").select("row_id", "key", "group_id").distinct())
    # Each row must lead to one group only; two mean that it joins employers that are apart.
    bridging = groups.groupBy("row_id").agg(F.countDistinct("group_id").alias("m"), F.collect_set("group_id").alias("g")).filter(F.col("m") > F.when(F.array_contains("g", F.col("row_id")), 2).otherwise(1))
    if found := bridging.select("row_id").limit(3).collect():
        raise DirectoryError(f"names bridge several employers: {', '.join(r['row_id'] for r in found)}")
    member = groups.groupBy("row_id").agg(F.min("group_id").alias("group_id"))
    full = rows.join(member, "row_id")
    best = full.groupBy("group_id").agg(
        F.min_by("name", F.struct("directory", "code")).alias("name"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.filter(F.array("name", "short_name"), lambda x: x.isNotNull()))))).alias("names"),
        F.array_sort(F.collect_set("row_id")).alias("evidence"),
    )
    id_ = F.concat(F.lit("employer-cn-"), F.substring(F.sha2(canonical_name(F.col("name")), 256), 1, 20))
    return best.select(id_.alias("employer_id"), "name", F.filter("names", lambda x: x != F.col("name")).alias("aliases"), "evidence")


def refresh_universe(store: SnapshotStore, bodies: dict[str, DataFrame], directories: list[Directory]) -> int:
    """Reads all directories, checks and merges them and commits one revision; any error leaves the store as it was."""
    revision = store.revision()
    merged = merge_directories([read_directory(bodies[d.id], d) for d in directories])
    return store.commit(revision, {"employers": merged})
