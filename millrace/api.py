"""One method per tool over a data directory: reads give DataFrames, exports one JSON document, arguments are checked."""

from __future__ import annotations

import json
import os
import tempfile
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import places as P
from millrace.operators import relational as R
from millrace.plans import catalog, commits, geography, hosting, planning
from millrace.session import table

MAX_EXPORT_BYTES = 7_500_000


class ArgumentError(ValueError):
    """Arguments that don't fit a tool's schema; ``issues`` names each."""

    def __init__(self, issues: list[str]):
        super().__init__("; ".join(issues))
        self.issues = issues


def schema_issues(value: Any, schema: dict, path: str = "$") -> list[str]:
    """What ``value`` breaks of a JSON schema of types, enums, ranges, lengths, items and properties."""
    kinds = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}
    wanted = schema.get("type")
    types = [wanted] if isinstance(wanted, str) else wanted or []
    fits = lambda t: isinstance(value, kinds[t]) and not (t in ("integer", "number") and isinstance(value, bool))
    if types and not any(map(fits, types)):
        return [f"{path} must be {' or '.join(types)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path} must be one of {schema['enum']}")
    for key, broken in (("minimum", lambda m: value < m), ("maximum", lambda m: value > m), ("minLength", lambda m: len(value) < m), ("maxLength", lambda m: len(value) > m), ("maxItems", lambda m: len(value) > m)):
        if key in schema and value is not None and broken(schema[key]):
            out.append(f"{path} breaks {key} {schema[key]}")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            out += schema_issues(item, schema["items"], f"{path}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k} is missing" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                out += schema_issues(v, known[k], f"{path}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{path}.{k} is unknown")
    return out


def _page(most: int) -> dict:
    return {"limit": {"type": "integer", "minimum": 1, "maximum": most}, "cursor": {"type": "integer", "minimum": 0}}


_CODE = {"type": ["string", "null"], "maxLength": 12}
#: The tools and what they take.
TOOLS: dict[str, dict] = {
    "status": {}, "audit": {}, "source_coverage": {}, "export_projection": {"path": {"type": "string", "minLength": 1}},
    "list_jobs": {"status": {"type": "string", "enum": ["confirmed_active", "needs_review", "closed", "all"]}, "province_code": _CODE, "city_code": _CODE, **_page(500)},
    "list_sources": {"lifecycle": {"type": ["string", "null"]}, "province_code": _CODE, **_page(200)},
    "list_regions": {"province_code": _CODE},
    "get_source_graph": {"source_id": {"type": ["string", "null"]}, "relation": {"type": ["string", "null"], "enum": [None, "lists_job", "covers_region", "discovered_by"]}, **_page(500)},
    "get_run": {"run_id": {"type": "string", "minLength": 1}},
    "query": {"name": {"type": "string", "minLength": 1}},
}


@dataclass(frozen=True)
class Page:
    rows: DataFrame
    total: int
    next_cursor: int | None


class Engine:
    """Read tools over the tables of one directory."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark, self.dir = spark, data_dir

    def call(self, tool: str, arguments: dict | None = None):
        """Checks the arguments against the tool's schema and runs it."""
        if tool not in TOOLS:
            raise ArgumentError([f"unknown tool {tool}"])
        given = arguments or {}
        required = [k for k in ("path", "run_id", "name") if k in TOOLS[tool]]
        if issues := schema_issues(given, {"type": "object", "properties": TOOLS[tool], "required": required, "additionalProperties": False}):
            raise ArgumentError(issues)
        return getattr(self, tool)(**given)

    def _paged(self, rows: DataFrame, limit: int, cursor: int, *order) -> Page:
        total = rows.count()
        return Page(R.page(rows, limit, cursor, *order), total, cursor + limit if cursor + limit < total else None)

    def status(self) -> DataFrame:
        """``key, n``: sources by lifecycle, due and late ones, postings by resolved status."""
        sources = table(self.spark, self.dir, "sources").groupBy(F.concat(F.lit("sources_"), F.col("lifecycle")).alias("key")).agg(F.count("*").alias("n"))
        jobs = hosting.resolved(self.spark, self.dir).groupBy(F.concat(F.lit("jobs_"), F.col("resolved_status")).alias("key")).agg(F.count("*").alias("n"))
        return sources.unionByName(jobs)

    def audit(self) -> DataFrame:
        return self.query("audit")

    def source_coverage(self) -> dict[str, DataFrame]:
        return {name: self.query(name) for name in ("channel_coverage", "employer_coverage", "region_coverage", "coverage_summary")}

    def _in_region(self, province_code: str | None, city_code: str | None) -> DataFrame:
        found = geography.record_places(self.spark, self.dir)
        for column, code in (("province_code", province_code), ("region_code", city_code)):
            if code:
                found = found.filter(F.col(column) == code)
        return found.select("rec_id")

    def list_jobs(self, status: str = "confirmed_active", province_code: str | None = None, city_code: str | None = None, limit: int = 100, cursor: int = 0) -> Page:
        """Postings by the status resolved at read time, and by place: both codes must hold for one place."""
        rows = hosting.resolved(self.spark, self.dir).filter("resolved_status <> 'quarantined'")
        if status != "all":
            rows = rows.filter(F.col("resolved_status") == status)
        shown = hosting.latest(self.spark, self.dir, "company", "title")
        if province_code or city_code:
            shown = shown.join(self._in_region(province_code, city_code), "rec_id", "left_semi")
        return self._paged(rows.join(shown, "id").select("id", "source_id", "company", "title", F.col("resolved_status").alias("status"), "score"), limit, cursor, F.asc("id"))

    def list_sources(self, lifecycle: str | None = None, province_code: str | None = None, limit: int = 50, cursor: int = 0) -> Page:
        """Sources by lifecycle and province; those that serve the whole country serve each."""
        rows = table(self.spark, self.dir, "sources").select("id", "source_key", "name", "lifecycle", "discovered_at")
        if lifecycle:
            rows = rows.filter(F.col("lifecycle") == lifecycle)
        if province_code:
            places = geography.record_places(self.spark, self.dir).filter((F.col("level_name") == "nation") | (F.col("province_code") == province_code)).select("rec_id")
            serves = table(self.spark, self.dir, "jobs").select("rec_id", F.col("source_id").alias("id")).join(places, "rec_id", "left_semi").select("id").distinct()
            rows = rows.join(serves, "id", "left_semi")
        return self._paged(rows, limit, cursor, F.desc("discovered_at"), F.asc("id"))

    def list_regions(self, province_code: str | None = None) -> DataFrame:
        rows = catalog.queries()["region_rollup"](self.spark, self.dir)
        if not province_code:
            return rows
        inside = table(self.spark, self.dir, "regions").filter(F.col("province_code") == province_code).select("region_code")
        return rows.join(inside, "region_code", "left_semi")

    def get_source_graph(self, source_id: str | None = None, relation: str | None = None, limit: int = 100, cursor: int = 0) -> Page:
        rows = commits.edges(self.spark, self.dir)
        for column, value in (("from_id", source_id), ("type", relation)):
            if value:
                rows = rows.filter(F.col(column) == value)
        return self._paged(rows, limit, cursor, F.desc("last_at"), F.asc("from_id"), F.asc("type"), F.asc("to_id"))

    def get_run(self, run_id: str) -> dict:
        """One pass of a source; an unknown id is an error."""
        found = catalog.queries()["retained_runs"](self.spark, self.dir).filter(F.col("run_id") == run_id).limit(1).collect()
        if not found:
            raise ArgumentError([f"no run {run_id}"])
        return found[0].asDict()

    def query(self, name: str) -> DataFrame:
        known = catalog.queries()
        if name not in known:
            raise ArgumentError([f"no query {name}"])
        return known[name](self.spark, self.dir)

    def export_projection(self, path: str) -> dict:
        """Writes the bounded projection as one JSON document, complete or not at all; returns its manifest.

        The least postings give way until the document fits ``MAX_EXPORT_BYTES``.
        """
        jobs = [r.asDict() for r in hosting._projected(self.spark, self.dir).orderBy("pos").collect()]
        sources = [r["id"] for r in self.query("projection_sources").collect()]
        kept = len(jobs)
        while True:
            document = json.dumps({"sources": sources, "jobs": jobs[:kept], "edges": [[j["source_id"], j["id"]] for j in jobs[:kept]]}, ensure_ascii=False)
            size = len(document.encode())
            if size <= MAX_EXPORT_BYTES or not kept:
                break
            kept = kept * MAX_EXPORT_BYTES // size if size > 2 * MAX_EXPORT_BYTES else kept - 1
        write_atomically(path, document)
        return {"sources": len(sources), "jobs": kept, "jobs_before": len(jobs), "bytes": size, "truncated": kept < len(jobs)}


def write_atomically(path: str, text: str) -> None:
    """A file of the driver, replaced in one step; nothing is left behind on failure."""
    handle, part = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)), prefix=".part-")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            f.write(text)
        os.replace(part, path)
    except BaseException:
        os.unlink(part)
        raise


def outcome(result: Any) -> dict:
    """How a tool's result is reported: completed or not, and its status."""
    status = result.get("status", "completed") if isinstance(result, dict) else "completed"
    failed = status in ("failed", "cancelled")
    return {"completed": not failed, "is_error": failed, "status": status}


def employer_queue(spark: SparkSession, data_dir: str) -> DataFrame:
    return planning.priorities(spark, data_dir)


def classify_text(spark: SparkSession, data_dir: str, text: str) -> list[str]:
    """Region codes that one text names."""
    names = P.names_of(table(spark, data_dir, "regions"))
    return spark.range(1).select(P.classify(F.lit(text), names)["codes"].alias("c")).first()["c"]
