"""All core queries by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.plans import bodies, commits, core_data, geography, hosting, identity, lifecycle, planning, registry, streams

_PARTS = (identity.CATALOG, geography.CATALOG, hosting.CATALOG, commits.CATALOG, planning.CATALOG, bodies.CATALOG, lifecycle.CATALOG, streams.CATALOG)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = registry.queries()
    for part in _PARTS:
        out |= part.queries
    return out | {"p3_found": core_data.p3_found, "p6_found": core_data.p6_found}


def oracle_sql() -> dict[str, str]:
    out = registry.oracle_sql()
    for part in _PARTS:
        out |= part.sql
    return out
