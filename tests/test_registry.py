"""Core queries against DuckDB on the smallest tables, and folds on fixtures."""

import os
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.functions import urls as U
from millrace.operators import relational as R
from millrace.plans import catalog

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


def _value(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    result = con.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    expected = Counter(tuple(_value(r[columns.index(c)]) for c in sorted(columns)) for r in result.fetchall())
    df = catalog.queries()[name](spark, str(DATA))
    assert sorted(df.columns) == sorted(columns)
    assert Counter(tuple(_value(v) for v in r) for r in df.select(*sorted(columns)).collect()) == expected


def test_supported_status_needs_all_sources_to_close(spark):
    schema = "job_id string, source_id string, observed_status string, consecutive_missing long, closure_threshold int, active_score int"
    rows = [("a", "1", "confirmed_active", 2, 2, 90), ("a", "2", "confirmed_active", 0, 2, None), ("b", "1", "confirmed_active", 2, None, 80), ("c", "1", "needs_review", 0, 2, 10), ("d", "1", "confirmed_active", 1, 2, 40)]
    got = {r["job_id"]: (r["stored_status"], r["score"]) for r in R.supported_status(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": ("confirmed_active", 90), "b": ("closed", 0), "c": ("needs_review", 10), "d": ("needs_review", 40)}
    assert R.supported_status(spark.createDataFrame([], schema)).count() == 0


def test_canonical_url(spark):
    rows = [("HTTPS://Jobs.Example.com:443//apply/1/?utm_source=feed&b=2&a=1#top",), ("https://jobs.example.com/apply/1?a=1&b=2",), ("http://x.example",), ("http://x.example:8080/a/?q=Beijing, China&gh_src=1",), ("javascript:alert(1)",), ("https://user:pw@x.example/",), ("https://100.64.0.1/",), (" ",), (None,)]
    got = [r["u"] for r in spark.createDataFrame(rows, "url string").select(U.canonical_url(F.col("url")).alias("u")).collect()]
    assert got == ["https://jobs.example.com/apply/1?a=1&b=2"] * 2 + ["http://x.example/", "http://x.example:8080/a?q=Beijing%2C+China"] + [None] * 5


def test_recent_unique_keeps_last_occurrence(spark):
    df = spark.createDataFrame([("o", "x", 1), ("o", "y", 2), ("o", "x", 3), ("o", "z", 0)], "owner string, v string, at int")
    assert [(r["v"], r["recency"]) for r in R.recent_unique(df, "owner", "v", 2, "at").orderBy("recency").collect()] == [("x", 1), ("y", 2)]
