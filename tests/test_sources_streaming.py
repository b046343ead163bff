"""Parsers, snapshots, robots and streaming folds on fixtures."""

import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import search
from millrace.functions.robots import glob_matches, robots_allow
from millrace.sources import directories, feeds, snapshots
from millrace.streaming import folds

RSS = "<rss><channel><item><title><![CDATA[Job engineer]]></title><link>https://x.example/1</link><pubDate>Sat, 15 Aug 2026 22:03:23 +0800</pubDate><description>&lt;p&gt;One&lt;/p&gt;two</description></item></channel></rss>"
ATOM = '<feed><entry><title>Planner</title><link href="2"/><updated>2026-08-15</updated></entry></feed>'
INDEX = "<sitemapindex><sitemap><loc>https://x.example/a.xml</loc></sitemap><sitemap><loc> https://x.example/b.xml </loc></sitemap></sitemapindex>"
LD = '<script type="application/ld+json">{"@graph":[{"@type":"JobPosting","title":"T","hiringOrganization":{"name":"C"},"validThrough":"2026-08-19"},{"@type":"Thing"}]}</script><script type="application/ld+json">{broken</script>'


def _responses(spark, *bodies):
    return spark.createDataFrame([(f"s{i}", "https://x.example/jobs/list", b) for i, b in enumerate(bodies)], "source_id string, url string, body string")


def test_feeds(spark):
    got = [tuple(r) for r in feeds.feed_items(_responses(spark, RSS, ATOM, "", None, "<item><title>open")).select("source_id", "pos", "title", "url", "published", "summary").orderBy("source_id").collect()]
    assert got == [("s0", 0, "Job engineer", "https://x.example/1", "Sat, 15 Aug 2026 22:03:23 +0800", "One\ntwo"), ("s1", 0, "Planner", "https://x.example/jobs/2", "2026-08-15", None)]


def test_plain_text(spark):
    rows = [("a<b>b</b>c &amp; d<br/>e</p>  f", "a b c & d\ne\nf"), ("&lt;p&gt;x", "x"), ("", ""), (None, None), ("x" * 2000, "x" * 2000)]
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(rows)], "i int, h string")
    assert [r["t"] for r in df.select("i", feeds.plain_text(F.col("h")).alias("t")).orderBy("i").collect()] == [t for _, t in rows]
    assert len(df.select(feeds.compact(F.col("h")).alias("c")).collect()[4]["c"]) == 901


def test_sitemap_and_json_ld(spark):
    assert [tuple(r) for r in feeds.sitemap_urls(_responses(spark, INDEX, None)).orderBy("loc").collect()] == [("s0", "index", "https://x.example/a.xml"), ("s0", "index", "https://x.example/b.xml")]
    rows = feeds.json_ld_postings(_responses(spark, LD, None, "")).collect()
    assert [(r["title"], r["company"], r["valid_through"], r["url"], r["url_is_fallback"]) for r in rows] == [("T", "C", "2026-08-19", "https://x.example/jobs/list", True)]


def test_listing_and_totals(spark):
    page = '<a href="/jobs/7">Open position</a> 2026-8-5 <a href="/jobs/7">again a job</a><a href="/about">About</a><a>no link job</a>'
    assert [tuple(r) for r in feeds.html_listing(_responses(spark, page, "", None, "plain")).collect()] == [("s0", "https://x.example/jobs/7", 1, "Open position", "2026-08-05")]
    got = spark.createDataFrame([('{"total":"12"}',), ('{"total":-1,"result":{"total":4}}',), ('{"total":null}',), ("[]",), (None,)], "b string").select(feeds.advertised_total(F.col("b")).alias("t")).collect()
    assert [r["t"] for r in got] == [12, 4, None, None, None]


def test_ndjson(spark):
    assert [r["line"] for r in feeds.ndjson_rows(_responses(spark, '{"a":1}\n\n{"a":2}\n'), 2).collect()] == [1, 3]
    with pytest.raises(Exception, match="broken JSON on line 2"):
        feeds.ndjson_rows(_responses(spark, "1\n{x")).collect()
    with pytest.raises(Exception, match="more than 1 rows"):
        feeds.ndjson_rows(_responses(spark, "1\n2"), 1).collect()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text("ab*$", max_size=7), st.text("ab", max_size=8)), min_size=25, max_size=40))
def test_globs_equal_regular_expressions(spark, pairs):
    def want(pattern, path):
        closed, body = pattern.endswith("$"), pattern[:-1] if pattern.endswith("$") else pattern
        return bool(re.match("".join(".*" if c == "*" else re.escape(c) for c in body) + ("$" if closed else ""), path))

    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, g string, p string")
    assert [r["m"] for r in df.select("i", glob_matches(F.col("g"), F.col("p")).alias("m")).orderBy("i").collect()] == [want(*p) for p in pairs]


def test_robots_limits(spark):
    many = "\n".join(f"User-agent: a{i}\nDisallow: /" for i in range(65))
    long = "User-agent: *\nDisallow: /" + "x" * 2048
    rows = spark.createDataFrame([(0, many), (1, long), (2, None), (3, "Disallow: /"), (4, "# only\nUser-agent: *\nDisallow: /x*" + "a*" * 100)], "i int, r string")
    got = {r["i"]: r["ok"] for r in rows.select("i", robots_allow(F.col("r"), F.lit("/x" + "a" * 5000 + "b")).alias("ok")).collect()}
    assert got == {0: False, 1: False, 2: True, 3: True, 4: False}


def test_search_expressions(spark):
    one = spark.range(1)
    row = one.select(search.query_units(F.lit("ab招聘")).alias("u"), search.truncate_query(F.lit(" 招聘 jobs "), 6).alias("t"), search.site_pattern(F.lit("x site:*.a.example/ y")).alias("p"), search.site_pattern(F.lit("site:a..b")).alias("n"), search.redact(F.lit("key k-1, Bearer abc; bce-v3/x y"), "k-1").alias("r")).first()
    assert tuple(row) == (6, "招聘 j", "a.example/*", None, "key [REDACTED], Bearer [REDACTED]; [REDACTED] y")


def test_snapshots(spark, tmp_path):
    store = snapshots.SnapshotStore(spark, f"file://{tmp_path}/a")
    assert store.read("t", "x int").count() == 0
    assert store.commit(0, {"t": spark.range(3).selectExpr("cast(id as int) as x")}) == 1
    with pytest.raises(snapshots.RevisionConflict):
        store.commit(0, {})
    assert store.commit(1, {"u": spark.range(2).selectExpr("cast(id as int) as x")}) == 2
    assert store.read("t", "x int").count() == 3 and store.read("u", "x int", 1).count() == 0
    (tmp_path / "l").mkdir(), (tmp_path / "r").mkdir()
    for side, body in (("l", "1"), ("r", "1"), ("l", "2")):
        (tmp_path / side / f"f{body}").write_text(body)
    a, b = (snapshots.inventory(spark, str(tmp_path / s)) for s in "lr")
    assert [r["path"] for r in snapshots.differences(a, b).collect()] == ["f2"] and snapshots.differences(a, a).count() == 0


def test_only_one_of_several_writers_commits(spark, tmp_path):
    store = snapshots.SnapshotStore(spark, f"file://{tmp_path}/a")

    def write(n):
        try:
            return store.commit(0, {"t": spark.range(n).selectExpr("cast(id as int) as x")}), n
        except snapshots.RevisionConflict:
            return None, n

    with ThreadPoolExecutor(4) as pool:
        done = [n for revision, n in pool.map(write, range(1, 5)) if revision]
    assert len(done) == 1 and store.read("t", "x int").count() == done[0]
    store.transaction(lambda s, r: {"t": s.read("t", "x int").union(s.read("t", "x int"))})
    assert store.revision() == 2 and store.read("t", "x int").count() == 2 * done[0]


def test_streaming_budget_equals_batch(spark, tmp_path):
    rows = [(1, "2026-08-01 00:00:01"), (2, "2026-08-01 23:59:59"), (3, "2026-08-02 00:00:00")]
    spark.createDataFrame(rows, "id int, at string").selectExpr("id", "cast(at as timestamp) as at").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, at timestamp").parquet(str(tmp_path / "in"))
    q = folds.daily_budget(stream, "at", 1).writeStream.outputMode("complete").format("memory").queryName("budget").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted((str(r["day"]), r["used"], r["over_budget"]) for r in spark.table("budget").collect()) == [("2026-08-01", 2, 1), ("2026-08-02", 1, 0)]


def test_merge_is_idempotent(spark):
    state = spark.createDataFrame([("j", "s", 1, "old"), ("k", "s", 5, "kept")], "job string, src string, at int, status string")
    batch = spark.createDataFrame([("j", "s", 2, "new"), ("k", "s", 4, "late")], state.schema)
    once = folds.merge_observations(state, batch, ["job", "src"], "at")
    twice = folds.merge_observations(once, batch, ["job", "src"], "at")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("j", "s", 2, "new"), ("k", "s", 5, "kept")]


MAIN = directories.Directory("main", "$.page.data", "A_CODE", "FULL", "ABBR", least=2, most=3, keep={"KIND": "^1$"}, drop={"ABBR": "退$"})
SIDE = directories.Directory("side", "$", "no", "title", code_pattern=r"^\d+$")


def _body(spark, text):
    return spark.createDataFrame([(text,)], "body string")


def test_directories_are_read_strictly(spark):
    row = '{"A_CODE":"%s","FULL":"%s","ABBR":"%s","KIND":"%s"}'
    good = [row % x for x in (("600001", "Oak &amp; Co Ltd", "*ST 橡 树", "1"), ("600002", "榆木 股份", "榆木", "1"), ("600003", "Elm", "Elm", "2"), ("600004", "Ash", "Ash退", "1"))]
    got = [tuple(r) for r in directories.read_directory(_body(spark, '{"page":{"data":[%s]}}' % ",".join(good)), MAIN).orderBy("code").collect()]
    assert got == [("main", "600001", "Oak & Co Ltd", "橡树"), ("main", "600002", "榆木股份", "榆木")]
    for rows, part in (([good[0]], "1 rows"), ([good[0], good[0]], "stand twice"), ([good[0], row % ("6", "x", "y", "1")], "sound code"), ([good[0], row % ("600009", " ", "y", "1")], "sound code")):
        with pytest.raises(directories.DirectoryError, match=part):
            directories.read_directory(_body(spark, '{"page":{"data":[%s]}}' % ",".join(rows)), MAIN)
    with pytest.raises(directories.DirectoryError, match="0 rows"):
        directories.read_directory(_body(spark, "{broken"), MAIN)


def test_refresh_publishes_all_or_nothing(spark, tmp_path):
    store = snapshots.SnapshotStore(spark, f"file://{tmp_path}/u")
    main = '{"page":{"data":[{"A_CODE":"600001","FULL":"Oak Holding","ABBR":"Oak","KIND":"1"},{"A_CODE":"600002","FULL":"Elm Works","ABBR":"Elm","KIND":"1"}]}}'
    assert directories.refresh_universe(store, {"main": _body(spark, main), "side": _body(spark, '[{"no":"1","title":"OAK"},{"no":"2","title":"Ash"}]')}, [MAIN, SIDE]) == 1
    rows = {r["name"]: (r["aliases"], r["evidence"]) for r in store.read("employers", "employer_id string, name string, aliases array<string>, evidence array<string>").collect()}
    assert rows == {"Oak Holding": (["OAK", "Oak"], ["main:600001", "side:1"]), "Elm Works": (["Elm"], ["main:600002"]), "Ash": ([], ["side:2"])}
    bridge = directories.Directory("side", "$", "no", "title", "other", code_pattern=r"^\d+$")
    with pytest.raises(directories.DirectoryError, match="bridge"):
        directories.refresh_universe(store, {"main": _body(spark, main), "side": _body(spark, '[{"no":"1","title":"Oak","other":"Elm"}]')}, [MAIN, bridge])
    assert store.revision() == 1
