"""Folds on fixtures that the tables don't hold: several sources, conflicts, closing, revocation, empty tables."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import places as P
from millrace.functions import urls as U
from millrace.operators import relational as R
from millrace.plans import commits, hosting, lifecycle

JOB = "id string, source_id string, status string, active_score int, valid_us long"
OBS = "job_id string, source_id string, consecutive_missing long, observed_status string, active_score int, closure_threshold int"


def test_resolved_status_over_several_sources(spark):
    now = 1_000_000
    jobs = spark.createDataFrame(
        [("healthy", "a", "confirmed_active", 90, None), ("one_missing", "a", "confirmed_active", 90, None), ("all_gone", "a", "confirmed_active", 90, None), ("expired", "a", "confirmed_active", 90, 5), ("unseen", "a", "needs_review", 70, None), ("orphan", "x", "confirmed_active", 90, None), ("lacking", "a", "confirmed_active", 10, None), ("nulls", "a", None, None, None)], JOB
    )
    obs = spark.createDataFrame(
        [("healthy", "a", 0, "confirmed_active", 80, 2), ("healthy", "a", 0, "confirmed_active", 80, 2), ("one_missing", "a", 3, "confirmed_active", 99, 2), ("one_missing", "b", 0, "confirmed_active", 60, None), ("all_gone", "a", 2, "confirmed_active", 99, 1), ("all_gone", "b", 0, "closed", 99, 2), ("lacking", "b", 0, "confirmed_active", 40, 2), ("healthy", "revoked", 9, "closed", 1, 2)], OBS
    )
    active = spark.createDataFrame([("a",), ("b",)], "source_id string")
    got = {r["id"]: (r["source_id"], r["resolved_status"], r["score"], r["missing"], r["conflict"]) for r in hosting.resolve_support(jobs, obs, active, now).collect()}
    assert got == {
        "healthy": ("a", "confirmed_active", 90, 0, False),
        # The stored status of this one stays active; at read time it needs a look.
        "one_missing": ("b", "needs_review", 90, 0, True),
        "all_gone": ("a", "closed", 0, 0, False),
        "expired": ("a", "closed", 0, 0, False),
        "unseen": ("a", "needs_review", 70, 0, False),
        "orphan": (None, "quarantined", 0, None, False),
        "lacking": ("b", "needs_review", 40, 0, True),
        "nulls": ("a", "needs_review", 0, 0, False),
    }
    assert hosting.resolve_support(jobs.limit(0), obs, active, now).count() == 0
    assert {r["resolved_status"] for r in hosting.resolve_support(jobs, obs, active.limit(0), now).collect()} == {"quarantined"}


def test_missing_counts_reset_and_close(spark):
    schema = OBS + ", missing_mode string, seen boolean, whole boolean"
    rows = [
        ("listed", "s", 2, "confirmed_active", 90, 3, "authoritative", True, True),
        ("first", "s", 0, "confirmed_active", 90, 2, "authoritative", False, True),
        ("marked", "s", 1, "confirmed_active", 90, 2, "review_only", False, True),
        ("second", "s", 1, "confirmed_active", 90, 2, "authoritative", False, True),
        ("low", "s", 1, "confirmed_active", 90, 1, "authoritative", False, True),
        ("three", "s", 1, "confirmed_active", 90, 3, "authoritative", False, True),
        ("partial", "s", 0, "confirmed_active", 90, 2, "authoritative", False, False),
        ("streak", "s", 1, "confirmed_active", None, 2, "authoritative", False, False),
        ("closed", "s", 4, "closed", 0, 2, "authoritative", False, True),
    ]
    got = {r["job_id"]: (r["missing_after"], r["mode_after"], r["status_after"], r["score_after"]) for r in R.missing_advance(spark.createDataFrame(rows, schema), F.col("seen"), F.col("whole")).collect()}
    assert got == {
        "listed": (0, "authoritative", "confirmed_active", 90),
        "first": (1, "authoritative", "needs_review", 90),
        "marked": (1, "authoritative", "needs_review", 90),
        "second": (2, "authoritative", "closed", 0),
        "low": (2, "authoritative", "closed", 0),
        "three": (2, "authoritative", "needs_review", 90),
        "partial": (1, "review_only", "needs_review", 50),
        "streak": (1, "authoritative", "needs_review", 0),
        "closed": (4, "authoritative", "closed", 0),
    }


def test_commit_matches_on_three_keys_and_refuses_conflicts(spark):
    schema = "id string, source_id string, ext string, u string, ident string, h string, status string, version long"
    stored = spark.createDataFrame([("a", "s", "1", "u1", "c|t", "h1", "confirmed_active", 1), ("b", "s", "2", "u2", "c|t2", "h2", "confirmed_active", 3), ("c", "s", "", "u3", "c|t3", "h3", "confirmed_active", 1), ("gone", "s", "9", "u9", "c|t9", "h9", "confirmed_active", 1), ("old", "s", "8", "u8", "c|t8", "h8", "closed", 1), ("k", "bad", "5", "ux", "c|x", "hx", "confirmed_active", 1)], schema)
    listed = spark.createDataFrame([("a", "s", "1", "u1", "c|t", "h1", "confirmed_active", 1), ("b2", "s", "2", "u2", "c|t2", "new", "confirmed_active", 1), ("c2", "s", "77", "u3", "c|t3", "h3", "confirmed_active", 1), ("d", "s", "4", "u4", "c|t4", "h4", "confirmed_active", 1), ("n", "no", "1", "u1", "c|t", "h1", "confirmed_active", 1), ("k2", "bad", "5", "uy", "c|y", "hy", "confirmed_active", 1)], schema)
    approved = spark.createDataFrame([("s",), ("bad",)], "source_id string")
    seen = spark.createDataFrame([("gone", 1, 2)], "id string, missing long, threshold int")
    got = {r["id"]: (r["action"], r["stored_id"], r["version"], r["missing"], r["status"]) for r in commits.commit_pass(stored, listed, approved, seen).collect()}
    assert got == {
        "a": ("unchanged", "a", 1, 0, "confirmed_active"),
        "b2": ("update", "b", 4, 0, "confirmed_active"),
        "c2": ("unchanged", "c", 1, 0, "confirmed_active"),
        "d": ("insert", None, 1, 0, "confirmed_active"),
        "n": ("not_approved", None, None, None, None),
        "k2": ("identity_conflict", None, None, None, None),
        "gone": ("close", "gone", 1, 2, "closed"),
    }
    assert commits.commit_pass(stored.limit(0), listed.limit(0), approved, seen).count() == 0


def test_key_conflicts_need_both(spark):
    rows = [("s", "1", "u1", "a", 1), ("s", "1", "u2", "b", 2), ("s", "2", "u1", "a", 3), ("s", "2", "u2", "a", 4), ("s", "3", "u1", "a", 5), ("s", "3", "u1", "b", 6), ("s", None, "u1", "a", 7), ("s", "", "u2", "b", 8), ("s", "4", None, "a", 9), ("s", "4", "u1", "b", 10)]
    got = [tuple(r) for r in R.key_conflicts(spark.createDataFrame(rows, "s string, e string, u string, i string, n int"), ["s", "e"], "u", "i", "n").collect()]
    assert [tuple(map(str, r)) for r in got] == [("s", "1", "2", "2", "1,2")]


def test_commit_and_conflicts_without_broadcasts(spark):
    # Sizes are beyond the broadcast threshold in large tables; the joins are then sort-merge joins.
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        schema = "id string, source_id string, ext string, u string, ident string, h string, status string, version long"
        row = lambda i, s, x, h: (i, s, x, f"u{i}", f"c|{i}", h, "confirmed_active", 1)
        stored = spark.createDataFrame([row(f"j{n}", f"s{n % 7}", str(n), "h") for n in range(200)], schema)
        listed = spark.createDataFrame([row(f"j{n}", f"s{n % 7}", str(n), "h" if n % 2 else "new") for n in range(100, 300)] + [row("k", "s0", "0", "h")], schema)
        approved = spark.createDataFrame([(f"s{n}",) for n in range(6)], "source_id string")
        seen = spark.createDataFrame([("j1", 1, 2)], "id string, missing long, threshold int")
        got = {r["id"]: (r["action"], r["stored_id"]) for r in commits.commit_pass(stored, listed, approved, seen).collect()}
        want = {f"j{n}": ("not_approved" if n % 7 == 6 else "identity_conflict" if n % 7 == 0 else "insert" if n >= 200 else "unchanged" if n % 2 else "update", f"j{n}" if n < 200 and n % 7 not in (0, 6) else None) for n in range(100, 300)}
        want |= {"k": ("identity_conflict", None)} | {f"j{n}": ("close" if n == 1 else "missing", f"j{n}") for n in range(100) if n % 7 not in (0, 6)}
        assert got == want
        both = stored.unionByName(listed)
        assert [tuple(r) for r in R.key_conflicts(both, ["source_id", "ext"], "u", "ident", "id").collect()] == [("s0", "0", 2, 2, "j0,k")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_commit_takes_the_smallest_of_several_matches(spark):
    schema = "id string, source_id string, ext string, u string, ident string, h string, status string, version long"
    stored = spark.createDataFrame([("c", "s", "1", "u", "c|t", "h", "confirmed_active", 1), ("b", "s", "1", "u", "c|t", "h", "confirmed_active", 1), ("a", "other", "1", "u", "c|t", "h", "confirmed_active", 1), ("d", "s", "", None, "c|t", "h", "closed", 1), ("0", "s", "", None, "c|t", "h", "closed", 1)], schema)
    listed = spark.createDataFrame([("c", "s", "1", "u", "c|t", "h", "confirmed_active", 1), ("x", "s", "1", "u", "c|t", "h", "confirmed_active", 1), ("y", "s", "", "u", "c|t", "h", "confirmed_active", 1), ("z", "s", "", None, "c|t", "h", "confirmed_active", 1)], schema)
    approved, seen = spark.createDataFrame([("s",)], "source_id string"), spark.createDataFrame([], "id string, missing long, threshold int")
    got = {r["id"]: (r["action"], r["stored_id"]) for r in commits.commit_pass(stored, listed, approved, seen).collect()}
    assert got == {"c": ("unchanged", "c"), "x": ("unchanged", "b"), "y": ("unchanged", "a"), "z": ("insert", None)}


def test_places_in_a_text(spark):
    schema = "region_code string, level_name string, province_code string, name_zh string, name_en string, aliases array<string>"
    rows = [("000000", "nation", None, "全国", "China", ["中国"]), ("000001", "remote", None, "远程", "Remote", None), ("100000", "province", "100000", "河溪省", "Hexi", ["河溪"]), ("200000", "province", "200000", "山南省", "Shannan", []), ("101000", "city", "100000", "白塔市", "Baita", ["白塔"]), ("102000", "city", "100000", "青石市", "Qingshi", ["青石"]), ("201000", "city", "200000", "白沙市", "Baita", [])]
    regions = spark.createDataFrame(rows, schema)
    want = {"Baita, Hexi, China": ("named", ["101000"]), "Baita": ("ambiguous", []), "河溪省白塔市": ("named", ["101000"]), "Hexi": ("named", ["100000"]), "Hexishan": ("unknown", []), "China": ("named", ["000000"]), "Remote - China": ("named", ["000001"]), "青石/白沙市": ("ambiguous", []), "": ("unknown", []), None: ("unknown", [])}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(want)], "i int, t string")
    names = P.names_of(regions)
    got = [(r["c"]["status"], r["c"]["codes"]) for r in df.select("i", P.classify(F.col("t"), names).alias("c")).orderBy("i").collect()]
    assert got == list(want.values())
    typed = spark.createDataFrame([(1, ["青石/Hexi", None], "全国"), (2, None, None), (3, ["Remote"], "山南省；远程")], "k int, a array<string>, b string")
    values = P.values_of(F.coalesce("a", F.array().cast("array<string>")), F.array("b"))
    assert sorted((r["k"], r["region_code"]) for r in P.places_of(typed, "k", values, regions).collect()) == [(1, "102000"), (3, "000001"), (3, "200000")]
    with pytest.raises(ValueError):
        P.names_of(regions, 3)


def test_ownership_of_addresses(spark):
    rows = [("https://jobs.lever.co/Acme/1", "https://jobs.lever.co/acme", None, "Lever", "acme", True), ("https://jobs.lever.co/other/1", "https://jobs.lever.co/acme", None, "Lever", "acme", False), ("https://api.x.example/1", "https://x.example/jobs", "https://api.x.example/feed", None, None, True), ("http://x.example/1", "https://x.example", None, None, None, False), ("https://x.example.evil.example/1", "https://x.example", None, None, None, False), (None, "https://x.example", None, None, None, False)]
    df = spark.createDataFrame([(i, *r[:5]) for i, r in enumerate(rows)], "i int, u string, root string, api string, provider string, tenant string")
    got = [r["o"] for r in df.select("i", U.owns_url(U.canonical_url(F.col("u")), F.col("root"), F.col("api"), F.col("provider"), F.col("tenant")).alias("o")).orderBy("i").collect()]
    assert got == [r[5] for r in rows]


def test_generic_and_detail_addresses(spark):
    rows = {"https://x.example/": (True, False), "https://x.example/jobs/": (True, False), "https://x.example/jobs?jobId=4": (False, False), "https://x.example/jobs/apply": (True, True), "https://x.example/eng/apply": (False, False), "https://x.example/a/12.html": (False, True), "https://x.example/careers/index.html": (False, False), "https://x.example/positions/77/detail": (False, True)}
    df = spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "i int, u string").withColumn("c", U.canonical_url(F.col("u")))
    got = [(r["g"], r["d"]) for r in df.select("i", U.is_generic_url(F.col("c")).alias("g"), U.is_detail_url(F.col("c")).alias("d")).orderBy("i").collect()]
    assert got == list(rows.values())


def test_candidate_scores(spark):
    schema = "query_id string, title string, snippet string, url string, published_us long, observed_us long, in_china boolean"
    day = 86_400_000_000
    rows = [("q1", "岗位", None, "https://jobs.lever.co/acme", 0, 10 * day, True), ("q2", "岗位", "x", "https://jobs.lever.co/acme/1", None, 10 * day, True), ("q1", "读书", "验证码", "https://x.example/about", None, day, False), ("q1", None, None, "javascript:x", None, None, None), ("q1", "招聘", None, "https://hr.a.gov.cn/zp/list.html", 0, 100 * day, True)]
    got = {r["source_key"]: (r["score"], r["status"]) for r in lifecycle.candidate_scores(spark.createDataFrame(rows, schema), spark.createDataFrame([("none",)], "source_key string")).collect()}
    assert got == {"ats:lever:acme": (89, "ready_for_probe"), "url:https://x.example/about": (0, "rejected_access_restricted"), "url:https://hr.a.gov.cn/zp/list.html": (72, "ready_for_probe")}


def test_newest_keeps_one_row_at_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", None, "z"), ("b", None, "y"), (None, 3, "n")], "k string, at int, v string")
    assert sorted((str(r["k"]), r["v"]) for r in R.newest(df, ["k"], "at").collect()) == [("None", "n"), ("a", "x"), ("b", "y")]
