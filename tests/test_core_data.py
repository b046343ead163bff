"""Field splitting and timestamp normalisation on small fixtures."""

from datetime import UTC, datetime

import pytest

from millrace.functions.bounds import binomial_lower
from millrace.operators import split_fields as S
from millrace.operators import timestamps as T

C = S.Containers({"lizhou": frozenset({"91"}), "砾州省": frozenset({"91"}), "qihu": frozenset({"83"})}, frozenset({"china", "remote", "中国"}), {"shapingya": frozenset({"91"}), "沙坪崖市": frozenset({"91"}), "luwan": frozenset({"83"})})

CASES = [
    ("A城; B城", ["A城", "B城"]),
    ("沙坪崖市，砾州省", ["沙坪崖市，砾州省"]),
    ("Shapingya, Lizhou, China | Luwan", ["Shapingya, Lizhou, China", "Luwan"]),
    ("Shapingya, Qihu", ["Shapingya", "Qihu"]),
    ("China, Lizhou", ["China", "Lizhou"]),
    ("Shapngya, Lizhou", ["Shapngya, Lizhou"]),
    ('"A, B";"say ""HQ"""', ["A, B", 'say "HQ"']),
    ('["曜山", "x、y"]', ["曜山", "x、y"]),
    ("[a; b;; ]", ["a", "b"]),
    ("沙坪崖·科创园 · Luwan", ["沙坪崖·科创园", "Luwan"]),
    ("a and b及c & d\r\ne", ["a", "b", "c", "d", "e"]),
    ("one", ["one"]),
    ("  ", []),
    (None, []),
    (";;;", []),
]


@pytest.mark.parametrize("extra", [False, True])
def test_split_field(spark, extra):
    rows = [(i, t, "x", 0) for i, (t, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "rec_id long, location string, piece string, seq_no int")
    if not extra:
        df = df.drop("piece", "seq_no")
    got: dict[int, list] = {}
    for r in sorted(S.split_field(df, "rec_id", "location", C).collect(), key=lambda r: (r["rec_id"], r["seq_no"])):
        got.setdefault(r["rec_id"], []).append(r["piece"])
    assert got == {i: pieces for i, (_, pieces) in enumerate(CASES) if pieces}


def test_split_field_empty_and_long(spark):
    assert S.split_field(spark.createDataFrame([], "rec_id long, location string"), "rec_id", "location").count() == 0
    long = spark.createDataFrame([(1, ";".join(f"v{i}" for i in range(5000)))], "rec_id long, location string")
    assert S.split_field(long, "rec_id", "location").count() == 5000


STAMPS = [
    ("2025-07-08T03:45:50.037Z", "cn", "2025-07-08T03:45:50.037"),
    ("20250619050152", "cn", "2025-06-18T21:01:52"),
    ("1779394273", "cn", "2026-05-21T20:11:13"),
    ("1736081339.952", "cn", "2025-01-05T12:48:59.952"),
    ("2025年9月21日 上午12:20", "cn", "2025-09-20T16:20:00"),
    ("2025年9月21日 下午12:20", "cn", "2025-09-21T04:20:00"),
    ("03/08/2026 2:30 AM", "us", "2026-03-08T07:30:00"),  # skipped: as if the clock had not moved
    ("Nov 3, 2024 1:14 AM EST", "us", "2024-11-03T06:14:00"),
    ("2024-11-03 01:14:00", "us", "2024-11-03T05:14:00"),  # twice: the earlier
    ("29/03/2025 23:55", "us", None),
    ("08.07.2026 06:12 Uhr", "de", "2026-07-08T04:12:00"),
    ("2026-08-15 11:00 UTC+5:30", "cn", "2026-08-15T05:30:00"),
    ("Sun, 09 Mar 2025 00:29:05 -0500", "cn", "2025-03-09T05:29:05"),
    ("2025-10-20", "cn", "2025-10-19T16:00:00"),
    ("2025-02-29", "cn", None),
    ("0000-00-00", "cn", None),
    ("2026-13-45", "cn", None),
    ("3 days ago", "cn", None),
    ("", "cn", None),
    (None, "cn", None),
    ("2025-10-20", None, None),
    ("2025-10-20T00:00:00Z", None, "2025-10-20T00:00:00"),
]


def test_timestamps(spark):
    sources = spark.createDataFrame([("cn", "Asia/Shanghai", "zh-CN"), ("us", "America/New_York", "en-US"), ("de", "Europe/Berlin", "de-DE")], "id string, feed_zone string, feed_locale string")
    df = spark.createDataFrame([(i, s, src, "x") for i, (s, src, _) in enumerate(STAMPS)], "row long, published_at string, source_id string, utc_us string")
    got = {r["row"]: r["utc_us"] for r in T.normalise(df, "row", "published_at", "source_id", sources).collect()}
    want = {i: round(datetime.fromisoformat(w).replace(tzinfo=UTC).timestamp() * 1_000_000) for i, (_, _, w) in enumerate(STAMPS) if w}
    assert got == want
    assert T.normalise(df.limit(0), "row", "published_at", "source_id", sources).count() == 0


def test_values_do_not_depend_on_corpus_size(spark):
    """The same rows give the same values inside corpora of three sizes of one kind."""
    base = [f"Evora, Portugal; city {i}" for i in range(6)] + [f"Rome, {x}" for x in ("Oslo", "Bern", "Riga", "Nice")] + ["Shapingya, Lizhou"]
    got = []
    for times in (1, 10, 100):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(base * times)], "rec_id long, location string")
        got.append(sorted(tuple(r) for r in S.split_field(df, "rec_id", "location", C).filter(f"rec_id < {len(base)}").collect()))
    assert got[0] == got[1] == got[2] and (0, 2, 1, "Evora, Portugal") in got[0] and (6, 2, 1, "Rome") in got[0]


def test_exact_lower_bound():
    assert binomial_lower(5, 5, 0.95) == pytest.approx(0.05**0.2, abs=1e-6)
    assert binomial_lower(0, 9, 0.95) == 0.0 and binomial_lower(0, 0, 0.95) == 0.0
    assert 0.4 < binomial_lower(500, 1000, 0.95) < 0.5


def test_too_many_zones_is_an_error(spark):
    sources = spark.createDataFrame([("a", "UTC", "x"), ("b", "Asia/Tokyo", "x")], "id string, feed_zone string, feed_locale string")
    df = spark.createDataFrame([(1, "2025-01-01", "a")], "rec_id long, published_at string, source_id string")
    with pytest.raises(ValueError):
        T.normalise(df, "rec_id", "published_at", "source_id", sources, max_zones=1)
