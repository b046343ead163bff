"""The facade and the command line."""

import json
import os

import pytest

from millrace import __main__, api

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_pages_and_filters(spark):
    engine = api.Engine(spark, DATA)
    page = engine.call("list_jobs", {"limit": 10})
    assert page.rows.count() == 10 and page.next_cursor == 10 and {r["status"] for r in page.rows.collect()} == {"confirmed_active"}
    last = engine.call("list_jobs", {"limit": 500, "cursor": page.total - 3, "status": "confirmed_active"})
    assert last.rows.count() == 3 and last.next_cursor is None
    assert engine.call("list_jobs", {"status": "all", "limit": 500}).total > page.total > engine.call("list_jobs", {"province_code": "670000"}).total
    assert engine.call("list_sources", {"lifecycle": "approved"}).total >= engine.call("list_sources", {"lifecycle": "approved", "province_code": "670000"}).total > 0
    graph = engine.call("get_source_graph", {"relation": "discovered_by", "limit": 5})
    assert {r["type"] for r in graph.rows.collect()} == {"discovered_by"}
    assert engine.call("list_regions", {"province_code": "670000"}).count() > 1
    assert engine.call("status").filter("key = 'sources_approved'").first()["n"] > 0


def test_arguments_are_checked(spark):
    engine = api.Engine(spark, DATA)
    for tool, arguments, part in (("list_jobs", {"limit": 501}, "maximum"), ("list_jobs", {"status": "open"}, "one of"), ("list_jobs", {"limit": True}, "integer"), ("list_jobs", {"x": 1}, "unknown"), ("get_run", {}, "missing"), ("nothing", {}, "unknown tool"), ("get_run", {"run_id": "none"}, "no run"), ("query", {"name": "none"}, "no query")):
        with pytest.raises(api.ArgumentError, match=part):
            engine.call(tool, arguments)
    assert api.schema_issues([1, "a"], {"type": "array", "items": {"type": "integer"}}) == ["$[1] must be integer"]
    assert api.outcome({"status": "failed"}) == {"completed": False, "is_error": True, "status": "failed"}


def test_export_is_bounded_and_whole(spark, tmp_path, monkeypatch):
    engine, path = api.Engine(spark, DATA), tmp_path / "out.json"
    full = engine.call("export_projection", {"path": str(path)})
    monkeypatch.setattr(api, "MAX_EXPORT_BYTES", full["bytes"] // 2)
    half = engine.call("export_projection", {"path": str(path)})
    document = json.loads(path.read_text())
    assert half["truncated"] and half["bytes"] <= full["bytes"] // 2 and len(document["jobs"]) == half["jobs"] == len(document["edges"])
    assert [p.name for p in tmp_path.iterdir()] == ["out.json"]


def test_command_line(capsys):
    assert __main__.main(["tools"]) == 0 and "list_jobs" in capsys.readouterr().out
    assert __main__.main(["list_jobs", "{"]) == 2
