"""Bundles, receipts and clean states of the driver's own files."""

import json

import pytest

from millrace.sources import bundles


def _state(tmp_path):
    bundles.initialise(str(tmp_path / "a"), {"sources": {"n": 9}, "jobs": {"rows": []}})
    (tmp_path / "a" / "sub").mkdir()
    (tmp_path / "a" / "sub" / "empty").write_bytes(b"")
    return str(tmp_path / "a")


def test_round_trip_and_receipt(tmp_path):
    state, target = _state(tmp_path), str(tmp_path / "b.tgz")
    first = bundles.pack_bundle(state, target)
    assert bundles.pack_bundle(state, target) == first and len(first["files"]) == 3
    bundles.unpack_bundle(target, str(tmp_path / "c"))
    assert bundles.recovery_receipt(state, str(tmp_path / "c"))["equal"]
    (tmp_path / "c" / "jobs.json").write_text("x")
    assert bundles.recovery_receipt(state, str(tmp_path / "c"))["differing"] == ["jobs.json"]
    with pytest.raises(bundles.BundleError, match="exists"):
        bundles.unpack_bundle(target, str(tmp_path / "c"))
    with pytest.raises(bundles.BundleError, match="exists"):
        bundles.initialise(state, {})


def test_damage_is_found(tmp_path, monkeypatch):
    state, target = _state(tmp_path), tmp_path / "b.tgz"
    bundles.pack_bundle(state, str(target))
    manifest = json.loads((tmp_path / "b.tgz.json").read_text())
    body = target.read_bytes()
    target.write_bytes(body + b"x")
    with pytest.raises(bundles.BundleError, match="isn't the one"):
        bundles.unpack_bundle(str(target), str(tmp_path / "d"))
    target.write_bytes(body)
    manifest["files"][0]["bytes"] += 1
    (tmp_path / "b.tgz.json").write_text(json.dumps(manifest))
    with pytest.raises(bundles.BundleError, match="files"):
        bundles.unpack_bundle(str(target), str(tmp_path / "d"))
    assert not (tmp_path / "d").exists() and not [p for p in tmp_path.iterdir() if p.name.startswith(".part-")]
    monkeypatch.setattr(bundles, "MAX_PLAIN", 3)
    with pytest.raises(bundles.BundleError, match="at most"):
        bundles.pack_bundle(state, str(target))
    (tmp_path / "a" / "link").symlink_to("jobs.json")
    with pytest.raises(bundles.BundleError, match="link"):
        bundles.state_inventory(state)
