"""Small states as one file: a compressed bundle with its manifest, and a receipt that a restored state equals its source.

For the driver's own files (seeds, exports, recovery copies of bounded size);
tables live in ``snapshots``.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import os
import shutil
import tarfile
import tempfile
from pathlib import Path

# The largest bundle, compressed and plain.
MAX_PACKED, MAX_PLAIN = 90 << 20, 512 << 20


class BundleError(ValueError):
    """A bundle, manifest or state that isn't what it says."""


def state_inventory(root: str) -> list[dict]:
    """``path, bytes, sha256`` of every file below ``root``, by path; links are an error."""
    out = []
    for path in sorted(Path(root).rglob("*")):
        if path.is_symlink():
            raise BundleError(f"{path} is a link")
        if path.is_file():
            body = path.read_bytes()
            out.append({"path": path.relative_to(root).as_posix(), "bytes": len(body), "sha256": hashlib.sha256(body).hexdigest()})
    return out


def _replace_together(files: dict[Path, bytes]) -> None:
    """All files or none: each is written beside its place first, and put back if a later one fails."""
    parts, kept = {}, {}
    try:
        for path, body in files.items():
            handle, part = tempfile.mkstemp(dir=path.parent, prefix=".part-")
            with os.fdopen(handle, "wb") as f:
                f.write(body)
            parts[path] = part
            kept[path] = path.read_bytes() if path.exists() else None
        done = []
        try:
            for path, part in parts.items():
                os.replace(part, path)
                done.append(path)
        except OSError:
            for path in done:
                path.unlink() if kept[path] is None else path.write_bytes(kept[path])
            raise
    finally:
        for part in parts.values():
            Path(part).unlink(missing_ok=True)


def pack_bundle(root: str, target: str) -> dict:
    """Packs the files below ``root`` into ``target`` (tar, gzip) and ``target + '.json'``; equal states give equal bytes."""
    files = state_inventory(root)
    if (plain := sum(f["bytes"] for f in files)) > MAX_PLAIN:
        raise BundleError(f"{plain} bytes, at most {MAX_PLAIN}")
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w", format=tarfile.PAX_FORMAT) as tar:
        for f in files:
            info = tarfile.TarInfo(f["path"])
            info.size = f["bytes"]
            tar.addfile(info, io.BytesIO((Path(root) / f["path"]).read_bytes()))
    packed = gzip.compress(raw.getvalue(), 9, mtime=0)
    if len(packed) > MAX_PACKED:
        raise BundleError(f"{len(packed)} bytes packed, at most {MAX_PACKED}")
    manifest = {"packed_sha256": hashlib.sha256(packed).hexdigest(), "packed_bytes": len(packed), "plain_sha256": hashlib.sha256(raw.getvalue()).hexdigest(), "files": files}
    out = Path(target)
    _replace_together({out: packed, out.with_name(out.name + ".json"): json.dumps(manifest, sort_keys=True).encode()})
    return manifest


def unpack_bundle(target: str, root: str) -> dict:
    """Restores a bundle into ``root``, which must not exist; digests, sizes and every file are checked before it appears."""
    out, where = Path(target), Path(root)
    if where.exists():
        raise BundleError(f"{root} exists")
    manifest = json.loads(out.with_name(out.name + ".json").read_text())
    packed = out.read_bytes()
    if len(packed) > MAX_PACKED or hashlib.sha256(packed).hexdigest() != manifest["packed_sha256"]:
        raise BundleError("the bundle isn't the one of its manifest")
    with gzip.open(io.BytesIO(packed)) as f:
        raw = f.read(MAX_PLAIN + (64 << 20))
    if hashlib.sha256(raw).hexdigest() != manifest["plain_sha256"]:
        raise BundleError("the bundle's content isn't the one of its manifest")
    part = Path(tempfile.mkdtemp(dir=where.parent, prefix=".part-"))
    try:
        with tarfile.open(fileobj=io.BytesIO(raw)) as tar:
            tar.extractall(part, filter="data")
        if state_inventory(str(part)) != manifest["files"]:
            raise BundleError("the files aren't those of the manifest")
        os.replace(part, where)
    finally:
        shutil.rmtree(part, ignore_errors=True)
    return manifest


def recovery_receipt(source: str, restored: str) -> dict:
    """Whether two states hold the same files, and what differs; the same states give the same receipt."""
    a, b = ({f["path"]: f for f in state_inventory(x)} for x in (source, restored))
    differing = sorted(p for p in a.keys() | b.keys() if a.get(p) != b.get(p))
    digest = hashlib.sha256(json.dumps([a[p] for p in sorted(a)], sort_keys=True).encode()).hexdigest()
    return {"equal": not differing, "differing": differing, "files": len(a), "bytes": sum(f["bytes"] for f in a.values()), "state_sha256": digest}


def initialise(root: str, seeds: dict[str, dict]) -> dict:
    """A clean state of the given documents in ``root``, complete or not at all; an existing one is an error."""
    where = Path(root)
    if where.exists():
        raise BundleError(f"{root} exists")
    where.parent.mkdir(parents=True, exist_ok=True)
    part = Path(tempfile.mkdtemp(dir=where.parent, prefix=".part-"))
    try:
        for name, document in seeds.items():
            (part / f"{name}.json").write_text(json.dumps(document, sort_keys=True, ensure_ascii=False), encoding="utf-8")
        if len(state_inventory(str(part))) != len(seeds):
            raise BundleError("not every document was written")
        os.replace(part, where)
    finally:
        shutil.rmtree(part, ignore_errors=True)
    return recovery_receipt(root, root)
