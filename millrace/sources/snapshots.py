"""Versioned snapshots on the shared file system: whole tables per attempt, an atomic commit, integrity by full comparison."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class RevisionConflict(RuntimeError):
    """The snapshot moved on since it was read."""


class SnapshotStore:
    """Tables under ``root/attempt=…``; ``root/_commits/N`` names the attempt that is revision N.

    Every writer writes into a folder of its own.  A commit creates the marker
    of the next revision, which the Hadoop file system lets only one writer do,
    on any store whose create-if-absent is atomic (HDFS, local disks; on object
    stores with a committer that makes it so).  Markers and attempts are never
    overwritten; the highest marker holds.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = lambda *parts: spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))
        self._fs = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def revision(self) -> int:
        folder = self._path("_commits")
        if not self._fs.exists(folder):
            return 0
        return max((int(s.getPath().getName()) for s in self._fs.listStatus(folder) if s.getPath().getName().isdigit()), default=0)

    def _manifest(self, revision: int) -> dict:
        return json.loads("\n".join(r[0] for r in self.spark.read.text("/".join((self.root, "_commits", str(revision)))).collect()))

    def read(self, name: str, schema: str, revision: int | None = None) -> DataFrame:
        """A table of the current or a given revision; one it doesn't have is empty."""
        found = self.revision() if revision is None else revision
        where = self._manifest(found)["tables"].get(name) if found else None
        return self.spark.read.schema(schema).parquet(f"{self.root}/{where}") if where else self.spark.createDataFrame([], schema)

    def commit(self, expected: int, tables: dict[str, DataFrame]) -> int:
        """Writes ``tables`` as the revision after ``expected``; tables that aren't given stay as they were."""
        if self.revision() != expected:
            raise RevisionConflict(f"expected revision {expected}, found {self.revision()}")
        kept = self._manifest(expected)["tables"] if expected else {}
        attempt = f"attempt={uuid.uuid4().hex}"
        for name, df in tables.items():
            df.write.parquet(f"{self.root}/{attempt}/{name}")
        body = json.dumps({"revision": expected + 1, "tables": kept | {name: f"{attempt}/{name}" for name in tables}})
        try:
            out = self._fs.create(self._path("_commits", str(expected + 1)), False)
        except Py4JJavaError as e:
            self._fs.delete(self._path(attempt), True)
            raise RevisionConflict(f"revision {expected} was committed by another writer") from e
        try:
            out.write(bytearray(body, "utf-8"))
        finally:
            out.close()
        return expected + 1

    def transaction(self, mutate, attempts: int = 5) -> int:
        """Applies ``mutate(store, revision) -> tables`` to the current revision, anew if another writer was faster."""
        for left in reversed(range(attempts)):
            revision = self.revision()
            try:
                return self.commit(revision, mutate(self, revision))
            except RevisionConflict:
                if not left:
                    raise
        raise AssertionError("unreachable")


def artifacts(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Content-addressed bodies (``hash, body, bytes``, each once) and their observations (``hash, source_id, url``)."""
    rows = responses.filter(F.col("body").isNotNull()).select("source_id", "url", "body", F.sha2(F.col("body").cast("binary"), 256).alias("hash"))
    return rows.groupBy("hash").agg(F.first("body").alias("body"), F.max(F.octet_length("body")).cast("long").alias("bytes")), rows.select("hash", "source_id", "url")


def intact(stored: DataFrame) -> DataFrame:
    """The artifacts whose body still has its hash."""
    return stored.filter(F.sha2(F.col("body").cast("binary"), 256) == F.col("hash"))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """``path, bytes, sha256`` of all files below ``root``, relative paths."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(F.regexp_replace("path", rf"^(?:file:)?/*{root.strip('/')}/", "").alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Files missing or different on either side; empty if both are equal."""
    a, b = left.select("path", F.struct("bytes", "sha256").alias("a")), right.select("path", F.struct("bytes", "sha256").alias("b"))
    return a.join(b, "path", "full").filter(~F.col("a").eqNullSafe(F.col("b")))
