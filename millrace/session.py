"""Session helpers: table access and materialisation into the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where the session leaves it unset (tests on one machine) a temporary
    folder is made and removed at exit.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="millrace-")
    atexit.register(shutil.rmtree, made, True)
    spark.conf.set("spark.checkpoint.dir", f"file://{made}")
    return f"file://{made}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back.

    Cuts lineage and survives lost executors; used where two branches consume
    the same costly or order-dependent intermediate result.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    remember(spark, path)
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []


def remember(spark: SparkSession, path: str) -> None:
    """Has ``release`` delete ``path``."""
    if not _written:
        atexit.register(release, spark)
    _written.append(path)


def release(spark: SparkSession) -> None:
    """Deletes what ``materialize`` wrote in this process; results that read it must be done.  Runs at exit as well."""
    while _written:
        path = _written.pop()
        try:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # the session has ended already
            return


def broadcast_within(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint, given only if ``df`` really has at most ``rows`` rows.

    The count stops at the bound; beyond it the planner is left to choose a
    shuffled join.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
