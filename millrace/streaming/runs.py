"""Running the incremental folds to the end of what has arrived, with results in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import remember, shared_dir


def arriving(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """A table of a data directory as a stream of files."""
    schema = spark.read.parquet(f"{data_dir}/{name}.parquet").schema
    # A table is one file or a folder of files.
    is_file = spark._jvm.org.apache.hadoop.fs.Path(f"{data_dir}/{name}.parquet").getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{data_dir}/{name}.parquet")).isFile()
    reader = spark.readStream.schema(schema)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(data_dir) if is_file else reader.parquet(f"{data_dir}/{name}.parquet")


def fold_available(stream: DataFrame, fold: Callable[[DataFrame | None, DataFrame], DataFrame], mode: str = "append") -> DataFrame:
    """Runs ``stream`` over all that is there; each micro-batch makes the next state from the last one.

    The state of batch N is written under its number, so a batch that runs again
    after a failure writes the same state; null is the state before the first.
    """
    spark = stream.sparkSession
    root = f"{shared_dir(spark)}/s-{uuid.uuid4().hex}"
    remember(spark, root)
    done: list[int] = []

    def step(batch: DataFrame, number: int) -> None:
        before = max((n for n in done if n < number), default=None)
        state = None if before is None else spark.read.parquet(f"{root}/state-{before}")
        fold(state, batch).write.mode("overwrite").parquet(f"{root}/state-{number}")
        if number not in done:
            done.append(number)

    query = stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{root}/checkpoint").foreachBatch(step).start()
    query.awaitTermination()
    return spark.read.parquet(f"{root}/state-{max(done)}")
