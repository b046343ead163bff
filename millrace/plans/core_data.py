"""Queries of the general training-data operators (problems 3 and 6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import split_fields, timestamps
from millrace.session import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    containers = split_fields.region_containers(table(spark, d, "regions"))
    return split_fields.split_field(table(spark, d, "jobs"), "rec_id", "location", containers).filter("n_values >= 2").select("rec_id", "seq_no", "piece")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    sources = table(spark, d, "sources")
    parts = [
        timestamps.normalise(table(spark, d, name), key, "published_at", "source_id", sources).select(F.lit(name).alias("table_name"), F.col(key).alias("row_key"), "utc_us")
        for name, key in (("jobs", "rec_id"), ("discovery_hits", "hit_id"))
    ]
    return parts[0].unionByName(parts[1])
