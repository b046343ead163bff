"""Connected components of a link table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize


def components(links: DataFrame, max_rounds: int = 40) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b`` of one type).

    Small-star rounds: every node takes the smallest label around it and then
    the label of that label, which halves paths; each round is written to the
    shared folder.  Null ends are dropped.
    """
    edges = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = materialize(edges.union(edges.select("b", "a")).distinct().toDF("node", "other"))
    labels = materialize(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component")))
    for _ in range(max_rounds):
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("near"))
        step = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("far"))
        moved = step.join(jump, "to", "left").select("node", F.least("to", F.coalesce("far", "to")).alias("next"), "component")
        moved = materialize(moved.select("node", F.col("next").alias("component"), (F.col("next") != F.col("component")).alias("changed")))
        labels = moved.select("node", "component")
        if moved.filter("changed").limit(1).count() == 0:
            return labels
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
