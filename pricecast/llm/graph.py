"""Connected components by repeated minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricecast.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    edges: columns a, b (bigint), in any direction, repeats allowed. Returns id, root. Every round takes the least
    label among neighbours and then the label's own label, so long chains shrink by doubling. Each round is written
    to the shared folder, which cuts lineage and survives lost executors. Joins are merges: labels and edges grow with the
    table, and files of numbers look smaller to Spark than they are in the driver that would broadcast them.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.filter("a <> b").distinct(), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "root").hint("merge"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("m"))
        step = labels.join(near.hint("merge"), "id").select("id", F.col("root").alias("old"), F.least("root", "m").alias("root"))
        jump = labels.select(F.col("id").alias("root"), F.col("root").alias("up"))
        step = step.join(jump.hint("merge"), "root", "left").select("id", "old", F.least("root", F.coalesce("up", "root")).alias("root"))
        step = materialise(step, "labels")
        labels = step.select("id", "root")
        if step.filter("root <> old").isEmpty():
            return labels
