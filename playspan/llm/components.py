"""Connected components of an edge table, as a Spark loop over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from playspan.session import stage


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over ``edges`` (a, b), for ids on an edge.

    Each round gives a node the smallest label of its neighbours and then the label of that
    label, so distances about halve; it ends when no label changes. Labels are written to
    the shared scratch folder each round, so a lost executor costs one round at most.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.where("a <> b").distinct(), "edges")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("id"), F.least("a", "m").alias("component")
    ), "labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["id"])
            .groupBy("a").agg(F.min("component").alias("m"))
        )
        hooked = labels.join(near, labels["id"] == near["a"], "left").select(
            "id", F.col("component").alias("was"), F.least("component", F.coalesce("m", "component")).alias("component")
        )
        top = labels.select(F.col("id").alias("t"), F.col("component").alias("up"))
        jumped = hooked.join(top, hooked["component"] == top["t"], "left").select(
            "id", "was", F.least("component", F.coalesce("up", "component")).alias("component")
        )
        jumped = stage(jumped, "labels")
        changed = jumped.where("component <> was").limit(1).count()
        labels = jumped.select("id", "component")
        if not changed:
            return labels
