"""Connected components of an edge table, without the driver and without recursion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.storage import materialize


def components(edges: DataFrame, label: str = "components", rounds: int | None = None) -> DataFrame:
    """(id, component) for the ends of ``edges`` (a, b): the smallest id that is reachable.

    Each round takes the smallest label among a node and its neighbours, then follows that label once, which halves
    the remaining paths.  Rounds are written to the shared folder, which cuts the lineage.  A frequent node costs one
    combined row per task in the minimum, and Spark splits its edges in the join.  After ``rounds`` rounds the labels
    are those of parts of components.
    """
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), label)
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")), label)
    done = 0
    while rounds is None or done < rounds:
        done += 1
        offers = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("offer"))
        taken = labels.join(offers, labels.id == offers.a, "left").select("id", F.col("component").alias("old"), F.least("component", F.coalesce("offer", "component")).alias("component"))
        step = materialize(taken, label)
        far = step.select(F.col("id").alias("_i"), F.col("component").alias("_c"))
        jumped = materialize(step.join(far, F.col("component") == F.col("_i"), "left").select("id", "old", F.least("component", F.coalesce("_c", "component")).alias("component")), label)
        labels = jumped.select("id", "component")
        if rounds is None and jumped.where("component <> old").limit(1).count() == 0:
            break
    return labels


def merge_labels(labels: DataFrame, links: DataFrame, label: str = "components") -> DataFrame:
    """Labels (id, component) after further links (a, b): only the components that they join are worked on again."""

    def named(end: str) -> DataFrame:
        return labels.select(F.col("id").alias(end), F.col("component").alias(f"c{end}"))

    joined = links.select("a", "b").join(named("a"), "a", "left").join(named("b"), "b", "left")
    between = materialize(joined.select("a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")), label)
    moved = components(between.select(F.col("ca").alias("a"), F.col("cb").alias("b")), label).withColumnsRenamed({"id": "_c", "component": "_new"})
    ends = between.select(F.col("a").alias("id"), F.col("ca").alias("component")).union(between.select(F.col("b").alias("id"), F.col("cb").alias("component"))).distinct()
    everyone = labels.union(ends.join(labels, "id", "left_anti"))
    return materialize(everyone.join(moved, F.col("component") == F.col("_c"), "left").select("id", F.coalesce("_new", "component").alias("component")), label)
