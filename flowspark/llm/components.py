"""Connected components by least labels and pointer jumping, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stash, stash


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """links: a, b (not null). Returns id, component (the least id reachable), for all ids in links.

    Each round gives a node the least label among itself and its neighbours, then that label's own
    label; labels are written to the shared folder after each round, so that a lost executor costs one
    round, and those of the round before are deleted. Only the number of changes reaches the driver. drop_stash() takes the result.
    """
    both = stash(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).filter("a <> b").distinct(), "links")
    labels = stash(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component")), "labels")
    while True:
        told = both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("c")), "b")
        least = told.groupBy(F.col("a").alias("id")).agg(F.min("c").alias("c"))
        step = labels.join(least, "id").select("id", F.col("component").alias("old"), F.least("component", "c").alias("component"))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
        step = stash(step.join(jump, "component").select("id", "old", F.least("component", "further").alias("component")), "labels")
        drop_stash(labels)
        labels = step.select("id", "component")
        labels._stash = step._stash
        if step.filter(F.col("old") != F.col("component")).limit(1).count() == 0:
            drop_stash(both)
            return labels
