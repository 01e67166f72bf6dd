"""Connected components of a table of links, by minimum labels and pointer jumping on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_scratch, store


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node reachable.

    Each turn takes the least label among a node and its neighbours, then the label's own label.
    Labels only fall, and the loop ends when none did. Null ends are left out; no links, no rows.
    """
    links = links.where("a IS NOT NULL AND b IS NOT NULL")
    both, _ = store(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels, path = store(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        least = labels.join(near, labels.node == near.a).select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("_far"))
        new, new_path = store(least.join(jump, "next").select("node", F.col("label").alias("_old"), F.least("next", "_far").alias("label")), "labels")
        changed = not new.where("label <> _old").isEmpty()
        drop_scratch(links.sparkSession, path)
        labels, path = new.select("node", "label"), new_path
        if not changed:
            return labels
