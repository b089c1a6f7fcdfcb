"""Connected components of links, as DataFrame jobs with written tables between the rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closeworks.llm.store import written


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that links (a, b) reach, for each id that has a link to another.

    Each round takes the smallest label of the neighbours and then follows the labels once, so that distances
    halve. Both steps combine before they shuffle, and one id may have any number of links.
    """
    links = links.where("a <> b").select("a", "b")
    edges = written(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        near = (
            edges.join(labels.select(F.col("id").alias("b"), F.col("label").alias("near")), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("near").alias("near"))
        )
        step = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("to"))
        step = written(step, "labels")
        ahead = step.select(F.col("id").alias("to"), F.col("to").alias("further"))
        jumped = step.join(ahead, "to", "left").select(
            "id", "label", F.least("to", F.coalesce("further", "to")).alias("to")
        )
        jumped = written(jumped, "labels")
        moved = jumped.where("label <> to").limit(1).count()
        labels = jumped.select("id", F.col("to").alias("label"))
        if not moved:
            return labels.select("id", F.col("label").alias("component"))
