"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import keep


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links(a, b)``; the component is the smallest id that can be reached.

    Labels only ever fall. Each round takes the smallest label of the neighbours (a sum-like aggregate, so a node
    with very many links is reduced before the shuffle) and then follows the label's own label, which halves long
    chains. Every round is written to the shared folder. Links with a null end are ignored; no links give no rows.
    """
    links = links.where("a is not null and b is not null and a <> b")
    edges = keep(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = keep(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")), "labels")
    while True:
        near = edges.join(labels, edges.b == labels.id).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(near, labels.id == near.a).select("id", F.col("component").alias("old"), F.least("component", "near").alias("seen"))
        jump = labels.select(F.col("id").alias("seen"), F.col("component").alias("beyond"))
        step = step.join(jump, "seen").select("id", "old", F.least("seen", "beyond").alias("component"))
        step = keep(step, "labels")
        labels = step.select("id", "component")
        if step.where("component <> old").isEmpty():
            return labels
