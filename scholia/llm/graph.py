"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scholia.session import cut_lineage, release


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a``, ``b``; bigint): the smallest node it can reach.

    Each round every node, and the node that it is labelled with, takes the smallest label among its
    neighbours', then the label of its label. Labels and links are written tables, so a node with very
    many links is a hot key that adaptive execution splits; minima are reduced before they move.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = cut_lineage(both)
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("near")), "b")
        met = near.join(labels.select(F.col("node").alias("a"), F.col("label").alias("own")), "a").where("near < own")
        told = met.select(F.explode(F.array("a", "own")).alias("node"), "near").groupBy("node").agg(F.min("near").alias("near"))
        told = cut_lineage(told)
        if told.isEmpty():
            release(both, told)
            return labels
        new = labels.join(told, "node", "left").select("node", F.least("label", F.coalesce("near", "label")).alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = new.join(jump, "label", "left").select("node", F.least("label", F.coalesce("next", "label")).alias("label"))
        old, labels = labels, cut_lineage(new)
        release(old, told)
