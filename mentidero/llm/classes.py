"""Classes of linked nodes (connected components) from links that arrive in rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentidero.llm.common import few_files, stage


def component_labels(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links` (a, b); the label is the smallest node of its component.

    Each round gives a node the smallest label around it, then that label's own label (pointer jumping), so
    rounds grow with the logarithm of a path's length. Nodes meet their neighbours' labels as minima, which
    combine inside each task first; a node with many links is no hot task.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    n = 2 * links.count()
    first = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = stage(few_files(first.select("node", F.least("node", "near").alias("label")), n), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "label")
        lower = labels.unionByName(near).groupBy("node").agg(F.min("label").alias("label"))
        root = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        lowest = lower.join(root, "label", "left").select("node", F.least("label", "jump").alias("label"))
        now = stage(few_files(lowest, n), "labels")
        moved = now.exceptAll(labels).limit(1).count()
        labels = now
        if not moved:
            return labels


def merge_labels(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after more links: only the links between different classes are worked on, class by class."""
    if labels is None:
        return component_labels(links)
    of = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")
    )
    between = stage(few_files(ends.where("a <> b").distinct(), max(1, links.count())), "links")
    if not between.limit(1).count():
        return labels
    moved = component_labels(between)
    old = labels.select("node", F.col("label").alias("was"))
    renamed = old.join(moved.select(F.col("node").alias("was"), F.col("label").alias("now")), "was", "left")
    known = renamed.select("node", F.coalesce("now", "was").alias("label"))
    new = moved.join(labels, "node", "left_anti")
    return stage(few_files(known.unionByName(new), labels.count() + moved.count()), "labels")
