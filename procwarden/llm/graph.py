"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procwarden.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of a link (a, b); a component is its smallest node.

    In each round a node joins its smallest neighbour and links are renamed; a link
    between two names remains until their groups have met, so names only go down and
    the number of linked names at least halves.  Links with a null end, or from a node
    to itself, do nothing.  Smallest neighbours are taken before rows move, and joins
    on a node with very many links are split as skewed ones.
    """
    edges = cut_lineage(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        step = cut_lineage(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("to")))
        edges = cut_lineage(
            edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("_a")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("_b")), "b").where("_a != _b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct())
        if labels is None:
            labels = step.withColumnRenamed("to", "component")
        else:
            moved = step.where("node != to").withColumnsRenamed({"node": "component", "to": "_to"})
            labels = cut_lineage(labels.join(moved, "component", "left").select(
                "node", F.coalesce("_to", "component").alias("component")))
    if labels is None:
        return links.sparkSession.createDataFrame([], "node long, component long")
    return labels
