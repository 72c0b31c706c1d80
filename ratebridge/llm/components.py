"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): for each node of the links (a, b), the smallest node it is connected with.

    Every round points each node at its smallest neighbour, follows pointers one
    step, and contracts the links to what is left between different groups; a
    star is done in one round, a path in a number of rounds that grows with the
    logarithm of its length. Tables are checkpointed, so lineage stays short and
    a lost executor costs no earlier round. Null ends are left out; links of a
    node with itself, repeats and both directions are allowed.
    """
    links = links.filter("a IS NOT NULL AND b IS NOT NULL")
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().checkpoint()
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = nodes.withColumn("component", F.col("node")).checkpoint()
    edges = edges.filter("a < b")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("node", "next")
        parents = both.groupBy("node").agg(F.min("next").alias("next")).select("node", F.least("node", "next").alias("parent"))
        above = parents.toDF("parent", "top")
        parents = parents.join(above, "parent", "left").select("node", F.coalesce("top", "parent").alias("parent")).checkpoint()
        moved = labels.join(parents.toDF("component", "to"), "component", "left")
        labels = moved.select("node", F.coalesce("to", "component").alias("component")).checkpoint()
        edges = edges.join(parents.toDF("a", "pa"), "a").join(parents.toDF("b", "pb"), "b")
        edges = edges.filter("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct().checkpoint()
    return labels
