"""Connected components of a graph of links, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.scratch import store


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) to one row per linked node: node, component (its smallest reachable node).

    Every round lets each node point at its smallest neighbour, follows pointers until all end at a root, and
    replaces the links by links between roots; at least half of the nodes are gone after a round. Links are
    undirected; loops, repeats and nulls are ignored. Nothing reaches the driver but whether rows are left.
    """
    spark = links.sparkSession
    rest = store(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not rest.isEmpty():
        both = rest.union(rest.select("b", "a"))
        pointers = store(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("root")), "pointers")
        moved = True
        while moved:
            above = pointers.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            pointers = store(pointers.join(above, "root").select(
                "node", F.col("higher").alias("root"), (F.col("higher") != F.col("root")).alias("moved")), "pointers")
            moved = not pointers.where("moved").isEmpty()
            pointers = pointers.select("node", "root")
        if labels is None:
            labels = pointers
        else:
            step = pointers.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            labels = store(labels.join(step, "root", "left").select("node", F.coalesce("higher", "root").alias("root")), "labels")
        of_a, of_b = (pointers.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab")
        rest = store(rest.join(of_a, "a").join(of_b, "b").where("root_a <> root_b").select(
            F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "links")
    if labels is None:
        return spark.createDataFrame([], "node long, component long")
    return labels.select("node", F.col("root").alias("component"))
