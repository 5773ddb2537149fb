"""Connected components of a distributed graph."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.session import staged


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node that has an edge to another; root is the smallest node of its component.

    Alternates two steps until nothing changes: link the larger neighbours of a node to its smallest neighbour,
    then link the smaller neighbours of a node, and the node, to the smallest of them. Both keep the components
    and end in stars around the smallest nodes. No step holds a node's neighbours together: minima are combined
    before the shuffle, and the joins on a node with many edges can be split. Every round is written to the
    shared folder. Null nodes and loops are no edges.
    """
    edge = edges.select(F.greatest(left, right).alias("child"), F.least(left, right).alias("parent"))
    current = staged(edge.where(f"{left} is not null and {right} is not null and child > parent").distinct(), "edges")
    seen = _digest(current)
    while seen[0]:
        both = current.union(current.select("parent", "child")).toDF("node", "near")
        least = both.groupBy("node").agg(F.min("near").alias("near_min"))
        large = (
            both.where("near > node")
            .join(least, "node")
            .select(F.col("near").alias("child"), F.least("node", "near_min").alias("parent"))
            .distinct()
        )
        smallest = large.groupBy("child").agg(F.min("parent").alias("parent_min"))
        small = (
            large.join(smallest, "child")
            .select(
                F.when(F.col("parent") == F.col("parent_min"), F.col("child")).otherwise(F.col("parent")).alias("child"),
                F.col("parent_min").alias("parent"),
            )
            .distinct()
        )
        current = staged(small, "edges")
        now = _digest(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("parent").alias("node"), F.col("parent").alias("root")).distinct()
    return current.select(F.col("child").alias("node"), F.col("parent").alias("root")).union(roots)


def _digest(edges: DataFrame) -> tuple:
    """Number and checksum of the edges: one row."""
    sums = [F.sum(F.xxhash64("child", "parent", F.lit(seed)).cast("decimal(20,0)")) for seed in (1, 2)]
    return tuple(edges.agg(F.count("*"), *sums).first())


def least_labels(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n nodes in a task the smallest node that it reaches over the edges."""
    labels = np.arange(n)
    while True:
        low = np.minimum(labels[left], labels[right])
        after = labels.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if (after == labels).all():
            return labels
        labels = after
