"""Connected components: inside a task by arrays, across tasks by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.shared import store


def merge_roots(roots: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Roots (the smallest number of each group) after linking ``left`` to ``right``."""
    while True:
        a, b = roots[left], roots[right]
        apart = a != b
        if not apart.any():
            return roots
        left, right = np.divmod(np.unique(a[apart] * len(roots) + b[apart]), len(roots))
        np.minimum.at(roots, np.maximum(left, right), np.minimum(left, right))
        while (roots != roots[roots]).any():
            roots = roots[roots]


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; the root is the smallest node it reaches.

    Large and small stars alternate until nothing changes, which takes about log of the longest path
    rounds. Each is a minimum per node, summed up before the shuffle, and a join that adaptive
    execution can split at a hot node. Every round is stored; the driver sees two numbers of it.
    """
    a, b = edges.columns
    current = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current, before = store(current, "links"), None
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        up = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        up = up.distinct()
        down = up.join(up.groupBy("u").agg(F.min("v").alias("m")), "u")
        stars = down.select("u", F.col("m").alias("v")).unionByName(
            down.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        current = store(stars.distinct(), "links")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
