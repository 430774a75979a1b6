"""Centroid clustering in JVM expressions.

Vectors and centroids are integers. The centroids, few and small, are a literal of the plan: a vector's
squared distance to each is ``aggregate`` over ``zip_with``, and the least struct of distance and number is
its cluster. New centroids come from plain sums of the components, added up in every task before
the shuffle; the driver gets one row per cluster.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.llm.shared import store

LARGEST = 2**63 - 1

Centroids = list[list[int]]


def integers(vector: Column, scale: float) -> Column:
    """floor(scale * x) of each component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column, dims: int) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def nearest(vector: str, centroids: Centroids) -> Column:
    """Struct of the least squared distance and, of equally near centroids, the smallest number.

    A distance that no long can hold counts as the largest long. Given to Spark as one text: a thousand
    literals built one by one take seconds on the driver.
    """
    literal = ", ".join(f"array({', '.join(f'{x}L' for x in c)})" for c in centroids)
    total = f"""aggregate(
        zip_with({vector}, c, (x, y) -> try_subtract(x, y)), 0L, (s, d) -> try_add(s, try_multiply(d, d)))"""
    return F.expr(
        f"""array_min(transform(array({literal}),
            (c, i) -> struct(coalesce({total}, {LARGEST}L) AS distance, i AS cluster)))"""
    )


def first_centroids(kept: DataFrame, k: int, seed: str) -> Centroids:
    """The ``k`` vectors whose sha256 of ``seed:<id>`` comes first; null ids last, ties by vector."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = kept.select("v", order.alias("_hash")).orderBy(F.col("_hash").asc_nulls_last(), "v").limit(k)
    return [list(row["v"]) for row in chosen.collect()]


def moved(kept: DataFrame, centroids: Centroids, wide: bool) -> Centroids:
    """Centroids after one round: floor(sum / count) by component, in whole numbers of any size."""
    dims = len(centroids[0])
    assigned = kept.select("v", nearest("v", centroids)["cluster"].alias("cluster"))
    kind = "decimal(38,0)" if wide else "long"
    sums = [F.expr(f"sum(cast(v[{i}] AS {kind})) AS s{i}") for i in range(dims)]
    out = [list(c) for c in centroids]
    for row in assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        out[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dims)]
    return out


def fingerprint(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: float = 64.0, seed: str = "1",
    vec_id: str = "vec_id", vector: str = "embedding",
) -> tuple[DataFrame, Centroids]:
    """(vec_id, cluster, distance, cluster_inertia, inertia) of every kept vector, and the centroids.

    Kept are vectors of ``dims`` components that are all finite numbers; components become
    floor(scale * x). ``rounds`` times every vector goes to its nearest centroid (ties: the
    smaller number) and every centroid that has vectors moves to their mean, rounded down; then
    vectors are assigned once more. Fewer kept vectors than ``k`` give so many centroids, none no rows.
    Rows with a null id are clustered like others but are the last to start a centroid; repeated rows count
    each time; other columns are left out. A distance or sum beyond a long is given as the largest long.
    The kept vectors are stored once, as integers, and read in every round; what is collected is k rows.
    """
    kept = vectors.where(usable(vectors[vector], dims)).select(
        vectors[vec_id].alias("vec_id"), integers(vectors[vector], scale).alias("v")
    )
    kept = store(kept, "integer-vectors")
    reach = F.max(F.greatest(F.array_max("v"), -(F.array_min("v") + 1)))
    rows, largest = kept.agg(F.count(F.lit(1)), reach).first()
    centroids = first_centroids(kept, k, seed)
    if not centroids:
        none = kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return none.withColumns({"cluster_inertia": F.col("distance"), "inertia": F.col("distance")}), []
    for _ in range(rounds):
        centroids = moved(kept, centroids, wide=rows * (largest + 1) > LARGEST)
    assigned = kept.select("vec_id", nearest("v", centroids).alias("_n"))
    assigned = store(assigned.select("vec_id", "_n.cluster", "_n.distance"), "assigned")
    # One row per cluster: at most k come to the driver and go out as literals.
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()
    by_cluster = {row["cluster"]: int(row["n"]) for row in sums}
    own = ", ".join(f"{min(by_cluster.get(i, 0), LARGEST)}L" for i in range(len(centroids)))
    assigned = assigned.withColumns({
        "cluster_inertia": F.expr(f"array({own})[cluster]"),
        "inertia": F.lit(min(sum(by_cluster.values()), LARGEST)).cast("long"),
    })
    return assigned.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia"), centroids
