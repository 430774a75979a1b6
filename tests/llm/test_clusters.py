"""Clusters against loops over Python's whole numbers."""

import hashlib
import math
import random

import pytest

from plantlake.llm import clusters, queries

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, distance long, v int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 7, 7, 7) for i, v in rows], SCHEMA)


def vectors(seed, n, dims):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    return [(i, [c + rng.gauss(0, 0.3) for c in centres[i % 5]]) for i in range(n)]


def brute(rows, k, rounds, dims, scale, single):
    def whole(v):
        return tuple(math.floor(scale * x) for x in v)

    kept = [
        (i, whole(single(v))) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def near(v):
        return min((sum((x - c) ** 2 for x, c in zip(v, centre)), n) for n, centre in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for n, group in groups.items():
            centroids[n] = [sum(column) // len(group) for column in zip(*group)]
    found = [(i, *reversed(near(v))) for i, v in kept]
    totals = {}
    for _, n, d in found:
        totals[n] = totals.get(n, 0) + d
    return sorted(((i, n, d, totals[n], sum(totals.values())) for i, n, d in found), key=repr), centroids


def as_float32(v):
    import numpy as np

    return [float(x) for x in np.array(v, np.float32)]


nan, inf = float("nan"), float("inf")
ODD = [(None, [0.5] * 4), (900, None), (901, [0.5, None, 1.0, 1.0]), (902, [nan, 1.0, 1.0, 1.0]), (903, [inf] * 4), (904, []),
       (905, [1.0] * 3), (906, [-0.0] * 4), (906, [-0.0] * 4), (906, [2.0] * 4), (907, [1e6, -1e6, 3.0, 0.0])]


@pytest.mark.parametrize("k,rounds,n", [(16, 3, 200), (3, 2, 40), (16, 3, 4), (2, 0, 20)])
def test_equals_loops(spark, k, rounds, n):
    rows = vectors(k + n, n, 4) + ODD
    found, centroids = clusters.cluster(table(spark, rows), k=k, rounds=rounds, dims=4, scale=64.0)
    wanted, centres = brute(rows, k, rounds, 4, 64.0, as_float32)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia"]
    assert centroids == centres
    assert sorted(map(tuple, found.collect()), key=repr) == wanted


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(i, [1.0, 0.0]) for i in range(20)] + [(20, [3.0, 0.0])]
    found, centroids = clusters.cluster(table(spark, rows), k=16, rounds=3, dims=2)
    wanted, centres = brute(rows, 16, 3, 2, 64.0, list)
    assert centroids == centres and sorted(map(tuple, found.collect()), key=repr) == wanted


def test_wide_sums_and_distances(spark):
    rows = [(i, [1e15 + i, -1e15]) for i in range(300)] + [(1000, [1e17, 0.0])]
    found, centroids = clusters.cluster(table(spark, rows), k=1, rounds=1, dims=2)
    _, centres = brute(rows, 1, 1, 2, 64.0, as_float32)
    assert centroids == centres
    assert {r.distance for r in found.collect()} <= {clusters.LARGEST}


def test_nothing_kept(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        found, centroids = clusters.cluster(table(spark, rows))
        assert found.collect() == [] and centroids == []


def test_query(spark, tmp_path):
    rows = vectors(9, 60, 64)
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op12_centroid_clusters(spark, str(tmp_path)).collect()
    wanted, centres = brute(rows, 16, 3, 64, 64.0, as_float32)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    assert sorted((tuple(r) for r in found), key=repr) == sorted(((*w, digests[w[1]]) for w in wanted), key=repr)
    table(spark, []).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert queries.op12_centroid_clusters(spark, f"{tmp_path}/none").collect() == []
