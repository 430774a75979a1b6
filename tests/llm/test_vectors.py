"""Top-k and near vectors against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantlake.llm import embedding_dedup, topk

SCHEMA = "vec_id long, embedding array<float>, label int, c0 string, rank int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, x, "c", 0) for i, v, x in rows], SCHEMA)


def odd_vectors():
    nan, inf = float("nan"), float("inf")
    return [
        (1000, None, 1), (1001, [0.5, None, 0.1], 1), (1002, [0.5, nan, 0.1], 1), (1003, [inf, 0.0, 0.1], 1), (1004, [], 1),
        (1005, [0.0, 0.0, 0.0], 1), (1006, [0.5], 1), (1007, [0.5], 1), (1008, [-0.0, 1.0, 0.0], 2), (1009, [0.0, 1.0, 0.0], 2),
        (1010, [0.0, 1.0, 0.0], None), (None, [0.0, 1.0, 0.0], 2), (1011, [0.0, 2.0, 0.0], 2), (1012, [1e30, 1e30, 1e30], 3),
        (1050, [1e-30, 1e-30, 1e-30], 3), (1100, [0.5], 9),
    ]


def good(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def some(seed, n, dims=6, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims))
    rows = [(i, (centres[i % 8] + rng.normal(size=dims) * rng.choice([0.02, 0.2, 1])).astype(np.float32).tolist(), i % labels) for i in range(n)]
    return rows + [(n + i, rows[0][1], 0) for i in range(6)]


def ints(v):
    return [int(x) for x in np.floor(256.0 * np.array(v, np.float32).astype(float))]


def dot(a, b):
    """In Python's whole numbers; what no long can hold stands as the nearest one."""
    return min(max(sum(x * y for x, y in zip(a, b)), -(2**63) + 1), 2**63 - 1)


@pytest.mark.parametrize("k,block", [(5, 8192), (3, 4), (1000, 8192)])
def test_top_k(spark, monkeypatch, k, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rows = some(1, 240) + odd_vectors()
    found = topk.top_k(table(spark, rows), F.col("vec_id") % 50 == 0, k=k)
    usable = [(i, ints(v)) for i, v, _ in rows if i is not None and good(v)]
    wanted = []
    for q, a in usable:
        if q % 50 == 0:
            scored = sorted((-dot(a, b), i) for i, b in usable if i != q and len(b) == len(a))
            wanted += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]


@pytest.mark.parametrize("size", [1e4, 1e6, 3e8, 1e13, 1e30])
def test_top_k_of_large_components(spark, size):
    rng = np.random.default_rng(int(np.log10(size)))
    scale = lambda: size ** rng.uniform(0, 1.05)
    rows = [(i, (rng.normal(size=4) * scale()).astype(np.float32).tolist(), 1) for i in range(160)]
    rows += [(200, [70000.5, 1.0], 1), (201, [70000.0, 2.0], 1), (202, [40000.0, 0.0], 1), (250, [size, -size], 1)]
    found = topk.top_k(table(spark, rows), F.col("vec_id") % 50 == 0, k=7)
    wanted = []
    for q, v, _ in rows:
        if q % 50 == 0:
            scored = sorted((-dot(ints(v), ints(w)), i) for i, w, _ in rows if i != q and len(v) == len(w))
            wanted += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:7])]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_products_beside_the_bounds_of_a_long():
    edge = 3037000500.0  # its square is just above 2**63
    queries = np.array([[edge, 0.0, 1.0], [edge - 1, 2.0, 0.0], [-edge, 1.0, 1.0], [2.0**62, 2.0**62, -1.0], [0.0, 0.0, 0.0]])
    others = np.vstack([queries, [[1.0, 1.0, 1.0], [2.0, 0.0, 1.0], [1e300, -1e300, 0.0], [2.0**64, 1.0, 5.0]]])
    whole = lambda v: [int(x) for x in v]
    wanted = [[dot(whole(a), whole(b)) for b in others] for a in queries]
    assert topk.products(queries, others).tolist() == wanted


def test_top_k_repeats_and_empty(spark):
    rows = [(50, [1.0], 1), (50, [2.0], 1), (1, [1.0], 1), (1, [1.0], 1)]
    found = topk.top_k(table(spark, rows), F.col("vec_id") % 50 == 0)
    assert [tuple(r) for r in found.collect()] == [(50, 1, 1, 65536), (50, 2, 1, 65536)]
    assert topk.top_k(table(spark, []), F.lit(True)).count() == 0
    assert topk.top_k(table(spark, [(1, [1.0], 1)]), F.col("vec_id") == 7).count() == 0


def test_bad_row_of_a_query_does_not_hide_a_good_one(spark):
    nan, inf = float("nan"), float("inf")
    good = [(50, [2.0], 1), (100, [1.0], 1), (150, [1.0], 1), (1, [1.0], 1)]
    bad = [(50, [None], 1), (50, None, 1), (100, [-inf], 1), (150, [nan], 1), (150, [inf], 1), (200, [-inf], 1)]
    found = topk.top_k(table(spark, bad + good), F.col("vec_id") % 50 == 0, k=1).collect()
    assert sorted(map(tuple, found)) == [(50, 1, 1, 131072), (100, 1, 50, 131072), (150, 1, 50, 131072)]


def brute_links(rows, threshold):
    def linked(a, b):
        if a[0] is None or b[0] is None or a[2] is None or a[2] != b[2] or not good(a[1]) or not good(b[1]) or len(a[1]) != len(b[1]):
            return False
        x, y = (np.array(v, np.float32).astype(float) for v in (a[1], b[1]))
        if not x.any() or not y.any():
            return False
        return float(x @ y / (np.linalg.norm(x) * np.linalg.norm(y))) >= threshold

    n = len(rows)
    near = {i: [j for j in range(n) if j != i and linked(rows[i], rows[j])] for i in range(n)}
    out = []
    for i in range(n):
        seen, waiting = {i}, [i]
        while waiting:
            new = [j for j in near[waiting.pop()] if j not in seen]
            seen.update(new)
            waiting += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), least, rows[i][0] is not None and rows[i][0] == least))
    return out


@pytest.mark.parametrize("threshold,tile,stripe", [(0.98, 4096, 512), (0.9, 16, 5), (0.995, 7, 3)])
def test_near_vectors(spark, monkeypatch, threshold, tile, stripe):
    monkeypatch.setattr(embedding_dedup, "TILE", tile)
    monkeypatch.setattr(embedding_dedup, "STRIPE", stripe)
    rows = some(2, 150) + odd_vectors()
    found = embedding_dedup.near_duplicates(table(spark, rows), threshold)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:3])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute_links(rows, threshold), key=key)


def test_near_vectors_empty(spark):
    assert embedding_dedup.near_duplicates(table(spark, [])).count() == 0


def test_rounding_bound():
    rng = random.Random(3)
    unit = np.array([[rng.gauss(0, 1) for _ in range(24)] for _ in range(60)])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    small, scale, error = embedding_dedup.quantised(unit)
    near = (small.astype(float) @ small.astype(float).T) * scale[:, None] * scale
    bound = error[:, None] + error + error[:, None] * error
    assert (np.abs(near - unit @ unit.T) <= bound + 1e-12).all()
