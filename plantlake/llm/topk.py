"""Exact top-k search by distributed histogram selection.

All candidates are scored against a block of queries. A first pass counts scores in coarse steps, and
each further pass counts again inside the step that holds a query's k-th score, until it is known
exactly. A last pass keeps what is above it and, of what ties with it, the smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlake.config import shared_folder
from plantlake.llm.shared import on_executors, store

#: Queries that go out at once, about; bounds what is broadcast and what a task holds.
BLOCK = 8192
BINS = 256
#: Vectors scored at once inside a task.
STRIPE = 2048
QUERY_STRIPE = 512
#: Sums of products up to here are exact in doubles.
EXACT = float(1 << 53)
#: Scores beyond a long stand as these; below both is what a query's own row gets.
HIGHEST, LOWEST = (1 << 63) - 1, 1 - (1 << 63)
NONE = -(1 << 63)

RESULT = "query_id long, vec_id long, score long"


def scaled(vectors: pa.Array, factor: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: rows and floor(factor * x) of the vectors that are not null and have finite numbers only."""
    lengths = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    out = {}
    for n in np.unique(lengths[lengths >= 0]):
        rows = np.flatnonzero(lengths == n)
        flat = vectors.take(pa.array(rows)).flatten().cast(pa.float64())
        values = flat.to_numpy(zero_copy_only=False).reshape(len(rows), n)
        good = np.isfinite(values).all(1)
        with np.errstate(over="ignore"):
            # What no double can hold is far beyond a long.
            out[int(n)] = rows[good], np.clip(np.floor(factor * values[good]), -1e300, 1e300)
    return out


def as_longs(values: np.ndarray) -> np.ndarray:
    """Whole numbers modulo 2**64."""
    large = np.abs(values) >= 2.0**63
    out = np.where(large, 0, values).astype(np.int64)
    if large.any():
        wrapped = [int(x) & 0xFFFFFFFFFFFFFFFF for x in values[large]]
        out[large] = np.array(wrapped, np.uint64).view(np.int64)
    return out


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as longs, exact wherever they fit.

    Doubles hold them where the numbers are small. Elsewhere long arithmetic gives them modulo 2**64, and
    doubles tell which are beyond a long; where they cannot tell, Python's whole numbers do.
    """
    most = np.abs(queries).max(initial=0.0)
    # A vector of zeros only is small whatever it meets.
    with np.errstate(over="ignore"):
        small = np.abs(candidates).max(1, initial=0.0) * most * max(queries.shape[1], 1) < EXACT
    out = np.empty((len(queries), len(candidates)), np.int64)
    if small.any():
        out[:, small] = (queries @ candidates[small].T).astype(np.int64)
    if not small.all():
        large = candidates[~small]
        exact = as_longs(queries) @ as_longs(large).T
        with np.errstate(over="ignore", invalid="ignore"):
            near = queries @ large.T
            error = np.abs(queries) @ np.abs(large).T * ((queries.shape[1] + 2) * 2.0**-52)
            beyond = np.abs(near) - error >= 2.0**63
            unsure = ~(beyond | (np.abs(near) + error < 2.0**63))
            exact[beyond] = np.where(near > 0, HIGHEST, LOWEST)[beyond]
        for q, c in np.argwhere(unsure):
            true = sum(int(x) * int(y) for x, y in zip(queries[q], large[c], strict=True))
            exact[q, c] = min(max(true, LOWEST), HIGHEST)
        out[:, ~small] = np.maximum(exact, LOWEST)
    return out


class Queries:
    """A block of queries by vector length, with the state of the search."""

    def __init__(self, ids: np.ndarray, vectors: pa.Array, factor: float):
        self.groups = {}
        for n, (rows, values) in scaled(vectors, factor).items():
            order = np.argsort(ids[rows])
            self.groups[n] = ids[rows][order], values[order]

    def scores(self, batches: Iterator[pa.RecordBatch], factor: float):
        """(length, first query, candidate ids, scores: queries by candidates) of every stripe.

        A query's own row scores NONE, below all others.
        """
        for rows in batches:
            ids = rows.column(0).to_numpy()
            for n, (at, values) in scaled(rows.column(1), factor).items():
                if n not in self.groups:
                    continue
                query_ids, query_values = self.groups[n]
                for a in range(0, len(at), STRIPE):
                    own, block = ids[at[a : a + STRIPE]], values[a : a + STRIPE]
                    for q in range(0, len(query_ids), QUERY_STRIPE):
                        some = query_ids[q : q + QUERY_STRIPE]
                        found = products(query_values[q : q + QUERY_STRIPE], block)
                        place = np.minimum(np.searchsorted(some, own), len(some) - 1)
                        same = np.flatnonzero(some[place] == own)
                        found[place[same], same] = NONE
                        yield n, q, own, found


def _norms(batches: Iterator[pa.RecordBatch], factor: float) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        with np.errstate(over="ignore"):
            largest = [np.sqrt((v * v).sum(1).max()) for _, v in scaled(rows.column(1), factor).values() if len(v)]
        yield pa.RecordBatch.from_arrays([pa.array([max(largest, default=0.0)])], ["norm"])


def _histogram(batches: Iterator[pa.RecordBatch], sent, factor: float, k: int) -> Iterator[pa.RecordBatch]:
    """Counts per query and step. Steps below the one in which this task alone reaches k are left out:
    the k-th score of all is not below its k-th score here."""
    queries, state = sent.value
    counts = {n: np.zeros((len(ids), BINS), np.int64) for n, (ids, _) in queries.groups.items()}
    for n, q, _, found in queries.scores(batches, factor):
        low, width, top = (x[q : q + len(found), None] for x in state[n])
        inside = (found >= low) & (found <= top)
        # Unsigned, as the whole range of longs is one step too wide for a long.
        step = ((found.view(np.uint64) - low.view(np.uint64)) // width).astype(np.int64)
        flat = (np.arange(len(found))[:, None] * BINS + step)[inside]
        counts[n][q : q + len(found)] += np.bincount(flat, minlength=len(found) * BINS).reshape(-1, BINS)
    for n, table in counts.items():
        above = np.cumsum(table[:, ::-1], 1)[:, ::-1] - table
        query, step = np.nonzero((table > 0) & (above < k))
        yield pa.RecordBatch.from_arrays(
            [pa.array(queries.groups[n][0][query]), pa.array(step), pa.array(table[query, step])], ["query_id", "step", "n"]
        )


def _select(batches: Iterator[pa.RecordBatch], sent, factor: float, k: int) -> Iterator[pa.RecordBatch]:
    """Rows above each query's k-th score, and of each stripe the k smallest ids that tie with it."""
    queries, kth = sent.value
    for n, q, own, found in queries.scores(batches, factor):
        bar = kth[n][q : q + len(found), None]
        order = np.argsort(own, kind="stable")
        found, own = found[:, order], own[order]
        tied = (found == bar) & (bar > NONE)
        query, at = np.nonzero((found > bar) | (tied & (np.cumsum(tied, 1) <= k)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(queries.groups[n][0][q + query]), pa.array(own[at]), pa.array(found[query, at])],
            ["query_id", "vec_id", "score"],
        )


def _search_block(candidates: DataFrame, block: pa.Table, factor: float, k: int, norm: float) -> DataFrame:
    context = candidates.sparkSession.sparkContext
    queries = Queries(block.column(0).to_numpy(), block.column(1).combine_chunks(), factor)
    place = {n: {int(x): i for i, x in enumerate(ids)} for n, (ids, _) in queries.groups.items()}
    low, width, top, need, open_ = {}, {}, {}, {}, {}
    for n, (ids, values) in queries.groups.items():
        with np.errstate(over="ignore", invalid="ignore"):
            reach = np.nan_to_num(np.sqrt((values * values).sum(1)) * norm * (1 + 1e-9), nan=np.inf) + 1
        reach = [HIGHEST if r >= 2.0**63 else int(r) for r in reach]
        low[n] = np.array([-r for r in reach], np.int64)
        top[n] = np.array(reach, np.int64)
        width[n] = np.array([-(-(2 * r + 1) // BINS) for r in reach], np.uint64)
        need[n], open_[n] = np.full(len(ids), k), np.ones(len(ids), bool)
    while any(o.any() for o in open_.values()):
        sent = context.broadcast((queries, {n: (low[n], width[n], top[n]) for n in low}))
        counted = candidates.mapInArrow(on_executors(_histogram, sent, factor, k), "query_id long, step long, n long")
        steps = counted.groupBy("query_id", "step").agg(F.sum("n").alias("n"))
        # Per query: the highest step down to which k scores lie, and how many lie above it.
        down = Window.partitionBy("query_id").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
        found = steps.withColumn("reached", F.sum("n").over(down)).toArrow().to_pandas()
        sent.unpersist()
        groups = dict(iter(found.groupby("query_id")))
        for n, (ids, _) in queries.groups.items():
            for query in ids[open_[n]].tolist():
                i = place[n][query]
                rows = groups.get(query)
                hit = rows[rows.reached >= need[n][i]] if rows is not None else None
                if hit is None or hit.empty:
                    # Fewer than k candidates: all are results.
                    low[n][i], top[n][i], open_[n][i] = NONE, NONE, False
                    continue
                best = hit.loc[hit.step.idxmax()]
                need[n][i] -= int(best.reached - best.n)
                step, wide = int(best.step), int(width[n][i])
                low[n][i] = int(low[n][i]) + step * wide
                top[n][i] = min(int(top[n][i]), int(low[n][i]) + wide - 1)
                open_[n][i] = wide > 1
                if not open_[n][i]:
                    top[n][i] = NONE  # known: nothing more is counted
                width[n][i] = -(-wide // BINS)
    sent = context.broadcast((queries, low))
    return candidates.mapInArrow(on_executors(_select, sent, factor, k), RESULT)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, factor: float = 256.0,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best other rows of each row that meets ``is_query``.

    The score is the inner product of the vectors after floor(factor * x); ties go to the smaller id.
    Rows with a null id, and vectors that are null or hold null or non-finite numbers take no part, and
    only vectors of one length are compared. Scores are exact wherever they fit a long; beyond it they
    stand as the largest or least one. Rows that share a
    query's id are not its candidates; a repeated query counts once, with its least usable vector, and a
    repeated candidate each time. Fewer than ``k`` candidates are all returned.

    Queries go out in blocks of about BLOCK, each scored against all rows in a few narrow passes; only
    counts per query and the rows kept are shuffled. What the driver holds is bounded by the block.
    """
    rows = vectors.where(vectors[vec_id].isNotNull()).select(vectors[vec_id].cast("long").alias("vec_id"), vectors[vector].alias("vector"))
    finite = F.forall(vectors[vector], lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    # Before the least vector is taken, as nulls and minus infinity come first.
    chosen = vectors.where(is_query & vectors[vec_id].isNotNull() & finite)
    chosen = chosen.select(vectors[vec_id].cast("long").alias("vec_id"), vectors[vector].alias("vector"))
    chosen = store(chosen.groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries")
    blocks = -(-chosen.count() // BLOCK)
    norm = rows.mapInArrow(on_executors(_norms, factor), "norm double").agg(F.max("norm")).first()[0] or 0.0
    spark = vectors.sparkSession
    path = f"{shared_folder(spark)}/top-{uuid4().hex}"
    for b in range(blocks):
        block = chosen.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()
        if block.num_rows:
            _search_block(rows, block, factor, k, norm).write.mode("append").parquet(path)
    found = spark.read.schema(RESULT).parquet(path) if blocks else spark.createDataFrame([], RESULT)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
