"""Near-duplicate vectors by int8 tile products with error bounds.

Unit vectors are rounded to int8 with one scale each; the length of the rounding error is kept. For two
vectors the product of the rounded ones differs from their cosine by no more than e1 + e2 + e1 * e2.
Tiles of vectors are multiplied as integers; a pair whose cosine lies beyond that bound on either side
of the threshold is decided, and only the pairs between are computed in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.components import connected, merge_roots
from plantlake.llm.shared import on_executors, on_group, store

#: Vectors of a tile.
TILE = 4096
STRIPE = 512
#: Directions along which tiles are bounded: vectors farther apart along one are farther apart.
DIRECTIONS = 6
LEVELS = 16
#: Parts in which the pairs of tiles of one label are found.
SLOTS = 16
ROUNDING = 1e-9


def units(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The vectors, all of one length, as doubles, and their norms."""
    values = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    values = values.reshape(len(vectors), -1)
    # Scaled first: squares of very large or small numbers would leave the range of doubles.
    values = values / np.abs(values).max(1, keepdims=True)
    return values, np.sqrt((values * values).sum(1))


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, the scale of each, and the length of what rounding took."""
    scale = np.abs(unit).max(1) / 127
    small = np.rint(unit / scale[:, None]).astype(np.int8)
    error = unit - small * scale[:, None]
    return small, scale, np.sqrt((error * error).sum(1))


def directions(length: int) -> np.ndarray:
    """Fixed orthogonal unit vectors."""
    random = np.random.default_rng(length).normal(size=(length, min(length, DIRECTIONS)))
    q, _ = np.linalg.qr(random)
    return np.pad(q, ((0, 0), (0, DIRECTIONS - q.shape[1])))


def _place(batches):
    """Projections of each vector and its place on a curve that keeps near vectors together."""
    for rows in batches:
        vectors = rows.column(1)
        lengths = vectors.value_lengths().to_numpy()
        seen, curve = np.zeros((len(lengths), DIRECTIONS)), np.zeros(len(lengths), np.int64)
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            values, norms = units(vectors.take(pa.array(at)))
            seen[at] = values / norms[:, None] @ directions(int(n))
            level = np.clip((seen[at] * np.sqrt(n) + 2) * LEVELS / 4, 0, LEVELS - 1).astype(np.int64)
            for bit in range(LEVELS.bit_length() - 2, -1, -1):
                for d in range(DIRECTIONS):
                    curve[at] = curve[at] << 1 | level[:, d] >> bit & 1
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(curve), *[pa.array(seen[:, d]) for d in range(DIRECTIONS)]],
            ["cid", "curve", *[f"p{d}" for d in range(DIRECTIONS)]],
        )


def _number(batches):
    """Tile of each row of a sorted partition: a new one every TILE rows and at each new label or length."""
    last, filled, tile = None, 0, -1
    for rows in batches:
        part, label, length = (rows.column(c).to_numpy() for c in (0, 1, 2))
        tiles = np.empty(rows.num_rows, np.int64)
        cuts = np.flatnonzero((np.diff(label) != 0) | (np.diff(length) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, rows.num_rows], strict=True):
            if a == b:
                continue
            if (label[a], length[a]) != last:
                last, filled, tile = (label[a], length[a]), 0, tile + 1
            tiles[a:b] = tile + (filled + np.arange(b - a)) // TILE
            tile, filled = int(tiles[b - 1]), (filled + b - a - 1) % TILE + 1
            if filled == TILE:
                tile, filled = tile + 1, 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int64) << 32 | tiles), *rows.columns[1:]], ["tile", *rows.schema.names[1:]]
        )


def _links(group: pa.Table, threshold: float) -> pa.Table:
    """Links of one pair of tiles: per vector with any, their number (copies counted) and its root.

    Rows have side (0 and 1, or 0 alone for a tile with itself), cid, copies and vector.
    """
    group = group.sort_by([("side", "ascending"), ("cid", "ascending")])
    side = group.column("side").to_numpy()
    cid, copies = group.column("cid").to_numpy(), group.column("copies").to_numpy()
    values, norms = units(group.column("vector").combine_chunks())
    small, scale, error = quantised(values / norms[:, None])
    first = int(np.searchsorted(side, 1))
    alone = first == len(side)
    others = slice(0, len(side)) if alone else slice(first, len(side))
    exact_type = np.float32 if values.shape[1] * 127**2 < 1 << 24 else np.float64
    right = small[others].astype(exact_type).T
    links, roots = np.zeros(len(side), np.int64), np.arange(len(side))
    for a in range(0, first, STRIPE):
        b = min(a + STRIPE, first)
        near = (small[a:b].astype(exact_type) @ right) * scale[a:b, None] * scale[others]
        bound = error[a:b, None] + error[others] + error[a:b, None] * error[others] + ROUNDING
        linked = near - bound >= threshold
        i, j = np.nonzero((near + bound >= threshold) & ~linked)
        for s in range(0, len(i), 1 << 18):
            x, y = i[s : s + (1 << 18)], j[s : s + (1 << 18)]
            dots = np.einsum("ij,ij->i", values[a + x], values[others.start + y])
            linked[x, y] = dots / (norms[a + x] * norms[others.start + y]) >= threshold
        if alone:
            linked[np.arange(b - a), np.arange(a, b)] = False
        links[a:b] += linked @ copies[others]
        if not alone:
            links[others] += copies[a:b] @ linked
        i, j = np.nonzero(linked)
        roots = merge_roots(roots, a + i, others.start + j)
    found = np.flatnonzero(links)
    return pa.table({"cid": cid[found], "links": links[found], "root": cid[roots[found]]})


def usable(vector):
    """Not null, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row.

    Vectors link if their labels are equal and not null and their cosine is at least ``threshold``.
    Null, zero and non-finite vectors, null labels and rows without an id link with nothing, and vectors
    of different length never link. Equal vectors of a label are one class with a count, so copies are
    never paired. A row without an id has no component and is not kept.

    Classes are sorted by label and a space-filling curve over a fixed set of directions and cut into
    tiles, a hot label into many. Two tiles of a label are compared unless they lie too far apart along
    some direction: cosine t means a distance of sqrt(2 - 2 t). From a pair of tiles come counts and
    the root of each linked vector, never the pairs.
    """
    rows = vectors.select(vectors[vec_id].alias("vec_id"), vectors[vector].alias("vector"), vectors[label].alias("label"))
    good = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    # Adding zero makes minus zero zero: equal vectors are equal arrays.
    classes = good.groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = store(classes.select(F.monotonically_increasing_id().alias("cid"), "*"), "vectors")
    placed = classes.select("cid", "vector").mapInArrow(
        on_executors(_place), "cid long, curve long, " + ", ".join(f"p{d} double" for d in range(DIRECTIONS))
    )
    numbered = classes.select("cid", F.xxhash64("label").alias("label"), F.size("vector").cast("long").alias("length"), "copies", "vector")
    order = ["label", "length", "curve", "cid"]
    spread = numbered.join(placed, "cid").repartitionByRange(*order).sortWithinPartitions(*order)
    columns = ["label", "length", "cid", "copies", "vector", *[f"p{d}" for d in range(DIRECTIONS)]]
    spread = spread.select(F.spark_partition_id().alias("part"), *columns)
    schema = "tile long, " + ", ".join(f"{c} {spread.schema[c].dataType.simpleString()}" for c in columns)
    tiled = store(spread.mapInArrow(on_executors(_number), schema), "tiles")
    bounds = [f(f"p{d}").alias(f"{n}{d}") for d in range(DIRECTIONS) for n, f in (("lo", F.min), ("hi", F.max))]
    boxes = tiled.groupBy("label", "length", "tile").agg(*bounds)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    one = boxes.withColumn("slot", F.pmod("tile", F.lit(SLOTS))).alias("a")
    two = boxes.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLOTS - 1).cast("long")))).alias("b")
    near = F.col("a.tile") <= F.col("b.tile")
    for d in range(DIRECTIONS):
        near &= (F.col(f"a.lo{d}") - F.col(f"b.hi{d}") <= reach) & (F.col(f"b.lo{d}") - F.col(f"a.hi{d}") <= reach)
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("label", "length", "slot")]
    pairs = one.join(two, [*same, near]).select(F.col("a.tile").alias("one"), F.col("b.tile").alias("two"))
    sides = pairs.select("one", "two", F.lit(0).alias("side"), F.col("one").alias("tile")).unionByName(
        pairs.where(F.col("one") != F.col("two")).select("one", "two", F.lit(1).alias("side"), F.col("two").alias("tile"))
    )
    work = store(sides, "pairs").join(tiled.select("tile", "cid", "copies", "vector"), "tile")
    linked = work.groupBy("one", "two").applyInArrow(on_group(_links, threshold), "cid long, links long, root long")
    linked = store(linked, "linked")
    links = linked.groupBy("cid").agg(F.sum("links").alias("links"))
    groups = connected(linked.select("cid", "root"))
    least = classes.select("cid", "least").join(groups, F.col("cid") == F.col("node"))
    smallest = least.groupBy("root").agg(F.min("least").alias("component_id"))
    components = least.join(smallest, "root").select("cid", "component_id")
    known = classes.select("cid", "label", "vector", "least", "copies").join(links, "cid", "left").join(components, "cid", "left")
    known = known.select("label", "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    marked = rows.withColumn("good", F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    keyed = marked.select("vec_id", F.when(F.col("good"), F.col("label")).alias("label"), F.when(F.col("good"), F.col("vector")).alias("vector"))
    joined = keyed.join(known, ["label", "vector"], "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
