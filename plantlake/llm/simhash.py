"""SimHash near-duplicates through a hierarchical index in Gray order.

Fingerprints that differ in at most ``distance`` bits agree on all but that many of a fixed number of
bit blocks. For each choice of blocks to leave out, the bits of the others are a shared masked pattern:
an upper node of the index, under which fingerprints lie sorted by the Gray rank of their bits with the
pattern in front. Below it, nodes share further bits. Two nodes are compared by the bits that each level
adds, differences are accumulated from level to level, and a pair of whole groups is dropped as soon as
they exceed the distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.components import connected, merge_roots
from plantlake.llm.shared import on_executors, store, with_row

SEED = 42
BITS = 64
#: Bits that each level of the index adds below the shared pattern.
LEVEL_BITS = 4
#: Pairs of nodes looked at together.
PAIRS = 1 << 20
#: Shingles whose bits are counted together.
SHINGLES = 1 << 16


def fingerprints(texts: pa.Array, length: int) -> np.ndarray:
    """SimHash of each text over its shingles of ``length`` words."""
    out = np.zeros(len(texts), np.uint64)
    hashes: list[int] = []
    rows: list[int] = []
    sizes: list[int] = []

    def flush() -> None:
        if rows:
            values = np.array(hashes, np.uint64)
            bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ends = np.cumsum(sizes)
            sums = np.stack([bits[e - n : e].sum(0, dtype=np.int64) for e, n in zip(ends, sizes, strict=True)])
            major = (sums * 2 > np.array(sizes)[:, None]).astype(np.uint8)
            out[rows] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
            hashes.clear(), rows.clear(), sizes.clear()

    digest, join = xxhash.xxh64_intdigest, b" ".join
    for i, text in enumerate(texts):
        # Lower case of A-Z alone, words between ASCII white space: what bytes offer.
        words = (text.as_py() or "").encode().lower().split()
        if not words:
            continue
        if len(words) > length:
            shingles = map(join, zip(*(words[k:] for k in range(length)), strict=False))
        else:
            shingles = [join(words)]
        before = len(hashes)
        hashes.extend(digest(s, SEED) for s in shingles)
        rows.append(i)
        sizes.append(len(hashes) - before)
        if len(hashes) > SHINGLES:
            flush()
    flush()
    return out


def _fingerprint(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        found = fingerprints(rows.column(rows.num_columns - 1), length).view(np.int64)
        yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(found)], rows.schema.names[:-1] + ["fp"])


def blocks(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the blocks: three times as many as bits may differ, three at least."""
    count = max(3, 3 * distance)
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def layouts(distance: int) -> list[tuple[list[tuple[int, int]], int]]:
    """For each choice of left-out blocks: the blocks with those last, and the number of their bits."""
    parts = blocks(distance)
    out = []
    for left in combinations(parts, distance):
        out.append(([p for p in parts if p not in left] + list(left), sum(n for _, n in left)))
    return out


def permute(fp: np.ndarray, order: list[tuple[int, int]], back: bool = False) -> np.ndarray:
    """Fingerprints with the bits of the blocks in this order, the first highest; or back again."""
    out, high = np.zeros_like(fp), BITS
    for first, n in order:
        high -= n
        source, target = (high, first) if back else (first, high)
        out |= (fp >> np.uint64(source) & np.uint64((1 << n) - 1)) << np.uint64(target)
    return out


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Place of a code in Gray order; codes that share leading bits have neighbouring places."""
    rank = code.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _entries(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Each fingerprint once under every layout: upper node and Gray rank."""
    for rows in batches:
        fp = rows.column(0).to_numpy().view(np.uint64)
        for number, (order, free) in enumerate(layouts(distance)):
            code = permute(fp, order)
            node = (code >> np.uint64(free)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(fp), number, np.int32)), pa.array(node), pa.array(gray_rank(code).view(np.int64))],
                ["layout", "node", "gray"],
            )


def linked_below(upper: np.ndarray, code: np.ndarray, free: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``distance`` among the codes that share an upper node, which are adjacent."""
    shifts = [*range(free - LEVEL_BITS, 0, -LEVEL_BITS), 0]
    starts = [np.flatnonzero(np.append(True, upper[1:] != upper[:-1]))]
    for shift in shifts:
        prefix = code >> np.uint64(shift)
        starts.append(np.flatnonzero(np.append(True, (upper[1:] != upper[:-1]) | (prefix[1:] != prefix[:-1]))))
    first = [np.searchsorted(below, above) for above, below in zip(starts, starts[1:], strict=False)]
    last = [np.append(f[1:], len(s)) for f, s in zip(first, starts[1:], strict=False)]
    root = np.arange(len(starts[0]))
    waiting = [(0, root, root, np.zeros(len(root), np.int64))]
    while waiting:
        level, x, y, differ = waiting.pop()
        if level == len(shifts):
            apart = x < y
            yield x[apart], y[apart]
            continue
        wide = last[level][y] - first[level][y]
        many = (last[level][x] - first[level][x]) * wide
        reached = np.cumsum(many)
        if reached[-1] > PAIRS and len(x) > 1:
            cut = max(1, min(len(x) - 1, int(np.searchsorted(reached, reached[-1] // 2))))
            waiting += [(level, x[s], y[s], differ[s]) for s in (slice(cut, None), slice(cut))]
            continue
        pair = np.repeat(np.arange(len(x)), many)
        place = np.arange(reached[-1]) - np.repeat(reached - many, many)
        i = first[level][x[pair]] + place // wide[pair]
        j = first[level][y[pair]] + place % wide[pair]
        mask = np.uint64((1 << ((shifts[level - 1] if level else free) - shifts[level])) - 1)
        own = code[starts[level + 1]] >> np.uint64(shifts[level]) & mask
        total = differ[pair] + np.bitwise_count(own[i] ^ own[j])
        near = (total <= distance) & (i <= j)
        if near.any():
            waiting.append((level + 1, i[near], j[near], total[near]))


def _search(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links below each upper node of a sorted partition, as (fingerprint, root) of every linked one.

    A node has no more than 2**free fingerprints, as they are distinct; only nodes of two or more stay.
    """
    plans = layouts(distance)

    def work(layout, node, gray):
        edge = np.append(True, (node[1:] != node[:-1]) | (layout[1:] != layout[:-1]))
        number = np.cumsum(edge)
        shared = np.bincount(number)[number] > 1
        for kind in np.unique(layout[shared]):
            own = shared & (layout == kind)
            order, free = plans[kind]
            rank = gray[own].view(np.uint64)
            code = rank ^ rank >> np.uint64(1)
            roots = np.arange(len(code))
            for i, j in linked_below(number[own], code, free, distance):
                roots = merge_roots(roots, i, j)
            at = np.flatnonzero(roots != np.arange(len(code)))
            if len(at):
                fp = permute(code, order, back=True).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(fp[roots[at]])], ["one", "two"])

    # Joined once a node is whole: a hot node comes in thousands of batches.
    held: list[list[np.ndarray]] = []
    for rows in batches:
        if not rows.num_rows:
            continue
        some = [rows.column(c).to_numpy() for c in range(3)]
        held.append(some)
        first = held[0]
        if first[0][0] == some[0][-1] and first[1][0] == some[1][-1]:
            continue
        layout, node, gray = (np.concatenate(parts) for parts in zip(*held, strict=True))
        # The last node may go on in the next batch.
        cut = int(np.argmax((node == node[-1]) & (layout == layout[-1])))
        yield from work(layout[:cut], node[:cut], gray[:cut])
        held = [[layout[cut:], node[cut:], gray[cut:]]]
    if held:
        yield from work(*(np.concatenate(parts) for parts in zip(*held, strict=True)))


def components(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, component_id) of each distinct fingerprint of ``prints`` (doc_id, fp).

    The component is the smallest id of any document whose fingerprint can be reached. Documents with
    one fingerprint meet only as one row; the search yields a root per fingerprint and node, not pairs.
    """
    distinct = store(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    entries = distinct.select("fp").mapInArrow(on_executors(_entries, distance), "layout int, node long, gray long")
    parted = entries.repartition("layout", "node").sortWithinPartitions("layout", "node", "gray")
    links = parted.mapInArrow(on_executors(_search, distance), "one long, two long")
    groups = connected(links)
    member = distinct.join(groups, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = member.groupBy("root").agg(F.min("least").alias("component_id"))
    return member.join(smallest, "root").select("fp", "component_id")


def near_duplicates(
    docs: DataFrame, length: int = 3, distance: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (64 bits as long), component_id: one row per row.

    Shingles of ``length`` lower-cased words vote on the bits; a shorter text is one shingle. A null text
    counts as empty; texts without a word have fingerprint 0 and link like any other. A row without an id
    has the component of its group, null if no document there has an id. Repeated rows are linked.
    """
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    prints = rows.mapInArrow(on_executors(_fingerprint, length), f"doc_id {rows.schema[0].dataType.simpleString()}, fp long")
    prints = store(prints, "prints")
    return prints.join(components(prints, distance), "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, length: int = 3, distance: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id (null last).

    Of repeated ids one row stays. Rows are numbered and stored once, decided by number, and the texts
    that stay are found by a join on it.
    """
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    numbered = store(with_row(docs.select(*[docs[c].alias(n) for c, n in names.items()])), "numbered")
    rows = numbered.select("_row", names[doc_id], names[text])
    kind = rows.schema[1].dataType.simpleString()
    prints = store(rows.mapInArrow(on_executors(_fingerprint, length), f"_row long, doc_id {kind}, fp long"), "prints")
    groups = components(prints.select(F.col("doc_id"), "fp"), distance)
    # Groups of documents without ids have no component id; the fingerprint stands in for it.
    group = F.struct("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("fp"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row"))
    kept = prints.join(groups, "fp").groupBy(group.alias("g")).agg(first.alias("first")).select("first._row")
    return numbered.join(kept, "_row").select(*[F.col(n).alias(c) for c, n in names.items()])
