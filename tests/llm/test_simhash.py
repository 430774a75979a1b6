"""SimHash groups against all pairs."""

import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from plantlake.llm import simhash
from plantlake.llm.components import connected, merge_roots
from tests.llm.cases import documents, odd_rows, prose


def brute_print(text, length=3):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + length]) for i in range(max(1, len(words) - length + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints, distance):
    a = np.array(prints, np.uint64)
    i, j = np.nonzero(np.bitwise_count(a[:, None] ^ a) <= distance)
    return merge_roots(np.arange(len(a)), i, j)


def test_prints():
    texts = [t for _, t, *_ in odd_rows()]
    assert simhash.fingerprints(pa.array(texts), 3).tolist() == [brute_print(t) for t in texts]


def test_layouts_hold_every_pair():
    for distance in (1, 2, 3):
        for order, free in simhash.layouts(distance):
            assert sum(n for _, n in order) == 64 and 0 < free < 64
            fp = np.array([random.getrandbits(64) for _ in range(50)], np.uint64)
            assert (simhash.permute(simhash.permute(fp, order), order, back=True) == fp).all()
    rank = simhash.gray_rank(np.arange(1 << 10, dtype=np.uint64))
    assert sorted(rank.tolist()) == list(range(1 << 10))
    assert all(bin(int(a) ^ int(b)).count("1") == 1 for a, b in zip(np.argsort(rank), np.argsort(rank)[1:], strict=False))


def test_components_equal_all_pairs(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(150)]
    centre = rng.getrandbits(64)
    for _ in range(250):
        # Chains and dense balls: links of links, and groups that share all upper bits.
        flips = rng.sample(range(64), rng.choice([1, 2, 2, 3]))
        prints.append((centre if rng.random() < 0.5 else rng.choice(prints)) ^ sum(1 << b for b in flips))
    prints += prints[:20] + [0, 1, (1 << 64) - 1, (1 << 64) - 2]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    for distance in (1, 2, 3):
        frame = spark.createDataFrame([(i, p) for i, p in enumerate(signed)], "doc_id long, fp long")
        found = frame.join(simhash.components(frame, distance), "fp").collect()
        wanted = brute_components(prints, distance)
        assert {r.doc_id: r.component_id for r in found} == dict(enumerate(wanted.tolist()))


def test_odd_rows_and_kept(spark):
    base = prose(9, 300)
    rows = odd_rows() + [(30, base), (29, base), (31, base.upper()), (None, base), (32, base + " more")]
    docs = documents(spark, rows)
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[1].fingerprint == 0 and by_id[3].component_id == by_id[2].component_id == 1
    assert {by_id[i].component_id for i in (29, 30, 31)} == {29}
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(29) == 1 and 30 not in ids and 31 not in ids and ids.count(4) == 1 and ids.count(1) == 1
    assert 2 not in ids and 3 not in ids and None in ids


def test_search_is_the_same_in_any_batches():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 30, np.uint64)
    # Many below one node, and few below others.
    near = base[0] ^ rng.integers(0, 1 << 12, 200, np.uint64)
    flips = [b ^ np.uint64(1 << int(rng.integers(64))) for b in base]
    prints = np.unique(np.concatenate([base, near, flips]))
    entries = pa.Table.from_batches(
        list(simhash._entries(iter([pa.record_batch([pa.array(prints.view(np.int64))], ["fp"])]), 2))
    ).sort_by([("layout", "ascending"), ("node", "ascending"), ("gray", "ascending")]).combine_chunks()
    none = entries.schema.empty_table().to_batches() or [pa.RecordBatch.from_pylist([], entries.schema)]

    def links(rows):
        found = simhash._search(iter([*none, *entries.to_batches(max_chunksize=rows)]), 2)
        return {pair for b in found for pair in zip(*(c.to_pylist() for c in b.columns), strict=True)}

    whole = links(len(entries))
    assert whole and all(links(rows) == whole for rows in (1, 2, 7, 100))
    assert not list(simhash._search(iter(none), 2))


def test_empty(spark):
    docs = documents(spark, [])
    assert simhash.near_duplicates(docs).count() == 0 and simhash.keep_first(docs).count() == 0


def test_connected(spark):
    path = [(i, i + 1) for i in range(100)] + [(200, 300), (300, 200), (7, 7), (500, 500), (-3, 400)]
    found = connected(spark.createDataFrame(path, "a long, b long"))
    roots = {r.node: r.root for r in found.collect()}
    assert found.count() == len(roots)
    assert all(roots[i] == 0 for i in range(101)) and roots[300] == roots[200] == 200 and roots[400] == -3 and 500 not in roots
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_zero_columns_stay_apart(spark):
    docs = documents(spark, [(None, "x y z"), (None, "x y z"), (None, "p q r")])
    assert simhash.keep_first(docs).count() == 2
    assert simhash.near_duplicates(docs).where(F.col("component_id").isNotNull()).count() == 0
