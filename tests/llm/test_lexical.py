"""Ranked search against loops."""

import math
import re
from collections import Counter

import pytest

from plantlake.llm import lexical
from tests.llm.cases import documents, odd_rows, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, score long, row long, _row long"
LOWER = str.maketrans(lexical.UPPER, lexical.LOWER)


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(items, docs, k):
    found = [(i, Counter(terms(t))) for i, t in docs]
    total, n_docs = sum(sum(c.values()) for _, c in found), sum(bool(c) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        scored = []
        for doc, c in found:
            m = 10 + 90 * sum(c.values()) * n_docs // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in own & set(c)
            )
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, n + 1, doc, -score) for n, (score, _, doc) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def tables():
    docs = [(r[0], r[1]) for r in odd_rows()]
    docs += [(100 + i, prose(i, 30 + 7 * i, "abcd")) for i in range(40)] + [(100, prose(0, 30, "abcd"))] * 3
    docs += [(None, prose(5, 65, "abcd")), (300, "x" * 5000 + " ab " + "é" * 3000), (301, "AB-ab_Ab\x00ab\x7fab`ab{ab")]
    items = [(i, prose(1000 + i, 5 + i, "abcd")) for i in range(12)]
    items += [(20, None), (21, ""), (22, "!!"), (None, "ab"), (3, "İÑ ΣΑΣ ça 漢字 one"), (3, "one"), (23, "ab " * 50), (24, "é" * 3000)]
    return items, docs


@pytest.mark.parametrize(
    "k,block,piece,cells,kept", [(10, 4 << 20, 1 << 20, 1 << 20, 1 << 17), (3, 2000, 64, 50, 5), (2, 400, 1000, 7, 1 << 17)]
)
def test_equals_loops(spark, monkeypatch, k, block, piece, cells, kept):
    # Workers get the sizes with the function only where tests run them in this process, so blocks are
    # cut here and the rest is tested below.
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    items, docs = tables()
    table = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in items], ITEMS)
    found = lexical.rank(table, documents(spark, docs), k=k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=repr) == brute(items, docs, k)


@pytest.mark.parametrize("piece,cells,rows", [(64, 50, 5), (1, 1, 1), (1000, 7, 40)])
def test_small_pieces_in_a_task(monkeypatch, piece, cells, rows):
    """One task's scores with pieces, cells and kept rows far smaller than in use."""
    import pyarrow as pa

    for name, value in (("PIECE", piece), ("CELLS", cells), ("ROWS", rows)):
        monkeypatch.setattr(lexical, name, value)
    items, docs = tables()
    docs = [d for d in docs if len(d[1] or "") < 3000]
    pairs = sorted({(i, t) for i, text in items if i is not None for t in terms(text)})
    data = lexical.block_data(pa.table({"item_id": [i for i, _ in pairs], "term": [t for _, t in pairs]}))

    class Sent:
        value = data

    texts = pa.array([t for _, t in docs])
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs], pa.int64()), pa.array(range(len(docs))), texts], ["doc_id", "_row", "text"])
    counted = pa.Table.from_batches(lexical._statistics([batch.select(["text"])], Sent))
    data["docs"], data["total"], data["weights"] = lexical._weights(counted, len(data["terms"]))
    found = pa.Table.from_batches(lexical._score([batch], Sent, 3)).to_pylist()
    best = {}
    for r in found:
        best.setdefault(r["item_id"], []).append((-r["score"], r["doc_id"] is None, r["doc_id"] or 0))
    got = [(i, n + 1, None if none else doc, -s) for i, own in best.items() for n, (s, none, doc) in enumerate(sorted(own)[:3])]
    assert sorted(got, key=repr) == brute(items, docs, 3)


def test_blocks_hold_whole_items_or_parts(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 600)
    items = [(i, prose(i, 2 + i % 9)) for i in range(300)] + [(1000, prose(7, 400))]
    table = spark.createDataFrame(items, "item_id long, text string")
    pairs = lexical.in_blocks(lexical.item_terms(table, "item_id", "text")).collect()
    sizes, blocks = Counter(), {}
    for r in pairs:
        sizes[r.whole, r.block] += len(r.term.encode()) + lexical.PAIR_BYTES
        blocks.setdefault((r.item_id, r.whole), set()).add(r.block)
    assert max(sizes.values()) <= 1200
    assert all(len(b) == 1 for (_, whole), b in blocks.items() if whole)
    assert len(blocks[1000, False]) > 5
    assert sorted((r.item_id, r.term) for r in pairs) == sorted({(i, t) for i, text in items for t in terms(text)})


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "ab cd")], "item_id long, text string")
    assert lexical.rank(none, documents(spark, [(1, "ab")])).collect() == []
    assert lexical.rank(some, documents(spark, [])).collect() == []
    assert lexical.rank(some, documents(spark, [(1, None), (2, "!")])).collect() == []
