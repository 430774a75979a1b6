"""Repeated byte strings against counting every window."""

import random
from collections import Counter

import numpy as np
import pytest

from plantlake.llm import suffix_dedup
from tests.llm.cases import documents, odd_rows, prose


def brute(texts, window):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - window + 1):
            if seen[d[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((bytes(b for b, g in zip(d, gone, strict=True) if not g), sum(gone), spans))
    return out


def check(spark, texts, window, gram):
    docs = documents(spark, [(i, t) for i, t in enumerate(texts)])
    found = suffix_dedup.remove_repeats(docs, window, gram).orderBy("doc_id").collect()
    assert [(bytes(r.kept), r.n_removed, r.n_spans) for r in found] == brute(texts, window)
    assert [r.n_bytes for r in found] == [len((t or "").encode()) for t in texts]


def varied(seed):
    rng = random.Random(seed)
    texts = [prose(rng.random(), rng.randint(0, 40), "abä") for _ in range(25)]
    passage = prose(77, 30)
    for _ in range(15):
        a = rng.randint(0, 60)
        texts.append(prose(rng.random(), 5) + passage[a : a + rng.randint(20, 120)] + prose(rng.random(), 5))
    texts += [texts[3], texts[30], "ab" * 60, "ab" * 45, "aaaa" * 30, "xyz" * 15 + "q" + "xyz" * 15, passage + passage]
    return texts


@pytest.mark.parametrize("window,gram,few", [(20, 7, 500), (31, 30, 500), (40, 8, 2), (12, 12, 1)])
def test_equal_brute_force(spark, monkeypatch, window, gram, few):
    monkeypatch.setattr(suffix_dedup, "FEW", few)
    check(spark, varied(window), window, gram)


def test_long_texts_are_cut_into_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 100)
    texts = varied(3)
    found = []
    import pyarrow as pa

    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["_row", "_text"])
    for out in suffix_dedup._scan(iter([rows]), 20, 7):
        found += out.column("runs").to_pylist()
    assert len(found) == len(texts)
    # Every suffix lies in exactly one run.
    for text, runs in zip(texts, found, strict=True):
        places = sorted(p for r in runs for p in range(r["at"], r["at"] + r["n"]))
        assert places == list(range(max(0, len(text.encode()) - 19)))


def test_odd_rows(spark):
    texts = [t for _, t, *_ in odd_rows()]
    check(spark, texts, 200, 48)
    docs = documents(spark, odd_rows())
    out = suffix_dedup.remove_repeats(docs, 20, 8, as_text=True)
    assert out.count() == len(texts) and "c0" in out.columns and "_row" in out.columns
    assert suffix_dedup.remove_repeats(documents(spark, []), 20, 8).count() == 0


def test_cut_characters_are_dropped(spark):
    # The shared string starts inside a character.
    tail = "é" * 30
    docs = documents(spark, [(1, "ã" + tail), (2, "x" + tail)])
    rows = suffix_dedup.remove_repeats(docs, 20, 8, as_text=True).orderBy("doc_id").collect()
    assert [r.kept for r in rows] == ["ã", "x"]


def test_keys_are_dealt_by_suffixes(spark, monkeypatch):
    # Few runs, but long: blanks between ends that differ, and one longer than a task takes.
    texts = [prose(i, 6) + " " * (150 + i) + prose(100 + i, 6) for i in range(12)] + [" " * 900 + "x", "ab" * 400 + "c", "y" + "ab" * 30]
    stored, store = {}, suffix_dedup.store
    monkeypatch.setattr(suffix_dedup, "store", lambda df, label: stored.setdefault(label, store(df, label)))
    monkeypatch.setattr(suffix_dedup, "FEW", 320)
    check(spark, texts, 20, 7)
    pieces = stored["pieces"].groupBy("key").agg({"n": "sum", "parts": "max"}).collect()
    assert max(r["sum(n)"] for r in pieces) > 2000
    assert all(r["max(parts)"] == -(-r["sum(n)"] // 320) for r in pieces)
    assert stored["pieces"].agg({"n": "max"}).first()[0] <= 320 // suffix_dedup.PIECES


@pytest.mark.parametrize("window", [1, 3, 8, 9, 16, 23, 200])
def test_suffixes_are_ordered_by_their_bytes(window):
    rng = random.Random(window)
    pieces = [bytes(rng.choice(b"\x00\xffab") for _ in range(window + rng.randint(0, 60))) for _ in range(20)]
    pieces += [pieces[0], pieces[1][:window], b"a" * (window + 90), b"ab" * window]
    counts = np.array([len(p) - window + 1 for p in pieces])
    found = suffix_dedup.Suffixes(pieces, counts, window)
    windows = [pieces[p][a : a + window] for p, a in zip(found.piece.tolist(), found.place.tolist(), strict=True)]
    assert sorted(windows) == [windows[i] for i in np.argsort(found.groups(), kind="stable")]
    of = {}
    for w, *numbers in zip(windows, found.groups().tolist(), *(h.tolist() for h in found.hashes()), strict=True):
        assert of.setdefault(w, numbers) == numbers
    for numbers in zip(*of.values(), strict=True):
        assert len(set(numbers)) == len(of)


def test_no_suffixes():
    none = suffix_dedup.Suffixes([], np.zeros(0, np.int64), 20)
    assert len(none.groups()) == 0 and len(suffix_dedup.counts_of(none.groups())) == 0


def test_sorted_ranges_hold_whole_keys(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "SORTED", 10)
    table = pa.table({"key": [1, 1, 2, 3, 3, 4, 5, 5], "n": [4, 4, 1, 30, 1, 5, 2, 2]})
    assert suffix_dedup.by_keys(table) == [(0, 3), (3, 5), (5, 6), (6, 8)]
    assert suffix_dedup.by_keys(table.slice(0, 2)) == [(0, 2)]
