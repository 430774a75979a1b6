"""Targets by hand, closeness, and repeated runs."""

from collections import defaultdict

from plantlake.llm import mixing
from plantlake.llm.mixing import MixRule
from tests.llm.cases import documents, odd_rows, prose


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        rest = share * sum(sizes.values()) - sum(target.values())
        level = rest / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: most * sizes[s] for s in over}
        open_ -= set(over)
    return target


def test_targets_and_closeness(spark):
    rows, sizes = [], defaultdict(int)
    for i in range(900):
        source = [None, "a", "b", "ü", "Z", "z"][min(5, i % 11)]
        words = 5 + i * 7 % 40
        rows.append((i, prose(i, words), "en", source))
        sizes[source] += words
    docs = documents(spark, rows)
    found = mixing.mix_counts(docs).collect()
    wanted = brute_targets(dict(sizes))
    taken = defaultdict(int)
    for r in found:
        taken[r.source] += r.copies * r["size"]
        assert abs(r.target - wanted[r.source]) < 1e-6 and r.source_size == sizes[r.source] and 0 <= r.copies <= 2
    for source, words in taken.items():
        assert abs(words - wanted[source]) <= 23
    assert sorted(map(str, mixing.mix_counts(docs.repartition(5)).collect())) == sorted(map(str, found))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in found)


def test_other_rules(spark):
    docs = documents(spark, [(i, "w " * (i + 1), "en", "abc"[i % 3]) for i in range(30)])
    for rule in (MixRule((1,), 0.5, 1.0), MixRule((5, 1), 2.0, 2.0), MixRule((1, 2, 3), 0.0, 2.0), MixRule((1, 1, 9), 3.5, 4.0)):
        found = mixing.mix_counts(docs, rule).collect()
        sizes = {r.source: r.source_size for r in found}
        wanted = brute_targets(sizes, rule.weights, rule.share, rule.most)
        for source in sizes:
            own = [r for r in found if r.source == source]
            assert abs(own[0].target - wanted[source]) < 1e-6
            assert abs(sum(r.copies * r["size"] for r in own) - wanted[source]) <= 15


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    found = mixing.mix_counts(docs).collect()
    assert len(found) == len(odd_rows())
    by_id = defaultdict(set)
    for r in found:
        by_id[r.id].add((r["size"], r.copies))
    assert all(size == 0 for i in (1, 2, 3) for size, _ in by_id[i])
    assert len(by_id[4]) == 1
    assert mixing.mix_counts(documents(spark, [])).count() == 0 and mixing.mix(documents(spark, [])).count() == 0
    blank = documents(spark, [(1, "", "en", "a"), (2, None, "en", None)])
    assert [r.copies for r in mixing.mix_counts(blank).collect()] == [0, 0]


def test_inclusion_follows_the_given_odds(spark):
    """Over seeds each document is taken as often as it is expected, and words are near the target each time."""
    docs = documents(spark, [(i, "w " * (2 ** (i % 9)), "en", "ab"[i % 5 == 0]) for i in range(2700)])
    seeds = 5
    taken, expected, targets = defaultdict(int), {}, {}
    for seed in range(seeds):
        words = defaultdict(int)
        for r in mixing.mix_counts(docs, MixRule((1, 4), 0.8, 2.0, seed=str(seed))).collect():
            taken[r.id] += r.copies
            words[r.source] += r.copies * r["size"]
            expected[r.id], targets[r.source] = r.expected, r.target
            assert r.expected - 1 < r.copies < r.expected + 1
        assert all(abs(words[s] - targets[s]) <= 128 for s in words)
    by_class, wanted = defaultdict(int), defaultdict(float)
    for i in range(2700):
        key = (i % 5 == 0, i % 9)
        by_class[key] += taken[i]
        wanted[key] += seeds * expected[i]
    assert len({round(e, 6) for e in expected.values()}) >= 10
    for key, n in wanted.items():
        assert abs(by_class[key] - n) <= 4 * max(n, 1) ** 0.5 + 0.02 * n, (key, by_class[key], n)


def test_alike_without_ease(spark):
    docs = documents(spark, [(i, "w " * (i + 1), "en", "abc"[i % 3]) for i in range(60)])
    found = mixing.mix_counts(docs, MixRule(ease=None)).collect()
    assert all(abs(r.expected - r.target / r.source_size) < 1e-9 for r in found)
