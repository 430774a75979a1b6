"""Quality and language: held-out accuracy, exact code lengths, and odd rows."""

from collections import Counter, defaultdict
from math import isclose, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from plantlake.llm import language, quality
from plantlake.llm.queries import op2_subword_quality, op4_ppm_language
from plantlake.llm.shared import byte_column, remainder
from tests.llm.cases import documents, odd_rows, prose

SF = "/root/testdata/sf0.01"


def test_quality_held_out(spark):
    scored = op2_subword_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    assert scored.count() == 1000 and scored.where("score < 0 or score > 1 or score is null").count() == 0


def test_quality_learns_from_usable_rows_only(spark):
    docs = documents(spark, [(i, prose(i, 30), "en") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    usable = remainder("doc_id", 4) != 2
    flipped = labels.withColumn("quality", F.when(usable, F.col("quality")).otherwise(1 - F.col("quality")))
    assert quality.train(docs, labels, usable) == quality.train(docs, flipped, usable)


def test_quality_odd_rows(spark):
    docs = documents(spark, odd_rows())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(docs, none, F.lit(True))
    out = quality.score(docs.withColumn("score", F.lit("x")), model)
    assert out.count() == len(odd_rows()) and out.where("score between 0 and 1").count() == len(odd_rows())
    assert quality.score(documents(spark, []), model).count() == 0


def test_features_do_not_cross_documents():
    texts = ["ab cd", "", "ab cd", " ef"]

    def bags(parts):
        codes, offsets = byte_column(pa.array(parts))
        out = [Counter() for _ in parts]
        for buckets, valid, bounds in quality.features(codes, offsets):
            for i in range(len(parts)):
                s = slice(bounds[i], bounds[i + 1])
                out[i].update(buckets[s][valid[s]].tolist())
        return out

    assert bags(texts) == [bags([t])[0] for t in texts]


def plain_features(text):
    """Buckets of a document by a plain loop over its bytes."""
    whole, spread = (1 << 64) - 1, 0x9E3779B97F4A7C15
    data = b" " + bytes(32 if 9 <= c <= 13 else c for c in text.encode()) + b" "

    def small(value, kind):
        mixed = ((value ^ kind) * 0x9E3779B1) & 0xFFFFFFFF
        return (((mixed ^ mixed >> 15) * 0x85EBCA77) & 0xFFFFFFFF) >> 14

    found = Counter()
    for i in range(1, len(data) - 1):
        if data[i] != 32:
            found[small(int.from_bytes(data[i - 1 : i + 2], "big"), 0)] += 1
            if i + 2 < len(data) and data[i + 1] != 32:
                found[small(int.from_bytes(data[i - 1 : i + 3], "big"), 0x5BD1E995)] += 1
    hashes = []
    for word in data.split(b" "):
        if word:
            h = sum(c * pow(quality.BASE, j, 1 << 64) for j, c in enumerate(word)) & whole
            hashes.append(h ^ h >> 29)
    for h in hashes:
        found[(h * 3 * spread & whole) >> 46] += 1
    for one, two in zip(hashes, hashes[1:], strict=False):
        found[((one * quality.BASE + two) * spread & whole) >> 46] += 1
        found[0] += one == two
    return +found


def counts_of(text):
    idx, n = quality.feature_counts(byte_column(pa.array([text]))[0])
    return dict(zip(idx.tolist(), n.tolist(), strict=True))


PLAIN_TEXTS = ["ab cd cd\tcd ef", "", "  ", "x", "ça  va\n\nça va 漢字 ", prose(4, 200), "a" * 500 + " b b " + "c" * 40]


def test_features_equal_a_plain_loop():
    for text in PLAIN_TEXTS:
        assert counts_of(text) == plain_features(text)


def test_parts_add_up_to_the_whole(monkeypatch):
    weights = np.random.default_rng(2).normal(size=1 << quality.BITS).astype(np.float32)
    for size in (1, 3, 16, 64):
        for text in PLAIN_TEXTS:
            monkeypatch.setattr(quality, "PART_BYTES", size)
            assert counts_of(text) == plain_features(text), (size, text[:20])
            codes, offsets = byte_column(pa.array([text]))
            sums, counts = quality.feature_sums(codes, offsets, weights)
            wanted = plain_features(text)
            assert counts[0] == wanted.total()
            assert isclose(sums[0], sum(float(weights[b]) * n for b, n in wanted.items()), abs_tol=1e-4)


def test_long_text_in_parts():
    """A text of several parts of the real size scores as it would in one."""
    codes, offsets = byte_column(pa.array([prose(9, 700_000)]))
    assert len(codes) > 2 * quality.PART_BYTES
    weights = np.random.default_rng(3).normal(size=1 << quality.BITS).astype(np.float32)
    sums, counts = quality.feature_sums(codes, offsets, weights)
    kinds = [b[valid] for b, valid, _ in quality.features(codes, offsets)]
    assert counts[0] == sum(map(len, kinds))
    assert isclose(sums[0], sum(weights[b].sum(dtype=np.float64) for b in kinds), rel_tol=1e-6, abs_tol=1e-3)


def test_learning_equals_a_plain_loop():
    texts = [(1, "good words stand here"), (0, "bad bad bad"), (1, "more good words"), (0, "")]
    rows = []
    for label, text in texts:
        idx, n = quality.feature_counts(byte_column(pa.array([text]))[0])
        rows.append((label, idx.astype(np.int32), n.astype(np.float32)))
    weights, bias = quality.learn(rows)

    rng, d = np.random.default_rng(quality.SEED), quality.DIMENSIONS
    start = rng.uniform(-1 / d, 1 / d, (1 << quality.BITS, d)).astype(np.float32)
    vectors, top, offset, done = {}, [[0.0] * d, [0.0] * d], [0.0, 0.0], 0
    for _ in range(quality.EPOCHS):
        for i in rng.permutation(len(rows)):
            label, counted = texts[i][0], plain_features(texts[i][1])
            rate = quality.RATE * (1 - done / (quality.EPOCHS * len(rows)))
            done += 1
            share = {b: n / max(1, counted.total()) for b, n in counted.items()}
            for b in share:
                vectors.setdefault(b, [float(x) for x in start[b]])
            mean = [sum(s * vectors[b][k] for b, s in share.items()) for k in range(d)]
            odds = [np.exp(sum(t * m for t, m in zip(top[c], mean, strict=True)) + offset[c]) for c in (0, 1)]
            p = [o / sum(odds) - (c == label) for c, o in enumerate(odds)]
            back = [p[0] * top[0][k] + p[1] * top[1][k] for k in range(d)]
            for c in (0, 1):
                top[c] = [t - rate * p[c] * m for t, m in zip(top[c], mean, strict=True)]
                offset[c] -= rate * p[c] * 0.1
            square = sum(s * s for s in share.values())
            for b, s in share.items():
                vectors[b] = [v - rate / square * s * x for v, x in zip(vectors[b], back, strict=True)]
    assert isclose(bias, offset[1] - offset[0], abs_tol=1e-4)
    for b, v in vectors.items():
        assert isclose(weights[b], sum(x * (t1 - t0) for x, t0, t1 in zip(v, *top, strict=True)), abs_tol=1e-3)


def test_language_held_out(spark):
    found = op4_ppm_language(spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


def test_code_lengths_equal_brute_force():
    texts = {"aa": [prose(1, 60, "abcde"), "abc abc abd"], "bb": [prose(2, 60, "cdefg"), "äö cde"]}
    counts = {x: defaultdict(Counter) for x in texts}
    grams = Counter()
    for lang, parts in texts.items():
        for part in parts:
            data = b"\0" * language.ORDER + part.encode()
            for i in range(language.ORDER, len(data)):
                grams[lang, int.from_bytes(data[i - language.ORDER : i + 1], "big")] += 1
                for o in range(language.ORDER + 1):
                    counts[lang][data[i - o : i]][data[i]] += 1
    names = sorted(texts)
    coder = language.Coder(
        names, np.array([names.index(x) for x, _ in grams]), np.array([g for _, g in grams]), np.array(list(grams.values()))
    )

    def bits(data, lang):
        data, out = b"\0" * language.ORDER + data, 0.0
        for i in range(language.ORDER, len(data)):
            order = language.ORDER
            while True:
                seen = counts[lang][data[i - order : i]]
                if seen:
                    whole = log2(seen.total() + len(seen))
                    if seen[data[i]]:
                        out += whole - log2(seen[data[i]])
                        break
                    out += whole - log2(len(seen))
                if order == 0:
                    out += 8
                    break
                order -= 1
        return out

    tests = ["abc dea", "", "zz äbc 漢", prose(3, 30, "abcdefg")]
    got = coder.lengths(*byte_column(pa.array(tests)))
    for row, text in zip(got, tests, strict=True):
        assert all(isclose(x, bits(text.encode(), lang), rel_tol=1e-5) for x, lang in zip(row, names, strict=True))


def test_language_odd_rows(spark):
    docs = documents(spark, odd_rows() + [(i, prose(i, 20), "en", "s") for i in range(20, 40)])
    model = language.train(docs, remainder("doc_id", 5) != 0)
    found = language.identify(docs.withColumn("lang_pred", F.lit(1)), model)
    rows = {r.doc_id: r for r in found.collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (1, 2, 3, 9))
    assert rows[4].lang_pred == "en" and 0 <= rows[4].score <= 1
    empty = documents(spark, [])
    nothing = language.train(empty, F.lit(True))
    assert language.identify(docs, nothing).where("lang_pred != 'und'").count() == 0
    assert language.identify(empty, model).count() == 0


def test_small_language_beside_a_large_one(spark):
    rng = np.random.default_rng(5)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789abcdefghijklmnopqrstuvwxyz"))
    large = [(i, "".join(rng.choice(letters, 15_000)), "aa") for i in range(30)]
    small = [(100, "жук щёл эхо", "zz")]
    docs = documents(spark, large + small)
    model = language.train(docs, F.lit(True))
    assert model["languages"] == ["aa", "zz"]
    # Every counted string is kept: three zero bytes stand before each text.
    assert len(set(model["strings"][model["of"] == 1].tolist())) == len({("\0\0\0" + small[0][1]).encode()[i : i + 4] for i in range(len(small[0][1].encode()))})
    assert len(model["strings"]) > 400_000
    found = {r.doc_id: r.lang_pred for r in language.identify(documents(spark, small + [(200, "хэй щука", None)] + large[:2]), model).collect()}
    assert found == {100: "zz", 200: "zz", 0: "aa", 1: "aa"}


def test_contexts_seen_once_are_held():
    """Of one short text in a language beside a large one, all contexts."""
    text = b"\0" * language.ORDER + "der Fluss fließt durch das ganze Tal".encode()
    own = Counter(int.from_bytes(text[i - 3 : i + 1], "big") for i in range(3, len(text)))
    rng = np.random.default_rng(1)
    other = Counter(rng.integers(0x61616161, 0x7A7A7A7A, 50_000).tolist())
    strings, counts = [*own, *other], [*own.values(), *other.values()]
    coder = language.Coder(["de", "xx"], np.array([0] * len(own) + [1] * len(other)), np.array(strings), np.array(counts))
    for order in range(1, language.ORDER + 1):
        rows = coder.escapes[order - 1]
        of = np.repeat(rows.keys, np.diff(rows.bounds))[rows.of == 0]
        assert set(of.tolist()) == {int.from_bytes(text[i - order : i], "big") for i in range(language.ORDER, len(text))}
    alone = language.Coder(["de"], np.zeros(len(own)), np.array(list(own)), np.array(list(own.values())))
    phrase = byte_column(pa.array(["das ganze Tal"]))
    assert isclose(coder.lengths(*phrase)[0, 0], alone.lengths(*phrase)[0, 0])


def test_stripes_give_the_same_lengths(monkeypatch):
    strings = np.array([0x61, 0x6162, 0x616263, 0x61626364, 0x62636465], np.int64)
    coder = language.Coder(["aa", "bb"], np.array([0, 0, 0, 1, 1]), strings, np.array([5, 4, 4, 6, 7]))
    codes, offsets = byte_column(pa.array(["abcde", "", None, "x", "abcdabcdabcd"]))
    whole = coder.lengths(codes, offsets)
    monkeypatch.setattr(language, "CELLS", 6)
    assert np.allclose(coder.lengths(codes, offsets), whole) and not whole[1:3].any()
