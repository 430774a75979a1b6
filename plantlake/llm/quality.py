"""Quality scores from supervised subword embeddings.

A document is the mean of learned vectors of its hashed features: words, word pairs (and whether
both are the same word), and pieces of three and four bytes inside a word and its edges. A softmax over the mean gives the class. Vectors and
softmax are learned together by stochastic gradient descent in numpy on a bounded sample of labelled
documents. As the softmax is linear in the mean, scoring needs one number per feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.llm.shared import byte_column, chunks, on_executors

#: Labelled documents that are learned from, at most; the lowest hashes of their ids are taken.
SAMPLE_DOCS = 4000
BITS = 18
DIMENSIONS = 8
EPOCHS = 6
RATE = 0.3
SEED = 7

SPREAD = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x100000001B3
SPACE = 32
#: Longer documents are taken in parts of about so many bytes.
PART_BYTES = 1 << 20


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for base in (BASE, inverse):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes * SPREAD >> np.uint64(64 - BITS)).astype(np.int32)


def _bucket_small(hashes: np.ndarray, kind: int) -> np.ndarray:
    mixed = (hashes ^ np.uint32(kind)) * np.uint32(0x9E3779B1)
    return (mixed ^ mixed >> np.uint32(15)) * np.uint32(0x85EBCA77) >> np.uint32(32 - BITS)


def features(codes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Features of the documents in ``codes``, which ``offsets`` bound, one kind after the other.

    Each kind gives a bucket and a flag (whether it counts) per place, and the bounds of documents.
    """
    # One space in front of each document and one behind all: no feature reaches across.
    text = np.append(np.insert(codes, offsets[:-1], SPACE), np.uint8(SPACE))
    docs = offsets + np.arange(len(offsets))
    blank = (text == SPACE) | ((text >= 9) & (text <= 13))
    text[blank] = SPACE
    wide = text.astype(np.uint32)
    inner = ~blank[1:-1]
    three = wide[:-2] << np.uint32(16) | wide[1:-1] << np.uint32(8) | wide[2:]
    bounds = np.minimum(docs, len(three))
    yield _bucket_small(three, 0), inner, bounds
    four = three[:-1] << np.uint32(8) | wide[3:]
    yield _bucket_small(four, 0x5BD1E995), inner[:-1] & inner[1:], np.minimum(docs, len(four))
    edge = np.diff(blank.view(np.int8))
    starts, ends = np.flatnonzero(edge < 0) + 1, np.flatnonzero(edge > 0) + 1
    up, down = _powers(1 << int(len(text)).bit_length())
    sums = np.append(np.uint64(0), np.cumsum(text * up[: len(text)]))
    words = (sums[ends] - sums[starts]) * down[starts]
    words ^= words >> np.uint64(29)
    bounds = np.searchsorted(starts, docs)
    yield _bucket(words * np.uint64(3)), np.ones(len(words), bool), bounds
    follows = np.ones(max(0, len(words) - 1), bool)
    follows[bounds[(bounds > 0) & (bounds < len(words))] - 1] = False
    yield _bucket(words[:-1] * np.uint64(BASE) + words[1:]), follows, np.minimum(bounds, len(follows))
    # A word pair of one word twice also counts as such, whatever the word.
    same = follows & (words[:-1] == words[1:])
    yield np.zeros(len(same), np.int32), same, np.minimum(bounds, len(follows))


def parts(codes: np.ndarray, size: int | None = None) -> Iterator[tuple[np.ndarray, int]]:
    """Parts of one document, with signs, whose features add up to those of the whole.

    Cuts lie at blanks. A part starts with the last word of the one before, for the pair that the cut would
    lose; that word by itself is then taken off once. A single word is never cut.
    """
    size = size or PART_BYTES
    first, reached = 0, 0
    while True:
        end = _blank_from(codes, reached + size, size)
        part = codes[first:end]
        yield part, 1
        if end == len(codes):
            return
        blank = _is_blank(part)
        inner = np.flatnonzero(~blank)
        reached = end
        if not len(inner):
            first = end
            continue
        last = int(inner[-1]) + 1
        before = np.flatnonzero(blank[:last])
        start = int(before[-1]) + 1 if len(before) else 0
        yield part[start:last], -1
        first += start


def _is_blank(codes: np.ndarray) -> np.ndarray:
    return (codes == SPACE) | ((codes >= 9) & (codes <= 13))


def _blank_from(codes: np.ndarray, place: int, size: int) -> int:
    """The first blank from ``place`` on, or the end."""
    while place < len(codes):
        found = np.flatnonzero(_is_blank(codes[place : place + size]))
        if len(found):
            return place + int(found[0])
        place += size
    return len(codes)


def feature_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of one document, ascending, and how often it has each."""
    if len(codes) <= PART_BYTES:
        kinds = features(codes, np.array([0, len(codes)]))
        return np.unique(np.concatenate([b[valid] for b, valid, _ in kinds]), return_counts=True)
    total = np.zeros(1 << BITS, np.int64)
    for part, sign in parts(codes):
        for buckets, valid, _ in features(part, np.array([0, len(part)])):
            total += sign * np.bincount(buckets[valid], minlength=1 << BITS)
    idx = np.flatnonzero(total)
    return idx, total[idx]


def feature_sums(codes: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed weights of the features of each document, and their number."""
    if len(offsets) == 2 and len(codes) > PART_BYTES:
        sums, counts = np.zeros(1), np.zeros(1)
        for part, sign in parts(codes):
            for buckets, valid, _ in features(part, np.array([0, len(part)])):
                sums += sign * weights[buckets[valid]].sum(dtype=np.float64)
                counts += sign * int(valid.sum())
        return sums, counts
    sums, counts = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
    for buckets, valid, bounds in features(codes, offsets):
        reached = np.append(0, np.cumsum(weights[buckets] * valid, dtype=np.float64))
        sums += np.diff(reached[bounds])
        counts += np.diff(np.append(0, np.cumsum(valid))[bounds])
    return sums, counts


def learn(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """Weight of each feature and the bias, for the log-odds of label 1.

    ``rows`` holds the label, the features and their counts of each document. A step moves a
    document's mean by RATE along the gradient, however many features share it.
    """
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS)).astype(np.float32)
    top = np.zeros((2, DIMENSIONS), np.float32)
    bias = np.zeros(2, np.float32)
    steps, done = EPOCHS * max(1, len(rows)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            label, idx, counts = rows[i]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            share = counts / max(1, counts.sum())
            mean = share @ vectors[idx]
            logits = top @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ top
            top -= rate * np.outer(p, mean)
            bias -= rate * p * np.float32(0.1)
            if len(idx):
                vectors[idx] -= rate / (share @ share) * share[:, None] * back
    return (vectors @ (top[1] - top[0])).astype(np.float32), float(bias[1] - bias[0])


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for i in range(rows.num_rows):
            idx, counts = feature_counts(byte_column(rows.column(2).slice(i, 1))[0])
            data = [pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in (idx, counts)]
            yield pa.RecordBatch.from_arrays([*(rows.column(k).slice(i, 1) for k in (0, 1)), *data], ["rank", "label", "idx", "n"])


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for b in batches:
        for rank, label, idx, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            rows.append((rank, label, np.frombuffer(idx, np.int32), np.frombuffer(n, np.int32).astype(np.float32)))
    rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
    weights, bias = learn([r[1:] for r in rows])
    yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([bias])], ["weights", "bias"])


def train(docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", limit: int = SAMPLE_DOCS) -> tuple[bytes, float]:
    """A model from at most ``limit`` labelled documents whose id meets ``usable``.

    A document labelled twice counts with its lower label; null ids and null labels teach nothing.
    Only ids and labels are ordered to choose the sample; its texts are turned into features where
    they lie, and one task learns from those (a document has no more than 2**BITS).
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & usable)
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
        .withColumn("rank", F.xxhash64("doc_id")).orderBy("rank", "doc_id").limit(limit)
    )
    # At most ``limit`` rows of an id, a hash and a label.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("rank", "label", "text")
    made = sample.mapInArrow(on_executors(_featurize), "rank long, label int, idx binary, n binary")
    found = made.repartition(1).mapInArrow(on_executors(_learn), "weights binary, bias double").collect()
    return (bytes(found[0]["weights"]), found[0]["bias"]) if found else (np.zeros(1 << BITS, np.float32).tobytes(), 0.0)


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    weights, bias = np.frombuffer(model.value[0], np.float32), model.value[1]
    for rows in batches:
        codes, offsets = byte_column(rows.column(rows.num_columns - 1))
        scores = np.zeros(rows.num_rows)
        for a, b in chunks(offsets, PART_BYTES):
            part = offsets[a : b + 1]
            sums, counts = feature_sums(codes[part[0] : part[-1]], part - part[0], weights)
            scores[a:b] = 1 / (1 + np.exp(-(sums / np.maximum(counts, 1) + bias)))
        yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(scores)], rows.schema.names[:-1] + ["_score"])


def score(docs: DataFrame, model: tuple[bytes, float], text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in ``out``, in place of the text.

    One row for each row, in one narrow pass. Null and empty texts get the model's bias; repeated rows
    score alike. A text longer than ``PART_BYTES`` is taken in parts, a single word whole. Other columns stay, whatever their names; a column called ``out`` is replaced. The
    model that is broadcast has 2**BITS numbers, whatever the input.
    """
    keep = [c for c in docs.columns if c not in (text, out)]
    inner = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], docs[text].alias("_text"))
    fields = "".join(f"c{i} {inner.schema[i].dataType.simpleString()}, " for i in range(len(keep)))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    made = inner.mapInArrow(on_executors(_score, sent), f"{fields}_score double")
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("_score").alias(out))
