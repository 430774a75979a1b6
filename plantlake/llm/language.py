"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts up to three bytes long with the counts of what follows. A
byte costs minus log2 of its share under escape method C: where it never followed the context, the
escape is paid and the next shorter context decides; below the empty context all bytes cost the same.
The language whose tree gives a text the shortest code is predicted. As the counts are frozen, what
each context and byte adds to the cost is worked out once, for the languages that have seen it.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlake.llm.shared import byte_column, chunks, on_executors, store

ORDER = 3
#: Documents per language that are learned from, whole, at most; the lowest hashes of ids are taken.
SAMPLE_DOCS = 400
#: Hashes of ids are taken in 2**(64 - RANK_SHIFT) steps.
RANK_SHIFT = 48
#: Costs (place in the text and language) held at once, about.
CELLS = 1 << 22
UNKNOWN = "und"

_models: dict = {}


def padded(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents with ORDER zero bytes in front of each, and where each then starts."""
    docs = len(offsets) - 1
    owner = np.repeat(np.arange(1, docs + 1), np.diff(offsets))
    text = np.zeros(len(codes) + ORDER * docs, np.uint8)
    text[np.arange(len(codes)) + ORDER * owner] = codes
    return text, offsets[:-1] + ORDER * np.arange(1, docs + 1)


def pack(text: np.ndarray) -> np.ndarray:
    """The ORDER + 1 bytes that end at each place, big-endian."""
    packed = np.zeros(len(text), np.int64)
    for back in range(ORDER + 1):
        packed[back:] |= text[: len(text) - back].astype(np.int64) << (8 * back)
    return packed


class Rows:
    """Sparse rows of numbers by language: sorted keys, and language and value of each entry."""

    def __init__(self, keys: np.ndarray, of: np.ndarray, values: np.ndarray):
        """Entries come sorted by key and language."""
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        self.keys = keys[first]
        self.bounds = np.append(np.flatnonzero(first), len(keys))
        self.of, self.values = of, values

    def entries(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each entry in the rows of ``keys``: which of these it belongs to, and its place."""
        place = np.searchsorted(self.keys, keys)
        there = np.flatnonzero(place < len(self.keys))
        there = there[self.keys[place[there]] == keys[there]]
        first, last = self.bounds[place[there]], self.bounds[place[there] + 1]
        many = last - first
        at = np.arange(many.sum()) + np.repeat(first - (np.cumsum(many) - many), many)
        return np.repeat(there, many), at

    def add_to(self, out: np.ndarray, keys: np.ndarray) -> None:
        row, at = self.entries(keys)
        out[row, self.of[at]] += self.values[at]


class Coder:
    """Costs in bits of every byte in every context, for all languages.

    All contexts are held, each for the languages that have seen it and no other: beside the costs below the empty context, what the escape from
    a context adds per (context, language), and what a byte saves per (context, byte, language).
    """

    def __init__(self, languages: list[str], of: np.ndarray, strings: np.ndarray, counts: np.ndarray):
        """``strings``: ORDER + 1 bytes each, packed big-endian, with language number and count."""
        self.languages, k = languages, len(languages)
        self.escapes, self.savings = [], []
        strings, of, counts = (np.asarray(x, np.int64) for x in (strings, of, counts))
        for order in range(ORDER + 1):
            # The strings' last order + 1 bytes by language, and their contexts.
            key = (strings & ((1 << 8 * (order + 1)) - 1)) * k + of
            found, inverse = np.unique(key, return_inverse=True)
            n = np.bincount(inverse, counts, len(found))
            coded, lang = found // k, found % k
            pair, inverse = np.unique((coded >> 8) * k + lang, return_inverse=True)
            totals, kinds = np.bincount(inverse, n, len(pair)), np.bincount(inverse, minlength=len(pair))
            whole = np.log2(totals + kinds)
            escape, cost = whole - np.log2(kinds), whole[inverse] - np.log2(n)
            if order == 0:
                # A language without any byte has no cost but the last.
                self.base = np.full((256, k), 8.0)
                self.base[:, pair] += escape
                self.base[coded, lang] = cost
            else:
                # As the byte is known to a language in this context, it is in the shorter ones too.
                shorter = self._seen(coded & ((1 << 8 * order) - 1), lang, order - 1)
                self.escapes.append(Rows(pair // k, pair % k, escape))
                self.savings.append(Rows(coded, lang, cost - shorter - escape[inverse]))
            self.last_cost = (found, cost)
        del self.last_cost

    def _seen(self, coded: np.ndarray, lang: np.ndarray, order: int) -> np.ndarray:
        """Costs of strings one byte longer than a context of ``order`` bytes, as found just before."""
        found, cost = self.last_cost
        return cost[np.searchsorted(found, coded * len(self.languages) + lang)]

    def costs(self, strings: np.ndarray) -> np.ndarray:
        """Cost of the last byte of each string of ORDER + 1 bytes under each language."""
        out = self.base[strings & 255]
        for order in range(1, ORDER + 1):
            self.escapes[order - 1].add_to(out, strings >> 8 & ((1 << 8 * order) - 1))
            self.savings[order - 1].add_to(out, strings & ((1 << 8 * (order + 1)) - 1))
        return out

    def lengths(self, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of each document under each language."""
        k = len(self.languages)
        out = np.zeros((len(offsets) - 1, k))
        text, starts = padded(codes, offsets)
        strings = pack(text)[np.arange(len(codes)) + ORDER * np.repeat(np.arange(1, len(offsets)), np.diff(offsets))]
        # Costs of as many places at once as fit, of each string once.
        step = max(1, CELLS // max(k, 1))
        for s in range(0, len(strings), step):
            part = pa.array(strings[s : s + step]).dictionary_encode()
            costs = self.costs(part.dictionary.to_numpy())[part.indices.to_numpy()]
            inside = np.clip(offsets - s, 0, len(costs))
            full = np.flatnonzero(np.diff(inside) > 0)
            out[full] += np.add.reduceat(costs, inside[full], axis=0)
        return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        names = rows.column(0).to_pylist()
        codes, offsets = byte_column(rows.column(1))
        for first, last in chunks(offsets):
            part = offsets[first : last + 1]
            text, starts = padded(codes[part[0] : part[-1]], part - part[0])
            packed = pack(text)
            for lang in sorted(set(names[first:last])):
                own = [packed[s : s + n] for s, n, x in zip(starts, np.diff(part), names[first:last], strict=True) if x == lang]
                found, counts = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(counts)], ["lang", "string", "n"]
                )


def train(docs: DataFrame, usable: Column, limit: int = SAMPLE_DOCS) -> dict:
    """Counts learned from at most ``limit`` whole documents of each language.

    Takes rows with a language and text that meet ``usable``; the sample is chosen from ids and
    languages alone, without their texts.
    """
    rank = F.xxhash64("doc_id")
    ids = docs.where(F.col("lang").isNotNull() & usable).select(
        "doc_id", "lang", rank.alias("_rank"), F.shiftrightunsigned(rank, RANK_SHIFT).alias("_step")
    )
    # Ids are counted per language and step of the hash, and only the steps that hold the first
    # ``limit`` of a language are put in order: a language with most of all rows meets in no task.
    steps = ids.groupBy("lang", "_step").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("_step")) - F.col("n")
    ends = steps.withColumn("before", before).where(F.col("before") < limit).groupBy("lang").agg(F.max("_step").alias("_end"))
    # One row per language, stored so that Spark knows its size and sends it to all tasks unless it is large.
    near = ids.join(store(ends, "languages"), "lang").where(F.col("_step") <= F.col("_end"))
    first = Window.partitionBy("lang").orderBy("_step", "_rank", "doc_id")
    chosen = near.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= limit).select("doc_id", "lang").distinct()
    # At most limit pairs of id and language for each language.
    sample = docs.select("doc_id", "lang", "text").join(store(chosen, "sample"), ["doc_id", "lang"])
    counted = sample.select("lang", "text").mapInArrow(on_executors(_count), "lang string, string long, n long")
    totals = counted.groupBy("lang", "string").agg(F.sum("n").alias("n"))
    found = totals.toArrow()
    names = found.column("lang").combine_chunks().dictionary_encode()
    known = names.dictionary.to_pylist()
    languages = sorted(known)
    number = {x: i for i, x in enumerate(languages)}
    return {
        "key": uuid4().hex, "languages": languages,
        "of": np.array([number[x] for x in known], np.int32)[names.indices.to_numpy()],
        "strings": found.column("string").to_numpy().astype(np.uint32), "counts": found.column("n").to_numpy(),
    }


def _identify(batches: Iterator[pa.RecordBatch], sent, keep_text: bool) -> Iterator[pa.RecordBatch]:
    model = sent.value
    if model["key"] not in _models:
        _models.clear()
        _models[model["key"]] = Coder(model["languages"], model["of"], model["strings"], model["counts"])
    coder = _models[model["key"]]
    for rows in batches:
        codes, offsets = byte_column(rows.column(rows.num_columns - 1))
        best, scores = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows)
        for a, b in chunks(offsets, 1 << 20):
            part = offsets[a : b + 1]
            bits = coder.lengths(codes[part[0] : part[-1]], part - part[0])
            best[a:b] = bits.argmin(1)
            scores[a:b] = 1 / np.exp2(bits.min(1, keepdims=True) - bits).sum(1)
        names = pa.array(coder.languages).take(pa.array(best))
        kept = rows.num_columns if keep_text else rows.num_columns - 1
        yield pa.RecordBatch.from_arrays(
            [*rows.columns[:kept], names, pa.array(scores)], [*rows.schema.names[:kept], "_lang", "_score"]
        )


def identify(
    docs: DataFrame, model: dict, text: str = "text", out: str = "lang_pred", score: str = "score", keep_text: bool = False
) -> DataFrame:
    """``docs`` with the predicted language and its posterior (equal priors), in place of the text unless
    ``keep_text`` is set.

    One row for each row, in one narrow pass. Null text, text without a letter and any text under a
    model without languages give ``und`` with score 0; of equal code lengths the first language by
    name wins. Repeated rows get the same. Other columns stay, whatever their names; columns called
    like the new ones are replaced. The model has all counted
    strings of the sample, so its size follows from the sampled documents of all languages.
    """
    keep = [c for c in docs.columns if c not in (text, out, score)]
    lettered = F.coalesce(docs[text].rlike(r"\p{L}"), F.lit(False))
    inner = docs.select(
        *[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], lettered.alias("_lettered"), docs[text].alias("_text")
    )
    named = [F.col(f"c{i}").alias(c) for i, c in enumerate(keep)]
    if keep_text:
        named.append(F.col("_text").alias(text))
    if not model["languages"]:
        return inner.select(*named, F.lit(UNKNOWN).alias(out), F.lit(0.0).alias(score))
    fields = "".join(f"c{i} {inner.schema[i].dataType.simpleString()}, " for i in range(len(keep)))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields += "_lettered boolean, " + ("_text string, " if keep_text else "")
    made = inner.mapInArrow(on_executors(_identify, sent, keep_text), f"{fields}_lang string, _score double")
    known = F.col("_lettered")
    return made.select(
        *named,
        F.when(known, F.col("_lang")).otherwise(UNKNOWN).alias(out),
        F.when(known, F.col("_score")).otherwise(0.0).alias(score),
    )
