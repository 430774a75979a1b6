"""Ranked lexical search by scanning documents with an automaton of all item terms.

No index of the documents is made. The distinct terms of the items form an Aho-Corasick automaton in
which every term stands between two blanks; texts are brought to the same form, byte by byte, so
that an output of the automaton is a whole term and nothing else. A first scan counts the documents and
terms of the table and how many documents hold each item term; a second one counts term
frequencies again, turns them into scores through the map from terms to items, and keeps the best
documents of each item per task.

Items go out in blocks of bounded size. One whose terms do not fit a block is scored in parts, whose
scores are added up before its documents are ranked.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantlake.config import shared_folder
from plantlake.llm.shared import byte_column, chunks, on_executors, store, with_row

#: Bytes of terms (each with its bookkeeping) in a block, about; twice that at most.
BLOCK_BYTES = 4 << 20
PAIR_BYTES = 32
#: Bytes of text scanned at once.
PIECE = 1 << 20
#: Scores held at once, and rows kept before they are cut down to the best.
CELLS = 1 << 20
ROWS = 1 << 17
#: Steps that items are put in order by.
STEP_BITS = 12

# Upper-case letters, the characters between terms, the parts of the score.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FLAT, SLOPE = 10, 90
SCALED, TF_WEIGHT, LENGTH_WEIGHT = 1_000_000_000, 1000, 8

#: Every byte in the form of the automaton: letters lower-case, a blank between terms.
FORM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

_blocks: dict = {}


class Block:
    """Automaton of the terms of some items, and the items of each term as ragged rows."""

    def __init__(self, terms: pa.Array, bounds: np.ndarray, items: np.ndarray, item_ids: pa.Array):
        self.bounds, self.items, self.item_ids, self.size = bounds, items, item_ids, len(terms)
        self.automaton = ahocorasick.Automaton()
        for number, term in enumerate(terms.to_pylist()):
            # Bytes as characters of the same number, as in the texts.
            self.automaton.add_word(f" {term.encode().decode('latin-1')} ", number)
        self.automaton.make_automaton()

    def count(self, codes: np.ndarray, offsets: np.ndarray):
        """Of some texts: terms in each; and document, term and frequency of each term that was found."""
        raw = codes.tobytes().translate(FORM)
        text = b" ".join([b"", *[raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])], b""])
        starts = offsets + np.arange(len(offsets))
        blank = np.frombuffer(text, np.uint8) == 32
        begun = np.zeros(len(text) + 1, np.int64)
        begun[2:] = np.cumsum(blank[:-1] & ~blank[1:])
        lengths = begun[starts[1:] + 1] - begun[starts[:-1] + 1]
        keys, counts, at = [], [], 0
        while at < len(text) - 1:
            # Cut at a blank, which both neighbours have.
            cut = text.find(b" ", at + PIECE)
            cut = len(text) - 1 if cut < 0 else cut
            hits = np.fromiter(self.automaton.iter(text[at : cut + 1].decode("latin-1")), [("end", np.int64), ("term", np.int64)])
            doc = np.searchsorted(starts, hits["end"] + at - 1, "right") - 1
            key, n = np.unique(doc * self.size + hits["term"], return_counts=True)
            keys.append(key)
            counts.append(n)
            at = cut
        key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        tf = np.bincount(inverse, np.concatenate(counts), len(key)).astype(np.int64)
        doc, term = np.divmod(key, self.size)
        return lengths, doc, term, tf

    def scores(self, lengths, doc, term, tf, weights, m) -> Iterator[tuple[int, np.ndarray]]:
        """(first document, scores: documents by items) of a few documents at a time."""
        gain = weights[term] * (SCALED * tf // (TF_WEIGHT * tf + LENGTH_WEIGHT * m[doc]))
        many = self.bounds[term + 1] - self.bounds[term]
        width = len(self.item_ids)
        first_of = np.searchsorted(doc, np.arange(len(lengths) + 1))
        # Pairs of found term and item before each document.
        pairs = np.concatenate([[0], np.cumsum(many)])[first_of]
        a, step = 0, max(1, CELLS // max(width, 1))
        while a < len(lengths):
            b = int(np.searchsorted(pairs, pairs[a] + CELLS, "right")) - 1
            b = min(max(b, a + 1), a + step, len(lengths))
            some = slice(first_of[a], first_of[b])
            n = many[some]
            at = np.arange(n.sum()) + np.repeat(self.bounds[term[some]] - (np.cumsum(n) - n), n)
            cell = np.repeat(doc[some] - a, n) * width + self.items[at]
            # Sums stay below 2**53, so doubles hold them exactly: an item has fewer than 2**17 terms in a
            # block and a gain is below 2**36.
            yield a, np.bincount(cell, np.repeat(gain[some], n), (b - a) * width).astype(np.int64).reshape(b - a, width)
            a = b


def _opened(sent) -> tuple[Block, dict]:
    data = sent.value
    if data["key"] not in _blocks:
        _blocks.clear()
        _blocks[data["key"]] = Block(data["terms"], data["bounds"], data["items"], data["item_ids"])
    return _blocks[data["key"]], data


def _statistics(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term of the block; as terms -1 and -2, documents with terms and all terms."""
    block, _ = _opened(sent)
    held, docs, total = np.zeros(block.size, np.int64), 0, 0
    for rows in batches:
        codes, offsets = byte_column(rows.column(rows.num_columns - 1))
        for a, b in chunks(offsets, PIECE):
            part = offsets[a : b + 1]
            lengths, _, term, _ = block.count(codes[part[0] : part[-1]], part - part[0])
            held += np.bincount(term, minlength=block.size)
            docs += int((lengths > 0).sum())
            total += int(lengths.sum())
    some = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(some, [-1, -2])), pa.array(np.append(held[some], [docs, total]))], ["term", "n"]
    )


class Best:
    """Rows (item, document, score) of which each item's ``k`` best are kept."""

    def __init__(self, items: int, k: int | None):
        self.k, self.rows, self.held = k, [], 0
        self.bar = np.ones(items, np.int64)

    def add(self, item, doc, known, score, row) -> None:
        self.rows.append((item, doc, known, score, row))
        self.held += len(item)
        if self.k is not None and self.held > ROWS:
            self.cut()

    def cut(self) -> tuple:
        item, doc, known, score, row = map(np.concatenate, zip(*self.rows))
        if self.k is not None:
            order = np.lexsort((doc, ~known, -score, item))
            item, doc, known, score, row = (x[order] for x in (item, doc, known, score, row))
            place = np.arange(len(item)) - np.searchsorted(item, item)
            last = place == self.k - 1
            # Nothing below an item's k-th score can be a result; what ties with it can.
            self.bar[item[last]] = score[last]
            item, doc, known, score, row = (x[place < self.k] for x in (item, doc, known, score, row))
        self.rows, self.held = [(item, doc, known, score, row)], len(item)
        return self.rows[0]


def _score(batches: Iterator[pa.RecordBatch], sent, k: int | None) -> Iterator[pa.RecordBatch]:
    """Item, document, row and score of this task's best documents; with ``k`` None of all that score."""
    block, data = _opened(sent)
    docs, total, weights = data["docs"], data["total"], data["weights"]
    names = ["item_id", "doc_id", "row", "score"]

    def batch_of(kept: tuple) -> pa.RecordBatch:
        item, doc, known, score, row = kept
        ids = block.item_ids.take(pa.array(item))
        return pa.RecordBatch.from_arrays([ids, pa.array(doc, mask=~known), pa.array(row), pa.array(score)], names)

    best = Best(len(block.item_ids), k)
    for rows in batches:
        ids, numbers = rows.column(0), rows.column(1).to_numpy()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        codes, offsets = byte_column(rows.column(2))
        for a, b in chunks(offsets, PIECE):
            part = offsets[a : b + 1]
            lengths, doc, term, tf = block.count(codes[part[0] : part[-1]], part - part[0])
            # In Python's whole numbers, which no table outgrows.
            m = np.array([FLAT + SLOPE * n * docs // total for n in lengths.tolist()], np.int64) if total else lengths
            for first, scores in block.scores(lengths, doc, term, tf, weights, m):
                row, item = np.nonzero(scores >= best.bar)
                at = a + first + row
                if len(at):
                    best.add(item, ids[at], known[at], scores[row, item], numbers[at])
            if k is None and best.held > ROWS:
                yield batch_of(best.cut())
                best = Best(len(block.item_ids), k)
    if best.rows:
        yield batch_of(best.cut())


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, term) of every distinct term of an item; rows that share an id are one item."""
    words = F.regexp_extract_all(F.translate(items[text], UPPER, LOWER), F.lit(TERM), 0)
    pairs = items.where(items[item_id].isNotNull()).select(items[item_id].alias("item_id"), F.explode(F.array_distinct(words)).alias("term"))
    return pairs.distinct()


def in_blocks(pairs: DataFrame) -> DataFrame:
    """Pairs with ``whole`` (the item fits a block) and ``block``: at most twice BLOCK_BYTES in each.

    Items stand in order of a hash. Their bytes are summed up per step of the hash first; the driver gets
    a number for each step, and no task more than a step.
    """
    size = (F.octet_length("term") + PAIR_BYTES).cast("long")
    step = F.shiftrightunsigned(F.xxhash64("item_id"), 64 - STEP_BITS)
    sized = pairs.withColumns({"_size": size, "_step": step})
    totals = sized.groupBy("_step", "item_id").agg(F.sum("_size").alias("_bytes"))
    totals = store(totals.withColumn("whole", F.col("_bytes") <= BLOCK_BYTES), "items")
    steps = totals.groupBy("whole", "_step").agg(F.sum("_bytes").alias("n")).collect()
    before, seen = [], {True: 0, False: 0}
    for row in sorted(steps, key=lambda r: r["_step"]):
        before.append((row["whole"], row["_step"], seen[row["whole"]]))
        seen[row["whole"]] += row["n"]
    known = pairs.sparkSession.createDataFrame(before, "whole boolean, _step long, _before long")
    running = Window.partitionBy("whole", "_step").orderBy("item_id")
    placed = totals.join(F.broadcast(known), ["whole", "_step"]).withColumn(
        "_from", F.col("_before") + F.sum("_bytes").over(running) - F.col("_bytes")
    )
    inside = F.sum("_size").over(Window.partitionBy("item_id").orderBy("term")) - F.col("_size")
    joined = sized.select("item_id", "term", "_size").join(placed.select("item_id", "whole", "_from"), "item_id")
    whole = joined.where("whole").withColumn("_at", F.col("_from"))
    cut = joined.where(~F.col("whole")).withColumn("_at", F.col("_from") + inside)
    return whole.unionByName(cut).select("item_id", "term", "whole", F.floor(F.col("_at") / BLOCK_BYTES).alias("block"))


def block_data(pairs: pa.Table) -> dict:
    """Terms, items and ragged rows of items by term, of one block's pairs."""
    terms = pairs.column("term").combine_chunks().dictionary_encode()
    items = pairs.column("item_id").combine_chunks().dictionary_encode()
    number = terms.indices.to_numpy()
    order = np.argsort(number, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(number, minlength=len(terms.dictionary)))])
    return {
        "key": uuid4().hex, "terms": terms.dictionary, "item_ids": items.dictionary,
        "bounds": bounds, "items": items.indices.to_numpy()[order].astype(np.int64),
    }


def _weights(counted: pa.Table, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms in all, and floor(1000 ln((2 N + 2) / (2 df + 1))) of each term."""
    found = dict(zip(counted.column("term").to_pylist(), counted.column("n").to_pylist()))
    docs, total = found.pop(-1, 0), found.pop(-2, 0)
    df = np.zeros(size, np.int64)
    df[list(found)] = list(found.values())
    return docs, total, np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1))).astype(np.int64)


def rank(
    items: DataFrame, docs: DataFrame, k: int = 10,
    item_id: str = "item_id", item_text: str = "text", doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item with a score above 0.

    Terms are runs of letters, digits and characters beyond ASCII in lower case (A-Z only). Equal scores
    go by id, null ids last. A null or empty text has no terms; repeated documents each count and rank;
    items that share an id are one, those without an id and those without terms have no rows; an empty
    table on either side gives none. Other columns take no part. Texts and terms of any length are whole.
    """
    spark = docs.sparkSession
    pairs = store(in_blocks(store(item_terms(items, item_id, item_text), "item-terms")), "item-blocks")
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    rows = with_row(rows).select("doc_id", "_row", "text")
    listed = sorted((not r["whole"], r["block"]) for r in pairs.select("whole", "block").distinct().collect())
    if any(cut for cut, _ in listed):
        # Parts of one item meet by row number, which must then not change between scans.
        rows = store(rows, "documents")
    result = f"item_id {pairs.schema['item_id'].dataType.simpleString()}, doc_id long, row long, score long"
    path = f"{shared_folder(spark)}/ranked-{uuid4().hex}"
    for cut, block in listed:
        own = pairs.where((F.col("whole") != F.lit(cut)) & (F.col("block") == block)).select("item_id", "term")
        data = block_data(own.toArrow())
        sent = spark.sparkContext.broadcast(data)
        counted = rows.select("text").mapInArrow(on_executors(_statistics, sent), "term long, n long")
        found = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        sent.unpersist()
        data["docs"], data["total"], data["weights"] = _weights(found, len(data["terms"]))
        sent = spark.sparkContext.broadcast(data)
        best = rows.mapInArrow(on_executors(_score, sent, None if cut else k), result)
        best.write.parquet(f"{path}/cut={str(cut).lower()}/block={block}")
        sent.unpersist()
    found = spark.createDataFrame([], result)
    for cut in sorted({cut for cut, _ in listed}):
        part = spark.read.schema(result).parquet(f"{path}/cut={str(cut).lower()}/*")
        if cut:
            part = part.groupBy("item_id", "doc_id", "row").agg(F.sum("score").alias("score"))
        found = found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = found.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
