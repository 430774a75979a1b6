"""Token counts of a BPE with word ends, merged over ragged arrays in rank order.

The distinct pre-tokens of a batch of texts are held as one flat array of symbols with row offsets.
Each round finds every sequence's lowest-rank pair and merges all its occurrences, in all sequences
at once; a sequence without a mergeable pair is done, and its count is its surviving symbols.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.byte_bpe import byte_letters
from plantlake.llm.ragged import PairTable, merge_rows
from plantlake.llm.shared import byte_column, chunks, on_executors

# Fixed value: the pre-tokens of the vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"

#: Pre-tokens whose count is kept per worker; longer ones are counted each time.
CACHE_WORDS = 300_000
CACHE_CHARS = 64


class WordBpe:
    """Counter of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = {b: c for c, b in byte_letters().items()}
        self.inner = np.array([vocab[letters[b]] for b in range(256)])
        self.last = np.array([vocab[letters[b] + end] for b in range(256)])
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        columns = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges])
        self.table = PairTable(*columns.T)
        self.words = regex.compile(WORDS)
        marks = sorted((regex.escape(t["content"]) for t in spec["added_tokens"]), key=len, reverse=True)
        self.marks = regex.compile("|".join(marks))
        self.known: dict[str, int] = {}

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """The words of a text and the number of its special tokens."""
        marks = len(self.marks.findall(text)) if "<|" in text else 0
        parts = self.marks.split(text) if marks else [text]
        words: list[str] = []
        for part in parts:
            # Letter by letter, as the vocabulary lower-cases: a final sigma is an ordinary one.
            words += self.words.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return words, marks

    def count_words(self, words: list[str]) -> np.ndarray:
        data = [w.encode() for w in words]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        codes = np.frombuffer(b"".join(data), np.uint8)
        symbols = self.inner[codes]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[codes[ends]]
        return merge_rows(symbols, lengths, self.table)[1]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        split = [self.pre_tokens(t) for t in texts]
        used = set().union(*(words for words, _ in split))
        new = [w for w in used if w not in self.known]
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = list(used)
        if new:
            self.known.update(zip(new, self.count_words(new).tolist(), strict=True))
        counts = [sum(map(self.known.__getitem__, words)) + marks for words, marks in split]
        for word in new:
            if len(word) > CACHE_CHARS:
                del self.known[word]
        return counts


@lru_cache(maxsize=4)
def counter(path: str) -> WordBpe:
    return WordBpe(path)


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    bpe = counter(path)
    for rows in batches:
        texts = rows.column(rows.num_columns - 1).fill_null("")
        counts: list[int] = []
        for first, last in chunks(byte_column(texts)[1]):
            counts += bpe.count(texts.slice(first, last - first).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [*rows.columns[:-1], pa.array(counts, pa.int64())], rows.schema.names[:-1] + ["_n"]
        )


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of tokens of each whole text in ``out``, in place of the text.

    One row for each row, in one narrow pass: no shuffle. Null and empty texts have none; repeated rows
    count alike. All other columns stay, whatever their names; a column called ``out`` is replaced.
    """
    keep = [c for c in docs.columns if c not in (text, out)]
    inner = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], docs[text].alias("_text"))
    fields = "".join(f"c{i} {inner.schema[i].dataType.simpleString()}, " for i in range(len(keep)))
    made = inner.mapInArrow(on_executors(_count, path), f"{fields}_n long")
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("_n").alias(out))
