"""Byte-level BPE: encode by splitting where no token can lie, and decode.

A pair of bytes that occurs inside no vocabulary token is a certain token boundary: a token across it
would hold the pair. Each word of the pre-tokenizer is cut at all such pairs, and the fragments are
encoded independently and concatenated. Merges never cross a cut, so the ids are those of the whole
word, and a very long word without spaces falls into short fragments.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.ragged import PairTable, merge_rows
from plantlake.llm.shared import byte_column, chunks, on_executors

# The words a byte-level pre-tokenizer makes.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

#: Words kept with their ids per worker; longer ones are encoded each time.
CACHE_WORDS = 200_000
CACHE_CHARS = 64


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself if it prints, else 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, model = byte_letters(), spec["model"]
        self.ids = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        columns = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in merges])
        self.table = PairTable(*columns.T)
        self.single = np.array([self.ids[bytes([b])] for b in range(256)])
        inside = np.zeros((256, 256), bool)
        for token in self.ids:
            codes = np.frombuffer(token, np.uint8)
            inside[codes[:-1], codes[1:]] = True
        self.cut = ~inside
        self.bytes_of = {i: t for t, i in self.ids.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.words = regex.compile(WORDS)
        self.known: dict[str, bytes] = {}
        marks = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.marks = regex.compile(f"({'|'.join(marks)})") if marks else None

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as int32 bytes.

        All words lie in one array of bytes, whose certain cuts make the fragments; these are merged
        independently, and the fragments of a word stand one behind the other again.
        """
        data = [w.encode() for w in words]
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        codes = np.frombuffer(b"".join(data), np.uint8)
        starts_fragment = np.ones(len(codes), bool)
        starts_fragment[1:] = self.cut[codes[:-1], codes[1:]]
        starts_fragment[ends[:-1]] = True
        starts = np.flatnonzero(starts_fragment)
        ids, lengths = merge_rows(self.single[codes], np.diff(np.append(starts, len(codes))), self.table)
        made = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, ends)] * 4
        flat = ids.tobytes()
        return [flat[a:b] for a, b in zip([0, *made[:-1].tolist()], made.tolist(), strict=True)]

    def parts(self, text: str) -> list[str]:
        """The text between special tokens and, at odd places, those tokens."""
        return self.marks.split(text) if self.marks and self.marks.search(text) else [text]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        parts = [self.parts(t) for t in texts]
        words = [[self.words.findall(p) for p in ps[::2]] for ps in parts]
        used = set().union(*(w for ws in words for w in ws))
        new = [w for w in used if w not in self.known]
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known.clear()
            new = list(used)
        if new:
            self.known.update(zip(new, self.encode_words(new), strict=True))
        out = []
        for ps, ws in zip(parts, words, strict=True):
            pieces = [b"".join(map(self.known.__getitem__, ws[0]))]
            for mark, w in zip(ps[1::2], ws[1:], strict=True):
                pieces += [np.int32(self.special[mark]).tobytes(), *map(self.known.__getitem__, w)]
            out.append(np.frombuffer(b"".join(pieces), np.int32))
        for word in new:
            if len(word) > CACHE_CHARS:
                del self.known[word]
        return out

    def decode(self, ids) -> str:
        """Text of ids; special tokens are kept, bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteBpe:
    return ByteBpe(path)


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    bpe = tokenizer(path)
    for rows in batches:
        keep = rows.schema.names[:-1]
        texts = rows.column(len(keep)).fill_null("")
        for first, last in chunks(byte_column(texts)[1]):
            ids = bpe.encode(texts.slice(first, last - first).to_pylist())
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, np.concatenate(ids))
            others = [rows.column(k).slice(first, last - first) for k in keep]
            yield pa.RecordBatch.from_arrays([*others, lists], [*keep, "_ids"])


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    bpe = tokenizer(path)
    for rows in batches:
        lists = rows.column(rows.num_columns - 1)
        flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().fill_null(0).to_numpy())
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        texts = [bpe.decode(flat[a:b].tolist()) for a, b in zip(starts, ends, strict=True)]
        yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(texts, pa.string())], rows.schema.names[:-1] + ["_text"])


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text in array column ``out``, in place of the text.

    One row for each row, in one narrow pass: no shuffle. A null text counts as empty and has no ids;
    repeated rows are encoded alike. All other columns stay, whatever their names; a column already
    called ``out`` is replaced. Special strings inside a text become their special token.
    """
    keep = [c for c in docs.columns if c not in (text, out)]
    inner = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], docs[text].alias("_text"))
    fields = ", ".join(f"c{i} {inner.schema[i].dataType.simpleString()}" for i in range(len(keep)))
    made = inner.mapInArrow(on_executors(_encode, path), f"{fields + ', ' if fields else ''}_ids array<int>")
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("_ids").alias(out))


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in column ``out``; all other columns and the ids stay.

    Null ids decode to the empty text.
    """
    keep = [c for c in encoded.columns if c != out]
    inner = encoded.select(*[encoded[c].alias(f"c{i}") for i, c in enumerate(keep)], encoded[ids].alias("_ids"))
    fields = ", ".join(f"c{i} {inner.schema[i].dataType.simpleString()}" for i in range(len(keep)))
    made = inner.mapInArrow(on_executors(_decode, path), f"{fields}, _text string")
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("_text").alias(out))
