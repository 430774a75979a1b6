"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, digits, plus signs before a digit, address
schemes and words that announce an identifier. At each anchor a local parser looks at the characters
around it, settles where the address or number begins and ends, and checks it. A parser starts where
the last span of its kind ended, so that spans are those of a leftmost, non-overlapping search.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.shared import on_executors

# Kinds in the order of reports, those that every search must have first.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
# Address schemes, and words that announce an identifier.
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("account", "acct", "iban", "passport", "ssn")
#: Fewest digits of an identifier behind a cue.
CUE_DIGITS = 6

SPANS = "array<struct<kind:string,start:int,end:int>>"
MARK = "\N{FULL BLOCK}"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# What follows an anchor. Repeats are possessive: no text makes a parser go back over what it read.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TARGET = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++(?::[0-9]++)?(?:/[A-Za-z0-9._~%/?#&=+-]*+)?")
IDENTIFIER = re.compile(r"[ :#=]{1,3}([A-Z]{0,2}[0-9][0-9A-Z-]{4,32})")
DIGITS = re.compile("[0-9]")

Span = tuple[int, int, int]


def luhn(digits: list[int]) -> bool:
    doubled = [2 * d - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


class Finder:
    """The automaton and the parsers; ``spans`` gives (kind, start, end) in code points."""

    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        anchors = [("@", "email")] + [(str(d), "digit") for d in range(10)] + [(f"+{d}", "phone") for d in range(10)]
        anchors += [(x, "url") for x in SCHEMES] + [(x, "account") for x in CUES]
        for text, kind in anchors:
            self.automaton.add_word(text, (kind, len(text)))
        self.automaton.make_automaton()

    def spans(self, text: str) -> list[Span]:
        """All spans, by kind and start."""
        found: list[list[tuple[int, int]]] = [[] for _ in KINDS]
        done = dict.fromkeys((*KINDS, "dotted"), 0)
        for last, (kind, length) in self.automaton.iter(text):
            start = last + 1 - length
            if kind == "digit":
                if start >= done["card"]:
                    done["card"] = self._card(text, start, found[2])
                if start >= done["dotted"]:
                    done["dotted"] = self._dotted(text, start, found[1])
            elif start < done[kind]:
                continue
            elif kind == "email":
                done[kind] = self._email(text, start, done[kind], found[0])
            elif kind == "phone":
                done[kind] = self._phone(text, start, found[3])
            elif kind == "url":
                done[kind] = self._url(text, start, last + 1, found[4])
            else:
                done[kind] = self._account(text, start, last + 1, found[5])
        return [(kind, a, b) for kind, own in enumerate(found) for a, b in own]

    # Each parser appends what it accepts and returns where the next search of its kind may begin.

    def _email(self, text: str, at: int, begin: int, out: list) -> int:
        first = at
        while first > begin and text[first - 1] in LOCAL:
            first -= 1
        domain = DOMAIN.match(text, at + 1) if first < at else None
        if domain is None:
            return at
        out.append((first, domain.end()))
        return domain.end()

    def _dotted(self, text: str, start: int, out: list) -> int:
        """A chain of dotted numbers, four at a time."""
        chain = DOTTED.match(text, start)
        parts, at = chain.group().split("."), start
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                out.append((at, end))
            at = end + 1
        return chain.end()

    def _card(self, text: str, start: int, out: list) -> int:
        chain = NUMBER.match(text, start)
        if chain is None:
            return start + 1
        # The longest card has 19 digits and a separator between any two.
        if chain.end() - start <= 2 * 19 - 1:
            digits = [int(d) for d in DIGITS.findall(chain.group())]
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((start, chain.end()))
        return chain.end()

    def _phone(self, text: str, start: int, out: list) -> int:
        number = PHONE.match(text, start)
        if number is None:
            return start + 1
        if 8 <= len(DIGITS.findall(number.group())) <= 15:
            out.append((start, number.end()))
        return number.end()

    def _url(self, text: str, start: int, host: int, out: list) -> int:
        target = TARGET.match(text, host)
        if target is None:
            return start + 1
        out.append((start, target.end()))
        return target.end()

    def _account(self, text: str, start: int, end: int, out: list) -> int:
        identifier = IDENTIFIER.match(text, end)
        if identifier is None:
            return start + 1
        if len(DIGITS.findall(identifier.group(1))) >= CUE_DIGITS:
            out.append(identifier.span(1))
        return identifier.end()


_finder: list[Finder] = []


def finder() -> Finder:
    """One automaton per worker process."""
    if not _finder:
        _finder.append(Finder())
    return _finder[0]


def masked(text: str, spans: list[Span], mark: str = MARK) -> str:
    """The text with every character inside a span replaced by a mark."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        start = max(start, at)
        if end > start:
            out += [text[at:start], mark * (end - start)]
            at = end
    return "".join([*out, text[at:]])


def _find(batches: Iterator[pa.RecordBatch], mask: bool) -> Iterator[pa.RecordBatch]:
    names = pa.array(KINDS)
    for rows in batches:
        kinds, starts, ends, bounds, texts = [], [], [], [0], []
        for value in rows.column(rows.num_columns - 1):
            text = value.as_py() or ""
            for kind, start, end in (own := finder().spans(text)):
                kinds.append(kind)
                starts.append(start)
                ends.append(end)
            bounds.append(len(kinds))
            if mask:
                texts.append(masked(text, own))
        flat = pa.StructArray.from_arrays(
            [names.take(pa.array(kinds, pa.int32())), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
            ["kind", "start", "end"],
        )
        spans = pa.ListArray.from_arrays(pa.array(np.array(bounds, np.int32)), flat)
        columns, labels = [*rows.columns[:-1], spans], [*rows.schema.names[:-1], "_spans"]
        if mask:
            columns, labels = [*columns, pa.array(texts, pa.string())], [*labels, "_masked"]
        yield pa.RecordBatch.from_arrays(columns, labels)


def find_spans(docs: DataFrame, text: str = "text", out: str = "spans", mask: str | None = None) -> DataFrame:
    """``docs`` with an array of spans (kind, start, end) in place of the text, ordered by kind and start.

    Offsets count code points, the end is exclusive. Kinds are those of ``KINDS``; spans of different
    kinds may overlap. ``mask`` names a column for the text with all spans blotted out.

    One row for each row, in one narrow pass. A null or empty text has no spans (masked: empty text);
    repeated rows get the same. All other columns stay, whatever their names; those called like the new
    ones are replaced. Texts are looked at whole.
    """
    keep = [c for c in docs.columns if c not in (text, out, mask)]
    inner = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], docs[text].alias("_text"))
    fields = "".join(f"c{i} {inner.schema[i].dataType.simpleString()}, " for i in range(len(keep)))
    fields += f"_spans {SPANS}" + (", _masked string" if mask else "")
    found = inner.mapInArrow(on_executors(_find, mask is not None), fields)
    made = [F.col(f"c{i}").alias(c) for i, c in enumerate(keep)] + [F.col("_spans").alias(out)]
    return found.select(*made, *([F.col("_masked").alias(mask)] if mask else []))
