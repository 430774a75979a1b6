"""Remove byte strings that occur more than once, by a depth-limited radix sort of suffixes.

A suffix matters through its first ``window`` bytes only, and equal groups at that depth are the repeated
strings. Spark deals suffixes by two coarse digits, which are hashes; inside a task they are put in the order of
their bytes, most significant first, and equality is that of the bytes. A group of one leaves at once:

1. The most significant digit of a suffix is the least hash of any ``gram`` bytes inside its window.
   Equal windows have equal digits, and neighbouring suffixes share theirs, so a run of suffixes with
   one digit is held as one row.
2. The next digit of a run is the hash of all bytes its windows cover. Runs that agree in it are
   repeated as a whole: the inside of every copied passage ends here.
3. What is left under a first digit that several different runs have (the ends of passages) is sorted
   suffix by suffix. The first pass orders by eight bytes; in each further one the digit of a suffix is the
   rank of what follows the bytes already ordered, so the depth doubles until it is ``window``. Runs with
   one first digit are sorted together in a task. If they have more than FEW suffixes, as at the ends of a
   passage that a large share of documents hold, they are dealt over several tasks, long runs in pieces.
   What repeats within one is decided there by bytes; windows that are single in a task are told to the
   others by two hashes of 64 bits, dealt by their value and counted, and those that are not single go
   back to the tasks that have them.

Groups are counted with partial sums, so that a passage which most documents hold is never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.shared import CHUNK_BYTES, byte_column, chunks, on_cogroup, on_executors, on_group, store, with_row

#: Columns of the result.
ADDED = ("kept", "n_bytes", "n_removed", "n_spans")
WINDOW = 200
GRAM = 32
#: Suffixes with one first digit that are sorted in one task, about, at most. A suffix takes about 150 bytes of
#: ranks and sort, so about 160 MB, beside the bytes of the pieces.
FEW = 1 << 20
#: A piece has at most this part of FEW, so that pieces dealt by hash come out even.
PIECES = 16
#: Suffixes sorted together.
SORTED = 1 << 18
#: Suffixes of one document looked at together.
SEGMENT = 1 << 20
#: Bytes of the first pass.
WORD = 8
#: Base and multiplier of each of the two hashes of a window.
MIXERS = ((0x100000001B3, 0x9E3779B97F4A7C15), (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))

RUNS = "array<struct<key: long, span: long, at: int, n: int, twice: boolean>>"
RUN_TYPE = pa.struct(
    [("key", pa.int64()), ("span", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("twice", pa.bool_())]
)


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64."""
    out = []
    for factor in (base, pow(base, -1, 1 << 64)):
        steps = np.full(n, factor, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def gram_hashes(codes: np.ndarray, gram: int, mixer: int = 0) -> np.ndarray:
    """A hash of the ``gram`` bytes that start at each place."""
    base, factor = MIXERS[mixer]
    up, down = _powers(1 << max(8, int(len(codes)).bit_length()), base)
    sums = np.empty(len(codes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=sums[1:])
    mixed = (sums[gram:] - sums[:-gram]) * down[: len(codes) - gram + 1]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(factor)
    mixed ^= mixed >> np.uint64(29)
    return mixed


def sliding(values: np.ndarray, width: int, best: np.ufunc, fill: int) -> np.ndarray:
    """``best`` of each ``width`` neighbouring values, from the prefixes and suffixes of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, fill, np.uint64)
    padded[:n] = values
    table = padded.reshape(-1, width)
    ahead = best.accumulate(table, axis=1).ravel()
    behind = best.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - width + 1], ahead[width - 1 : n])


def runs(codes: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """Document, place, number of suffixes, digit and whether a gram repeats of every run.

    ``offsets`` bound the documents in ``codes``; none of it reaches across them.
    """
    none = np.zeros(0, np.int64)
    if len(codes) < window:
        return none, none, none, none.astype(np.uint64), none.astype(bool)
    width = window - gram + 1
    hashes = gram_hashes(codes, gram)
    least = sliding(hashes, width, np.minimum, 0xFFFFFFFFFFFFFFFF)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = owner[: len(least)] == owner[window - 1 :]
    edge = np.ones(len(least), bool)
    edge[1:] = (least[1:] != least[:-1]) | (owner[1 : len(least)] != owner[: len(least) - 1]) | (inside[1:] != inside[:-1])
    starts = np.flatnonzero(edge)
    lengths = np.diff(np.append(starts, len(least)))
    # Places whose hash is the least of some window, and those of them whose neighbour has the same.
    highest = sliding(np.concatenate([np.zeros(width - 1, np.uint64), np.where(inside, least, 0), np.zeros(width - 1, np.uint64)]), width, np.maximum, 0)
    anchors = np.flatnonzero(highest == hashes)
    again = anchors[1:][(hashes[anchors[1:]] == hashes[anchors[:-1]]) & (np.diff(anchors) <= width)]
    doc = owner[again]
    at = np.clip(again - width + 1, offsets[doc], np.maximum(offsets[doc], offsets[doc + 1] - window))
    at = np.minimum(at, len(least) - 1)
    run = np.searchsorted(starts, at, "right") - 1
    twice = np.zeros(len(starts), bool)
    twice[run[least[at] == hashes[again]]] = True
    good = inside[starts]
    starts = starts[good]
    return owner[starts], starts - offsets[owner[starts]], lengths[good], least[starts], twice[good]


def _scan(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The other columns, the packed text, its bytes and its runs."""
    pack = zstandard.ZstdCompressor(level=3).compress
    span_hash = xxhash.xxh3_64_intdigest
    for rows in batches:
        codes, offsets = byte_column(rows.column(rows.num_columns - 1))
        for first, last in chunks(offsets, SEGMENT):
            part = offsets[first : last + 1] - offsets[first]
            own = codes[offsets[first] : offsets[last]]
            found = []
            # A very long document is cut into segments, which overlap by what a window needs.
            for s in range(0, max(1, len(own) - window + 1), SEGMENT if last - first == 1 else len(own) + 1):
                end = min(len(own), s + SEGMENT + window - 1) if last - first == 1 else len(own)
                bounds = np.array([0, end - s]) if last - first == 1 else part
                doc, at, n, key, twice = runs(own[s:end], bounds, window, gram)
                found.append((doc, at + s, n, key, twice))
            doc, at, n, key, twice = (np.concatenate(x) for x in zip(*found, strict=True))
            data = own.tobytes()
            begin = part[doc] + at
            spans = [span_hash(data[a:b]) for a, b in zip(begin.tolist(), (begin + n + (window - 1)).tolist(), strict=True)]
            structs = pa.StructArray.from_arrays(
                [
                    pa.array(key.view(np.int64)), pa.array(np.array(spans, np.uint64).view(np.int64)),
                    pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(twice),
                ],
                fields=list(RUN_TYPE),
            )
            ends = np.searchsorted(doc, np.arange(last - first + 1)).astype(np.int32)
            packed = [pack(data[a:b]) for a, b in zip(part[:-1].tolist(), part[1:].tolist(), strict=True)]
            others = [c.slice(first, last - first) for c in rows.columns[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*others, pa.array(packed, pa.binary()), pa.array(np.diff(part)), pa.ListArray.from_arrays(ends, structs)],
                [*rows.schema.names[:-1], "packed", "n_bytes", "runs"],
            )


def _pieces(batches: Iterator[pa.RecordBatch], window: int, most: int) -> Iterator[pa.RecordBatch]:
    """The bytes that some runs cover, from (_row, packed, runs: key, at, n, alone, parts).

    A run of more than ``most`` suffixes comes in several pieces, whose bytes overlap by window - 1.
    """
    unpack = zstandard.ZstdDecompressor().decompress
    for rows in batches:
        lists = rows.column(2)
        flat, counts = lists.flatten(), lists.value_lengths().to_numpy()
        row = np.repeat(rows.column(0).to_numpy(), counts)
        at, n = (flat.field(k).to_numpy().astype(np.int64) for k in (1, 2))
        made = -(-n // most)
        of = np.repeat(np.arange(len(n)), made)
        skip = (np.arange(len(of)) - np.repeat(np.cumsum(made) - made, made)) * most
        at, n = at[of] + skip, np.minimum(n[of] - skip, most)
        ends = np.cumsum(np.append(0, made))[np.cumsum(np.append(0, counts))]
        pieces, first, held = [], 0, 0

        def out(last: int) -> pa.RecordBatch:
            own = pa.array(of[first:last])
            key, alone, parts = (flat.field(k).take(own) for k in (0, 3, 4))
            return pa.RecordBatch.from_arrays(
                [
                    key, pa.array(row[of[first:last]]), pa.array(at[first:last].astype(np.int32)),
                    pa.array(n[first:last].astype(np.int32)), alone, parts, pa.array(pieces, pa.binary()),
                ],
                ["key", "_row", "at", "n", "alone", "parts", "piece"],
            )

        for packed, begin, end in zip(rows.column(1), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            data = unpack(packed.as_py())
            for i in range(begin, end):
                pieces.append(data[at[i] : at[i] + n[i] + window - 1])
                held += len(pieces[-1])
                if held >= CHUNK_BYTES:
                    yield out(i + 1)
                    pieces, first, held = [], i + 1, 0
        if pieces:
            yield out(len(of))


class Suffixes:
    """The suffixes of some pieces: ``piece`` and ``place`` of each, and its window by bytes or by hashes."""

    def __init__(self, pieces: list[bytes], n: np.ndarray, window: int):
        self.window = window
        self.codes = np.frombuffer(b"".join(pieces), np.uint8)
        self.ends = np.cumsum(n + window - 1)
        self.piece = np.repeat(np.arange(len(n)), n)
        self.place = np.arange(len(self.piece)) - np.repeat(np.cumsum(n) - n, n)
        self.at = (self.ends - (n + window - 1))[self.piece] + self.place

    def groups(self) -> np.ndarray:
        """Place in the order of bytes of the window of each suffix; equal windows share it.

        Ranks of all places at depth d give those at depth 2 d: where windows agree in d bytes, the rank d
        bytes further on decides. A place whose rank no other has leaves; its rank stands for any depth.
        """
        window, size = self.window, len(self.codes)
        if not len(self.at):
            return np.zeros(0, np.int64)
        # Bytes from each place to the end of its piece.
        left = np.repeat(self.ends, np.diff(self.ends, prepend=0)) - np.arange(size)
        depth = min(WORD, window)
        open_ = np.flatnonzero(left >= depth)
        word = np.zeros(size - depth + 1, np.uint64)
        for i in range(depth):
            word = word << np.uint64(8) | self.codes[i : size - depth + 1 + i]
        rank = np.zeros(size, np.int64)
        open_ = _refine(rank, open_, word[open_])
        while depth < window:
            step = min(depth, window - depth)
            depth += step
            open_ = open_[left[open_] >= depth]
            open_ = _refine(rank, open_, rank[open_] * size + rank[open_ + step])
        return rank[self.at]

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the window of each suffix."""
        one, two = (gram_hashes(self.codes, self.window, mixer)[self.at] for mixer in range(len(MIXERS)))
        return one, two


def _refine(rank: np.ndarray, open_: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """Give the places ``open_`` new ranks, by digits that go on in the order of the old ranks.

    A group's rank is the number of places before it. Returns the places that share theirs.
    """
    order = np.argsort(digit, kind="stable")
    place, digit = open_[order], digit[order]
    old = rank[place]
    number = np.arange(len(place))
    fresh = np.append(True, digit[1:] != digit[:-1])[: len(place)]
    outer = np.append(True, old[1:] != old[:-1])[: len(place)]
    start = np.maximum.accumulate(np.where(fresh, number, 0))
    rank[place] = old + start - np.maximum.accumulate(np.where(outer, number, 0))
    return place[~(fresh & np.append(fresh[1:], True)[: len(place)])]


def counts_of(group: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """How often the group of each suffix occurs, or its weights added up."""
    return np.bincount(group, weight)[group] if len(group) else np.zeros(0)


def groups_of(*digits: np.ndarray) -> np.ndarray:
    """Number of the group of each row: those equal in all digits."""
    order = np.lexsort(digits[::-1])
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for digit in digits:
        fresh[1:] |= digit[order[1:]] != digit[order[:-1]]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(fresh) - 1
    return out


def ranges(table: pa.Table, suffixes: Suffixes, repeated: np.ndarray) -> dict:
    """Neighbouring repeated suffixes of a run as one range; only runs that stand for themselves."""
    piece, place = suffixes.piece, suffixes.place
    row, at, alone = (table.column(k).to_numpy() for k in ("_row", "at", "alone"))
    found = np.flatnonzero(repeated & alone[piece])
    edge = np.ones(len(found), bool)
    edge[1:] = (np.diff(found) > 1) | (piece[found[1:]] != piece[found[:-1]])
    first = found[edge]
    last = found[np.append(edge[1:], True)] if len(found) else found
    low, high = (at[piece[x]] + place[x] for x in (first, last))
    return {"_row": row[piece[first]], "low": low.astype(np.int32), "high": high.astype(np.int32)}


def suffixes_of(table: pa.Table, window: int) -> Suffixes:
    return Suffixes(table.column("piece").to_pylist(), table.column("n").to_numpy().astype(np.int64), window)


def _sort_pieces(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Ranges of repeated suffixes among runs with equal keys; rows come sorted by key."""
    rest: pa.Table | None = None

    def work(table: pa.Table) -> pa.RecordBatch:
        suffixes = suffixes_of(table, window)
        made = ranges(table, suffixes, counts_of(suffixes.groups()) > 1)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in made.values()], names=list(made))

    for rows in batches:
        table = pa.Table.from_batches([rows])
        rest = table if rest is None else pa.concat_tables([rest, table])
        if not rest.num_rows or pc.sum(rest.column("n")).as_py() < SORTED:
            continue
        # The last key may go on in the next batch.
        *whole, last = by_keys(rest)
        for first, end in whole:
            yield work(rest.slice(first, end - first))
        rest = rest.slice(last[0])
    if rest is not None and rest.num_rows:
        for first, end in by_keys(rest):
            yield work(rest.slice(first, end - first))


def by_keys(table: pa.Table) -> list[tuple[int, int]]:
    """Ranges of rows with about SORTED suffixes, whole keys each; the last range has the last key only."""
    key = table.column("key").to_numpy()
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    before = np.append(0, np.cumsum(table.column("n").to_numpy().astype(np.int64)))[starts]
    out = [(int(starts[a]), int(starts[b])) for a, b in chunks(before, SORTED)] if len(starts) > 1 else []
    return [*out, (int(starts[-1]), table.num_rows)]


DIGITS = np.dtype([("one", "<u8"), ("two", "<u8"), ("twice", "u1")])


def _single_digits(table: pa.Table, window: int) -> pa.Table:
    """Each window of some runs once, as hashes, and whether it repeats there, packed by the bucket that counts it."""
    suffixes = suffixes_of(table, window)
    one, two = suffixes.hashes()
    # A run that stands for several equal ones counts for more than one.
    weight = np.where(table.column("alone").to_numpy(), 1, 2)[suffixes.piece]
    group = suffixes.groups()
    _, first = np.unique(group, return_index=True)
    found = np.empty(len(first), DIGITS)
    found["one"], found["two"], found["twice"] = one[first], two[first], counts_of(group, weight)[first] > 1
    bucket = (found["one"] % np.uint64(table.column("parts")[0].as_py())).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    found, bucket = found[order], bucket[order]
    ends = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    same = {k: pa.array(np.full(len(ends) - 1, table.column(k)[0].as_py(), np.int64)) for k in ("key", "part")}
    packed = [found[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    return pa.table(same | {"bucket": bucket[ends[:-1]], "digits": pa.array(packed, pa.binary())})


def _repeated_digits(table: pa.Table) -> pa.Table:
    """Of the digits of a bucket those that are single in a part and not over all, by part."""
    lists = [np.frombuffer(x, DIGITS) for x in table.column("digits").to_pylist()]
    found, owner = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    group = groups_of(found["one"], found["two"])
    back = (np.bincount(group, 1 + found["twice"])[group] > 1) & (found["twice"] == 0)
    packed = [found[(back[a:b]).nonzero()[0] + a].tobytes() for a, b in _spans(owner, len(lists))]
    return pa.table(
        {"key": table.column("key"), "part": table.column("part"), "digits": pa.array(packed, pa.binary())}
    ).filter(pa.array([len(x) > 0 for x in packed], pa.bool_()))


def _spans(owner: np.ndarray, n: int) -> list[tuple[int, int]]:
    ends = np.searchsorted(owner, np.arange(n + 1)).tolist()
    return list(zip(ends[:-1], ends[1:], strict=True))


def _part_ranges(table: pa.Table, known: pa.Table, window: int) -> pa.Table:
    """Ranges of suffixes of some runs that repeat there or whose hashes are known to repeat."""
    if not table.num_rows:
        return pa.table({"_row": pa.array([], pa.int64()), "low": pa.array([], pa.int32()), "high": pa.array([], pa.int32())})
    suffixes = suffixes_of(table, window)
    weight = np.where(table.column("alone").to_numpy(), 1, 2)[suffixes.piece]
    repeated = counts_of(suffixes.groups(), weight) > 1
    more = np.frombuffer(b"".join(known.column("digits").to_pylist()), DIGITS)
    if len(more):
        one, two = suffixes.hashes()
        told = groups_of(np.append(one, more["one"]), np.append(two, more["two"]))
        repeated |= counts_of(told, np.append(np.zeros(len(one)), np.ones(len(more))))[: len(one)] > 0
    return pa.table(ranges(table, suffixes, repeated))


def _cut(batches: Iterator[pa.RecordBatch], window: int, as_text: bool) -> Iterator[pa.RecordBatch]:
    """Texts without the bytes their repeated windows cover; the last two columns: packed, windows."""
    unpack = zstandard.ZstdDecompressor().decompress
    for rows in batches:
        kept, removed, spans = [], [], []
        for packed, wanted in zip(rows.column(rows.num_columns - 2), rows.column(rows.num_columns - 1), strict=True):
            data = unpack(packed.as_py())
            rest, gone, count = data, 0, 0
            if wanted.is_valid and len(wanted.values):
                low, high = (wanted.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                change = np.zeros(len(data) + 1, np.int64)
                np.add.at(change, low, 1)
                np.add.at(change, high + window, -1)
                covered = np.cumsum(change[:-1]) > 0
                gone = int(covered.sum())
                count = int(covered[0]) + int((np.diff(covered.view(np.int8)) > 0).sum())
                rest = np.frombuffer(data, np.uint8)[~covered].tobytes()
            kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
            removed.append(gone)
            spans.append(count)
        yield pa.RecordBatch.from_arrays(
            [*rows.columns[:-2], pa.array(kept, pa.string() if as_text else pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())],
            [*rows.schema.names[:-2], "kept", "n_removed", "n_spans"],
        )


def repeated_windows(scanned: DataFrame, window: int) -> DataFrame:
    """(_row, low, high): ranges of suffixes whose window occurs more than once."""
    every = scanned.select("_row", F.inline("runs"))
    # First digit: only runs that share it, or hold a gram twice, go on.
    shared = every.groupBy("key").agg(F.count("*").alias("runs"), F.max("twice").alias("again"))
    shared = shared.where((F.col("runs") > 1) | F.col("again")).select("key")
    going = store(every.join(shared, "key", "left_semi"), "going")
    # Second digit: equal runs are repeated as a whole.
    spans = going.groupBy("key", "span").agg(
        F.count("*").alias("times"), F.min(F.struct("_row", "at", "n")).alias("first"), F.max("twice").alias("twice")
    )
    spans = store(spans, "spans")
    copied = spans.where("times > 1").select("key", "span")
    whole = going.join(copied, ["key", "span"], "left_semi").select(
        "_row", F.col("at").alias("low"), (F.col("at") + F.col("n") - 1).alias("high")
    )
    # Sort: one run of each kind under the keys that have several.
    keys = spans.groupBy("key").agg(
        F.count("*").alias("kinds"), F.sum(F.col("first.n").cast("long")).alias("suffixes"), F.max("twice").alias("again")
    )
    parts = F.ceil(F.col("suffixes") / max(1, FEW)).cast("int").alias("parts")
    keys = keys.where((F.col("kinds") > 1) | F.col("again")).select("key", parts)
    run = F.struct("key", "first.at", "first.n", (F.col("times") == 1).alias("alone"), "parts").alias("run")
    lists = spans.join(keys, "key").select("first._row", run).groupBy("_row").agg(F.collect_list("run").alias("runs"))
    texts = scanned.select("_row", "packed").join(lists.hint("shuffle_hash"), "_row")
    piece_type = "key long, _row long, at int, n int, alone boolean, parts int, piece binary"
    pieces = store(texts.mapInArrow(on_executors(_pieces, window, max(1, FEW // PIECES)), piece_type), "pieces")
    range_type = "_row long, low int, high int"
    few = pieces.where("parts = 1").repartition("key").sortWithinPartitions("key")
    sorted_ranges = few.mapInArrow(on_executors(_sort_pieces, window), range_type)
    many = pieces.where("parts > 1").withColumn("part", F.pmod(F.xxhash64("_row", "at"), F.col("parts")))
    digits = many.groupBy("key", "part").applyInArrow(
        on_group(_single_digits, window), "key long, part long, bucket long, digits binary"
    )
    back = digits.groupBy("key", "bucket").applyInArrow(on_group(_repeated_digits), "key long, part long, digits binary")
    dealt = many.groupBy("key", "part").cogroup(back.groupBy("key", "part")).applyInArrow(
        on_cogroup(_part_ranges, window), range_type
    )
    return whole.unionByName(sorted_ranges).unionByName(dealt)


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, text: str = "text", as_text: bool = False) -> DataFrame:
    """``docs`` with ``kept`` in place of the text, and n_bytes, n_removed and n_spans.

    Every byte goes that lies in a string of ``window`` bytes which starts anywhere else too, in the same
    or another document; strings may overlap and are judged on the input. n_spans counts maximal removed
    runs. ``kept`` is binary, or with ``as_text`` a string, from which pieces of characters cut apart are
    dropped. Null counts as empty; texts below ``window`` bytes keep all. Repeated rows are documents of
    their own: both lose all they share. Other columns stay; columns with the new names are replaced.

    Texts are scanned once and stored packed with their runs; all later steps work on digits and places,
    and the packed texts are joined twice by row number to the places that concern them.
    """
    names = {c: f"c{i}" for i, c in enumerate(c for c in docs.columns if c != text and c not in ADDED)}
    inner = with_row(docs.select(*[docs[c].alias(n) for c, n in names.items()], docs[text].alias("_text")))
    fields = ", ".join(f"{n} {inner.schema[n].dataType.simpleString()}" for n in ["_row", *names.values()])
    scanned = inner.mapInArrow(on_executors(_scan, window, gram), f"{fields}, packed binary, n_bytes long, runs {RUNS}")
    scanned = store(scanned, "scanned")
    found = repeated_windows(scanned, window).groupBy("_row").agg(F.collect_list(F.struct("low", "high")).alias("gone"))
    rest = scanned.select("_row", *names.values(), "n_bytes", "packed").join(found.hint("shuffle_hash"), "_row", "left")
    schema = f"{fields}, n_bytes long, kept {'string' if as_text else 'binary'}, n_removed long, n_spans long"
    made = rest.mapInArrow(on_executors(_cut, window, as_text), schema)
    return made.select(*[F.col(n).alias(c) for c, n in names.items()], *ADDED)
