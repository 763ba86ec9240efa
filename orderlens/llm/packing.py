"""Best-fit decreasing packing into windows of a fixed number of ids.

Overlong documents are first cut into full windows.  What is left of each
document is shorter than a window, so its sizes are a histogram with fewer
bins than a window has ids; best-fit decreasing runs on that histogram, all
pieces of one size at a time.  A segment tree over remaining capacities
finds the tightest open window, and runs of windows with the same
remaining capacity are placed together, so planning takes the same time
for any number of documents.  The plan says which run of windows takes the
pieces of a size from one rank to another; each piece finds its place from
its size and its rank among the pieces of that size.  Ranks are counted
inside each part of the written piece table and offset by part, so no size,
however frequent, meets in one task.

Defined results: a null text is empty and still has its end id; every row is
packed, also those that repeat an id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import scratch
from .encode import END_ID, encoder, in_turn
from .memory import trimmed
from .token_files import id_lists

#: Ids of a window.
WINDOW = 1024


class Capacities:
    """A segment tree over capacities: the smallest one at or above a size that has open windows."""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.open = [False] * (2 * self.width)

    def put(self, capacity: int, there: bool) -> None:
        node = self.width + capacity
        self.open[node] = there
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, size: int) -> int | None:
        node = self.width + size
        if self.open[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.width:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.width
            node //= 2
        return None


def plan(histogram: dict[int, int], window: int = WINDOW) -> tuple[np.ndarray, int]:
    """Best-fit decreasing for ``histogram`` (pieces by size): rows of
    (size, first rank, pieces, first window, offset, pieces in each window), and the number of windows."""
    tree, runs, rows, windows = Capacities(window), {}, [], 0

    def add(capacity: int, first: int, n: int, used: int) -> None:
        if n and capacity:
            runs.setdefault(capacity, []).append((first, n, used))
            tree.put(capacity, True)

    for size in sorted(histogram, reverse=True):
        rank, left = 0, histogram[size]
        while left:
            capacity = tree.tightest(size)
            if capacity is None:
                n = -(-left // (window // size))
                add(window, windows, n, 0)
                windows += n
                continue
            first, n, used = runs[capacity].pop()
            if not runs[capacity]:
                tree.put(capacity, False)
            each = capacity // size
            full = min(n, left // each)  # the tightest window stays the tightest until it is full
            if full:
                rows.append((size, rank, full * each, first, used, each))
                add(capacity - each * size, first, full, used + each * size)
                rank, left = rank + full * each, left - full * each
            rest = n - full
            if rest and left:  # fewer pieces than the next window would take
                rows.append((size, rank, left, first + full, used, left))
                add(capacity - left * size, first + full, 1, used + left * size)
                rest, left = rest - 1, 0
                add(capacity, first + full + 1, rest, used)
            else:
                add(capacity, first + full, rest, used)
    return np.array(rows, np.int64).reshape(-1, 6), windows


_SCHEMA = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()),
                     ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                     ("local", pa.int64()), ("ids", pa.list_(pa.int32()))])
_DDL = ("part int, row long, doc_id long, start long, length long, doc_tokens long, ids_crc32 long, "
        "local long, ids array<int>")


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """The pieces of all documents with their ids, written once; ``local`` counts the
    pieces of a length before it in its part."""
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, part, row = encoder(tokenizer), TaskContext.get().partitionId(), 0
        seen = [0] * (window + 1)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for a, b in in_turn(texts):
                rows = []
                for doc_id, packed in zip(doc_ids[a:b], encode_texts(texts[a:b]), strict=True):
                    packed += end
                    total = len(packed) // 4
                    for start in range(0, total, window):
                        ids = packed[4 * start:4 * (start + window)]
                        length = len(ids) // 4
                        rows.append((part, row, doc_id, start, length, total, zlib.crc32(ids), seen[length], ids))
                        row, seen[length] = row + 1, seen[length] + 1
                *columns, packed = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, t) for c, t in zip(columns, _SCHEMA.types, strict=False)), id_lists(packed)],
                    schema=_SCHEMA)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scratch.materialise(rows.mapInArrow(trimmed(cut, encodes=True), _DDL), "pieces")


_PLACED = ["part", "row", "doc_id", "start", "length", "doc_tokens", "ids_crc32", "sequence_id", "offset"]


def place(cut: DataFrame, window: int = WINDOW, carried: tuple[str, ...] = ()) -> DataFrame:
    """Of pieces the sequence_id and offset, with the columns ``carried``; the ids are not read
    for it unless they are among these."""
    names = [*_PLACED[:-2], *carried, *_PLACED[-2:]]
    narrow = cut.select(*_PLACED[:-2], "local", *carried)
    counts = scratch.materialise(narrow.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # Bounded: a row for each length up to the window's.
    sizes = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    sizes.pop(window, None)
    table, windows = plan(sizes, window)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = narrow.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("local"))
    by_size = {int(s): table[table[:, 0] == s] for s in np.unique(table[:, 0])}

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = windows + rank, np.zeros(len(rank), np.int64)  # of full windows
            for size in np.unique(length[length < window]):
                own, runs = np.flatnonzero(length == size), by_size[int(size)]
                runs = runs[np.argsort(runs[:, 1])]
                _, first_rank, _, first, used, each = runs[np.searchsorted(runs[:, 1], rank[own], "right") - 1].T
                nth = rank[own] - first_rank
                sequence[own], offset[own] = first + nth // each, used + nth % each * size
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names[:-2]), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=names)

    schema = StructType([ranked.schema[c] for c in names[:-2]]).add("sequence_id", "long").add("offset", "long")
    return ranked.select(*names[:-2], "rank").mapInArrow(seat, schema)


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """Where each piece of each document goes: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    return place(pieces(docs, tokenizer, window), window).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def sequences(docs: DataFrame, tokenizer: str, window: int = WINDOW, pad_id: int = END_ID) -> DataFrame:
    """The packed sequences: sequence_id, input_ids (padded to the window, except where their number is a
    power of two), n_tokens, doc_ids, offsets (where each document's piece begins)."""
    cut = pieces(docs, tokenizer, window)
    # The ids go with their pieces, so they are shuffled once, by sequence.
    rows = place(cut, window, ("ids",)).select("sequence_id", "offset", "doc_id", "ids")
    return (rows.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
            .mapInArrow(trimmed(lambda b: _joined(b, window, pad_id)), _SEQUENCES))


_SEQUENCES = "sequence_id long, input_ids array<int>, n_tokens long, doc_ids array<long>, offsets array<long>"


def _joined(batches: Iterator[pa.RecordBatch], window: int, pad_id: int) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (sequence, offset) to sequences; at most one is held from a batch to the next."""
    def sequences_of(rows: pa.RecordBatch) -> pa.RecordBatch:
        ids, sequence = rows.column("ids"), rows.column("sequence_id").to_numpy()
        first = np.flatnonzero(np.diff(sequence, prepend=sequence[0] - 1))
        values, ends = ids.flatten().to_numpy(), np.cumsum(ids.value_lengths().to_numpy())
        stops = ends[np.append(first[1:], len(rows)) - 1].astype(np.int64)
        n = np.diff(stops, prepend=0)
        size = np.where(n & (n - 1), window, n)  # a power of two is not padded
        starts = np.cumsum(size) - size
        out = np.full(int(size.sum()), pad_id, np.int32)
        out[np.repeat(starts - (stops - n), n) + np.arange(len(values))] = values
        offsets = pa.array(np.append(first, len(rows)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(sequence[first]), pa.ListArray.from_arrays(pa.array(np.append(starts, size.sum()).astype(np.int32)), pa.array(out)),
             pa.array(n), *(pa.ListArray.from_arrays(offsets, rows.column(c)) for c in ("doc_id", "offset"))],
            names=["sequence_id", "input_ids", "n_tokens", "doc_ids", "offsets"])

    held = None
    for batch in batches:
        for a in range(0, len(batch), 2_000):
            rows = batch.slice(a, 2_000)
            if held is not None:
                rows = pa.concat_batches([held, rows])
            sequence = rows.column("sequence_id").to_numpy()
            cut = int(np.searchsorted(sequence, sequence[-1]))
            if cut:
                yield sequences_of(rows.slice(0, cut))
            held = rows.slice(cut)
    if held is not None:
        yield sequences_of(held)
