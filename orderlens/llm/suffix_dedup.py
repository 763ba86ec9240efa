"""Repeated passages found by hash-sorted windows at content-defined anchors, instead of suffix arrays.

Each byte that a string of ``LENGTH`` bytes covers which also starts in a document with a
smaller id is removed.  Windows are grouped by anchors: in every
window of ``LENGTH`` bytes the ``GRAM`` bytes with the smallest hash are the window's
anchor, so equal windows have equal anchors at equal places, whatever surrounds them.
A record is an anchor with all windows it serves, 16 on average.

First the anchors' hashes alone are shuffled and sorted: an anchor that occurs once has no
window that occurs twice, so only records whose anchor occurs again are made, by a second
scan of documents that have met their repeated anchors (``_repeated``, ``_met``).  An anchor that
a task meets twice needs no answer: the task sends one row for all its records, so a passage that
a third of all documents share is one row from each batch.

Batches of documents give these records sorted by bucket (the anchor's hash) and suffix; a
bucket meets in one task.  Anchors with so many records that a bucket would exceed ``MOST`` are
left out there and brought to the smallest id of each context and window by aggregates
(``_cover_hot``).  In a bucket's task, runs of records enter a family of levels: each level
holds sorted windows with the smallest id each occurs in, and levels of equal size
merge geometrically.  Then every run is looked up in the levels by binary search, and a window whose
entry has a smaller id is compared with it byte by byte.  What is covered goes, packed,
to its document's bucket, where it meets the text.  The buckets' number grows with the
text, so that each has about ``BUCKET_BYTES`` of it.

Defined results: a null text is empty; a text shorter than ``LENGTH`` loses nothing; a null id
comes before all others; rows that repeat an id are judged each by its own text, and lose nothing
to each other; an empty table gives an empty result; texts of any length are read whole, slice by slice.
Where a cut leaves part of a character, ``kept_text`` drops that part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from . import scratch
from .blocks import by_block
from .columns import carrying
from .memory import trimmed
from .words import mix, powers

LENGTH, GRAM = 50, 20
#: Anchors that a window can have, and bytes of a record's windows together.
PLACES = LENGTH - GRAM + 1
CONTEXT = LENGTH + PLACES - 1
#: Text of a bucket; text that is searched for anchors at a time; records of a sorted batch.
BUCKET_BYTES, SLICE, BATCH = 1 << 20, 1 << 19, 200_000
#: Records of a bucket that one task takes at most (an average one has 50,000); places in a row of a hot context.
MOST, TOGETHER = 400_000, 512
#: Records that a task combines by anchor at a time.
COMBINED = 1 << 20
#: Windows of a run that enters the levels; windows that are held at a time.
RUN, HELD = 1 << 18, 2 << 20

_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_BYTES = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64)
_RECORD = np.dtype([("doc", "<i8"), ("tie", "<i8"), ("at", "<i8"), ("n", "u1")])
_COVER = np.dtype([("doc", "<i8"), ("tie", "<i8"), ("at", "<i8"), ("n", "<i8")])


def _hashes(raw: np.ndarray, length: int) -> np.ndarray:
    """The hash of the ``length`` bytes at each place."""
    n = len(raw) - length + 1
    total = np.concatenate([np.zeros(1, np.uint64),
                            np.cumsum(_BYTES[raw] * powers(_BASE, len(raw))[:len(raw)], dtype=np.uint64)])
    return mix((total[length:] - total[:-length]) * powers(_INVERSE, len(raw))[:n])


def anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows of ``raw`` (``LENGTH`` bytes at least), in runs with the same anchor: the
    first window of each run, how many windows it has, its anchor and 48 bits of the anchor's hash."""
    grams = _hashes(raw, GRAM)
    place = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << 24) - 1)
    least = (grams & ~low) | place  # the first of equal hashes is the smallest
    step = 1
    while 2 * step <= PLACES:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if PLACES > step:
        least = np.minimum(least[:step - PLACES], least[PLACES - step:])
    anchor = (least & low).astype(np.int64)
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    return first, np.diff(first, append=len(anchor)), anchor[first], grams[anchor[first]] >> np.uint64(16)


def _slices(size: int) -> Iterator[tuple[int, int]]:
    """Ranges of a text that overlap so that each window lies in just one."""
    for at in range(0, max(1, size - LENGTH + 1), SLICE):
        yield at, min(size, at + SLICE + LENGTH - 1)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """The parts as one array; the list lets go of them, so they are not held twice."""
    out = np.concatenate(parts)
    parts.clear()
    return out


def _inside(n: np.ndarray) -> np.ndarray:
    """Which bytes of their contexts records with n windows use."""
    return np.arange(CONTEXT)[None, :] < (n.astype(int) + LENGTH - 1)[:, None]


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of pieces of documents the bytes and the records: heads, where each begins, its anchor and the anchor's hash."""
    def records(docs: list[tuple[int, int, int, int]], data: bytes) -> tuple:
        """docs: id, tie, offset of this slice in its text, and end of the slice in ``data``."""
        raw = np.frombuffer(data, np.uint8)
        first, n, anchor, hashed = anchors(raw)
        ends = np.array([d[3] for d in docs])
        starts = np.concatenate([[0], ends[:-1]])
        # A run may begin before a border between texts and go on behind it: cut it there, and
        # drop windows across a border.
        cut = np.concatenate([first, starts[1:]])
        run = np.concatenate([np.arange(len(first)), np.searchsorted(first, starts[1:], "right") - 1])
        order = np.lexsort((run, cut))
        cut, run = cut[order], run[order]
        stop = np.minimum(np.append(cut[1:], len(raw)), (first + n)[run])
        own = np.minimum(np.searchsorted(ends, cut, "right"), len(ends) - 1)
        stop = np.minimum(stop, ends[own] - LENGTH + 1)
        good = stop > cut
        cut, run, stop, own = cut[good], run[good], stop[good], own[good]
        head = np.empty(len(cut), _RECORD)
        ids, ties, offsets = (np.array(x, np.int64) for x in list(zip(*docs, strict=True))[:3])
        head["doc"], head["tie"] = ids[own], ties[own]
        head["at"], head["n"] = cut - starts[own] + offsets[own], stop - cut
        return raw, head, cut, anchor[run], hashed[run]

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        some: list[tuple[int, int, int, int]] = []
        parts: list[bytes] = []
        size = 0
        for i, (doc, tie) in enumerate(zip(batch.column("id").to_pylist(), batch.column("tie").to_pylist(), strict=True)):
            data = texts[i].as_py() or b""
            if len(data) < LENGTH:
                continue
            for a, b in _slices(len(data)):
                parts.append(data[a:b])
                size += b - a
                some.append((doc, tie, a, size))
                if size >= SLICE:
                    yield records(some, b"".join(parts))
                    some, parts, size = [], [], 0
        if some:
            yield records(some, b"".join(parts))


def _bucket(hashed: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashed >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)


@dataclass(frozen=True)
class Hot:
    """What has more records than a task may hold: anchors' hashes, and whole buckets."""

    anchors: np.ndarray
    buckets: np.ndarray

    def holds(self, hashed: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return np.isin(hashed, self.anchors) | np.isin(bucket, self.buckets)


NONE_HOT = Hot(np.empty(0, np.uint64), np.empty(0, np.int64))


def _document_bucket(doc: np.ndarray, tie: np.ndarray, buckets: int) -> np.ndarray:
    return np.mod(doc ^ (doc >> 7) ^ (doc >> 17) ^ tie, buckets)


def _bucket_of(buckets: int) -> Column:
    """The same of columns id and tie."""
    return F.expr(f"pmod(id ^ shiftright(id, 7) ^ shiftright(id, 17) ^ tie, {buckets})")


def _lists(anchor: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Anchors packed by bucket, some buckets at a time."""
    order = np.argsort(bucket, kind="stable")
    anchor, bucket = anchor[order], bucket[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
    parts = list(zip(edges, [*edges[1:], len(bucket)], strict=True))
    for at in range(0, len(parts), 512):
        some = parts[at:at + 512]
        yield bucket[[x for x, _ in some]], [anchor[x:y].tobytes() for x, y in some]


def _anchor_rows(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Kind 1: an anchor (key) with its number of records n in a batch and, where it is one, its document's
    bucket.  Kind 0: anchors known to occur twice, packed by their documents' bucket (key)."""
    names = ["kind", "key", "bucket", "n", "blob"]
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        anchor, bucket = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.argsort(anchor, kind="stable")
        anchor, bucket = anchor[order], bucket[order]
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        n = np.diff(first, append=len(anchor))
        for at in range(0, len(first), 100_000):
            some = slice(at, at + 100_000)
            m = len(first[some])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(m, np.int32)), pa.array(anchor[first[some]]),
                 pa.array(np.where(n[some] > 1, 0, bucket[first[some]])), pa.array(n[some]), pa.nulls(m, pa.binary())], names=names)
        again = np.repeat(n > 1, n)
        if again.any():
            for where, blobs in _lists(anchor[again], bucket[again]):
                m = len(where)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(m, np.int32)), pa.array(where), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
                     pa.array(blobs, pa.binary())], names=names)

    for _, head, _, _, hashed in _found(batches):
        held.append((hashed.view(np.int64), _document_bucket(head["doc"], head["tie"], buckets)))
        size += len(hashed)
        if size >= COMBINED:
            yield from flush()
            size = 0
    if size:
        yield from flush()


def _repeated(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Of rows of ``_anchor_rows`` sorted by (kind, key) what occurs twice or more.  Kind 0: anchors packed by the
    documents' bucket; kind 1: a bucket of anchors with its number of records; kind 2: an anchor with
    more than a quarter of ``MOST`` records.  Whatever an anchor's number of rows, one is held back."""
    names = ["kind", "bucket", "anchor", "n", "blob"]
    totals: list[tuple[np.ndarray, np.ndarray]] = []
    anchor, bucket, n = (np.zeros(0, np.int64) for _ in range(3))  # the row held back
    run, held, size = 0, [], 0  # records of its anchor before it

    def rows(kind: int, where: np.ndarray, **given: pa.Array) -> pa.RecordBatch:
        n = len(where)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(where), given.get("anchor", pa.nulls(n, pa.int64())),
             given.get("n", pa.nulls(n, pa.int64())), given.get("blob", pa.nulls(n, pa.binary()))], names=names)

    def packed() -> Iterator[pa.RecordBatch]:
        for where, blobs in _lists(*(np.concatenate(x) for x in zip(*held, strict=True))):
            yield rows(0, where, blob=pa.array(blobs, pa.binary()))

    def summed() -> pa.RecordBatch:
        where, counts = (np.concatenate(x) for x in zip(*totals, strict=True))
        totals.clear()
        there, of = np.unique(where, return_inverse=True)
        sums = np.zeros(len(there), np.int64)
        np.add.at(sums, of, counts)
        return rows(1, there, n=pa.array(sums))

    def ended(values: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        own = counts > 1
        totals.append((_bucket(values[own].view(np.uint64), buckets), counts[own]))
        if sum(len(x) for x, _ in totals) >= BATCH:
            yield summed()
        if (large := counts > MOST // 4).any():
            yield rows(2, _bucket(values[large].view(np.uint64), buckets), anchor=pa.array(values[large]),
                       n=pa.array(counts[large]))

    for batch in batches:
        lists = int(np.searchsorted(batch.column("kind").to_numpy(), 1))
        if lists:
            yield rows(0, batch.column("key")[:lists].to_numpy(), blob=batch.column("blob")[:lists])
        if lists == len(batch):
            continue
        anchor, bucket, n = (np.concatenate([x, batch.column(c)[lists:].to_numpy()])
                             for x, c in ((anchor, "key"), (bucket, "bucket"), (n, "n")))
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        counts, sizes = np.add.reduceat(n, first), np.diff(first, append=len(anchor))
        counts[0] += run
        again = np.repeat(counts > 1, sizes) & (n == 1)
        again[-1] = False  # not known yet
        if again.any():
            held.append((anchor[again], bucket[again]))
            size += int(again.sum())
        yield from ended(anchor[first[:-1]], counts[:-1])
        run, anchor, bucket, n = int(counts[-1] - n[-1]), anchor[-1:], bucket[-1:], n[-1:]
        if size >= BATCH:
            yield from packed()
            held, size = [], 0
    if len(anchor):
        if run and n[0] == 1:
            held.append((anchor, bucket))
        yield from ended(anchor, n + run)
    if held:
        yield from packed()
    if totals:
        yield summed()


def _hot(repeated: DataFrame) -> Hot:
    """What the tasks of buckets leave out, so that none has more than ``MOST`` records.  Bounded: of
    ``MOST`` records at most one bucket, and of a quarter as many one anchor."""
    large = {r["bucket"]: r["n"] for r in repeated.filter("kind = 1").groupBy("bucket").agg(F.sum("n").alias("n"))
             .filter(F.col("n") > MOST).collect()}
    if not large:
        return NONE_HOT
    found = [r for r in repeated.filter("kind = 2").select("bucket", "anchor", "n").collect() if r["bucket"] in large]
    for r in found:
        large[r["bucket"]] -= r["n"]
    return Hot(np.array(sorted(r["anchor"] for r in found), np.int64).view(np.uint64),
               np.array(sorted(b for b, n in large.items() if n > MOST), np.int64))


def _met(repeated: DataFrame, rows: DataFrame, buckets: int) -> DataFrame:
    """Documents behind the repeated anchors of their bucket."""
    none = {c: F.lit(None).cast(t).alias(c) for c, t in (("blob", "binary"), ("id", "long"), ("tie", "long"), ("text", "string"))}
    lists = repeated.filter("kind = 0").select(
        F.col("bucket").alias("block"), "kind", "blob", none["id"], none["tie"], none["text"])
    own = rows.select(_bucket_of(buckets).alias("block"), F.lit(1).alias("kind"), none["blob"], "id", "tie", "text")
    return lists.unionByName(own).repartition("block").sortWithinPartitions("block", "kind")


def _found_again(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Like ``_found``, of documents that come behind their bucket's repeated anchors: the records with these."""
    lists: list[bytes] = []
    known = np.zeros(0, np.int64)
    for _, first, part in by_block(batches):
        if first:
            lists, known = [], np.zeros(0, np.int64)
        if part.column("kind")[0].as_py() == 0:
            lists.extend(part.column("blob").to_pylist())
            continue
        if lists:
            known, lists = np.unique(np.frombuffer(b"".join(lists), np.int64)), []
        if not len(known):
            continue
        for raw, head, cut, anchor, hashed in _found([part]):
            values = hashed.view(np.int64)
            keep = np.flatnonzero(known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values)
            if len(keep):
                yield raw, head[keep], cut[keep], anchor[keep], hashed[keep]


def _contexts(raw: np.ndarray, cut: np.ndarray) -> np.ndarray:
    return sliding_window_view(np.concatenate([raw, np.zeros(CONTEXT, np.uint8)]), CONTEXT)[cut]


def _records(batches: Iterator[pa.RecordBatch], buckets: int, hot: Hot = NONE_HOT) -> Iterator[pa.RecordBatch]:
    """Packed records of batches of documents, sorted by bucket and suffix, without the hot ones."""
    heads: list[np.ndarray] = []
    rows: list[np.ndarray] = []
    keys: list[np.ndarray] = []  # bucket, and the first bytes of the anchor's suffix as two numbers
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        head, row, key = (_joined(x) for x in (heads, rows, keys))
        order = np.lexsort((key[:, 2], key[:, 1], key[:, 0]))  # like suffixes side by side compress better
        head, row, bucket = head[order], row[order], key[order, 0]
        edges = np.flatnonzero(np.diff(bucket, prepend=np.uint64(buckets + 1)))
        out, size = ([], []), 0
        for a, b in zip(edges, [*edges[1:], len(bucket)], strict=True):
            used = row[a:b][_inside(head["n"][a:b])]
            raw = b"".join([*(np.ascontiguousarray(head[c][a:b]).tobytes() for c in _RECORD.names), used.tobytes()])
            blob = int(b - a).to_bytes(8, "little") + len(raw).to_bytes(8, "little") + pa.compress(
                raw, codec="zstd", asbytes=True)
            out[0].append(int(bucket[a]))
            out[1].append(blob)
            if (size := size + len(blob)) > SLICE:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())],
                                                 names=["bucket", "blob"])
                out, size = ([], []), 0
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary())],
                                             names=["bucket", "blob"])

    for raw, head, cut, anchor, hashed in _found_again(batches):
        bucket = _bucket(hashed, buckets)
        own = np.flatnonzero(~hot.holds(hashed, bucket))
        padded = np.concatenate([raw, np.zeros(CONTEXT, np.uint8)])
        for a in range(0, len(own), BATCH):  # a text of few distinct bytes has an anchor at each
            some = own[a:a + BATCH]
            suffix = sliding_window_view(padded, 16)[anchor[some]].view(">u8").astype(np.uint64)
            heads.append(head[some])
            rows.append(_contexts(raw, cut[some]))
            keys.append(np.column_stack([bucket[some].astype(np.uint64), suffix]))
            held += len(some)
            if held >= BATCH:
                yield from flush()
                held = 0
    if held:
        yield from flush()


def _hot_records(batches: Iterator[pa.RecordBatch], buckets: int, hot: Hot) -> Iterator[pa.RecordBatch]:
    """Hot records: rows of a context with the smallest and the largest id there, and up to ``TOGETHER``
    places (documents, ties and offsets one after the other)."""
    heads: list[np.ndarray] = []
    rows: list[np.ndarray] = []
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        head, row = _joined(heads), _joined(rows)
        key = np.column_stack([head["n"], np.where(_inside(head["n"]), row, 0)]).astype(np.uint8).view(f"V{CONTEXT + 1}")[:, 0]
        order = np.argsort(key, kind="stable")
        head, row, key = head[order], row[order], key[order]
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        parts = [(a, min(a + TOGETHER, end)) for start, end in zip(edges, edges[1:], strict=False)
                 for a in range(start, end, TOGETHER)]
        for at in range(0, len(parts), 1_000):
            some = parts[at:at + 1_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[a, :int(head["n"][a]) + LENGTH - 1].tobytes() for a, _ in some], pa.binary()),
                 pa.array([int(head["doc"][a:b].min()) for a, b in some], pa.int64()),
                 pa.array([int(head["doc"][a:b].max()) for a, b in some], pa.int64()),
                 pa.array([b"".join(np.ascontiguousarray(head[c][a:b]).tobytes() for c in ("doc", "tie", "at"))
                           for a, b in some], pa.binary())], names=["context", "least", "most", "places"])

    for raw, head, cut, _, hashed in _found_again(batches):
        own = np.flatnonzero(hot.holds(hashed, _bucket(hashed, buckets)))
        for a in range(0, len(own), BATCH):
            some = own[a:a + BATCH]
            heads.append(head[some])
            rows.append(_contexts(raw, cut[some]))
            held += len(some)
            if held >= BATCH:
                yield from flush()
                held = 0
    if held:
        yield from flush()


def _hot_covers(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """What is covered of hot records, which come with the smallest id of each repeated window."""
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        for places, firsts in zip(batch.column("places").to_pylist(), batch.column("firsts").to_pylist(), strict=True):
            doc, tie, at = np.frombuffer(places, np.int64).reshape(3, -1)
            mask = np.zeros((len(doc), PLACES), bool)
            for f in firsts:
                mask[:, f["place"]] = f["least"] < doc
            cover = _runs(mask, doc, tie, at)
            if len(cover):
                held.append(cover)
                size += len(cover)
            if size > BATCH:
                yield _packed_covers(held, buckets)
                held, size = [], 0
    if held:
        yield _packed_covers(held, buckets)


def _cover_hot(rows: DataFrame, buckets: int, hot: Hot) -> DataFrame:
    """The covers of hot records.  Each context, then each window, is brought to its smallest id by
    aggregates that combine before the shuffle; the result meets the places again by joins that
    may be broadcast or split, so no task holds a context's places or a window's contexts."""
    places = scratch.materialise(rows.mapInArrow(
        trimmed(lambda b: _hot_records(b, buckets, hot)), "context binary, least long, most long, places binary"), "hot")
    contexts = scratch.materialise(
        places.groupBy("context").agg(F.min("least").alias("least"), F.max("most").alias("most")), "contexts")
    windows = contexts.select("context", "least", "most", F.posexplode(F.expr(
        f"transform(sequence(1, octet_length(context) - {LENGTH - 1}), i -> substring(context, i, {LENGTH}))"
        )).alias("place", "window"))
    first = scratch.materialise(
        windows.groupBy("window").agg(F.min("least").alias("least"), F.max("most").alias("most"))
        .filter("least < most").select("window", "least"), "windows")
    found = scratch.materialise(
        windows.select("context", "place", "window").join(first, "window")
        .groupBy("context").agg(F.collect_list(F.struct("place", "least")).alias("firsts")), "firsts")  # PLACES at most
    return (places.join(found, "context").select("places", "firsts")
            .mapInArrow(trimmed(lambda b: _hot_covers(b, buckets)), "bucket long, n long, blob binary"))


@dataclass
class Level:
    """Sorted windows, each with the smallest id it occurs in and where its bytes are."""

    window: np.ndarray
    doc: np.ndarray
    row: np.ndarray
    place: np.ndarray

    def __len__(self) -> int:
        return len(self.window)

    @classmethod
    def of(cls, window: np.ndarray, doc: np.ndarray, row: np.ndarray, place: np.ndarray) -> Level:
        """Of sorted windows."""
        first = np.flatnonzero(np.diff(window, prepend=~window[:1]))
        return cls(window[first], np.minimum.reduceat(doc, first), row[first], place[first])

    def merged(self, other: Level) -> Level:
        window = np.concatenate([self.window, other.window])
        order = np.argsort(window, kind="stable")  # of two sorted runs: a merge
        return Level.of(window[order], *(np.concatenate(x)[order] for x in (
            (self.doc, other.doc), (self.row, other.row), (self.place, other.place))))


class Levels:
    """A logarithmic family: a level is at least twice as large as the next one."""

    def __init__(self):
        self.levels: list[Level] = []

    def add(self, level: Level) -> None:
        while self.levels and len(self.levels[-1]) < 2 * len(level):
            level = self.levels.pop().merged(level)
        self.levels.append(level)

    def least(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For sorted windows the smallest id over all levels, with its row and place."""
        doc = np.full(len(window), np.iinfo(np.int64).max)
        row, place = np.zeros(len(window), np.int64), np.zeros(len(window), np.int64)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level.window, window), len(level) - 1)
            better = (level.window[at] == window) & (level.doc[at] < doc)
            doc[better], row[better], place[better] = level.doc[at[better]], level.row[at[better]], level.place[at[better]]
        return doc, row, place


def _unpack(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The heads and contexts of packed records."""
    heads, rows = [], []
    for blob in blobs:
        n, size = int.from_bytes(blob[:8], "little"), int.from_bytes(blob[8:16], "little")
        data = pa.decompress(blob[16:], decompressed_size=size, codec="zstd", asbytes=True)
        head, at = np.empty(n, _RECORD), 0
        for c in _RECORD.names:
            head[c] = np.frombuffer(data, _RECORD[c], n, at)
            at += n * _RECORD[c].itemsize
        heads.append(head)
        row = np.zeros((n, CONTEXT), np.uint8)
        row[_inside(head["n"])] = np.frombuffer(data, np.uint8, size - at, at)
        rows.append(row)
    return np.concatenate(heads), np.concatenate(rows)


def _window_hashes(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hash of each window of these records, its record and its place there."""
    total = np.zeros((len(rows), CONTEXT + 1), np.uint64)
    np.cumsum(_BYTES[rows] * powers(_BASE, CONTEXT)[:CONTEXT], axis=1, dtype=np.uint64, out=total[:, 1:])
    all_ = (total[:, LENGTH:] - total[:, :-LENGTH]) * powers(_INVERSE, CONTEXT)[:PLACES]
    there = np.arange(PLACES)[None, :] < n[:, None]
    record, place = np.nonzero(there)
    return mix(all_[there]), record, place


def _covered(head: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which windows (record, place) of a bucket occur in a document with a smaller id."""
    mask = np.zeros((len(rows), PLACES), bool)
    bytes_of = sliding_window_view(rows, LENGTH, axis=1)
    per_pass = -(-int(head["n"].sum(dtype=np.int64)) // HELD)  # a large bucket is read several times
    for now in range(per_pass):
        family, runs = Levels(), []
        step = max(1, RUN // PLACES)
        for a in range(0, len(rows), step):
            window, record, place = _window_hashes(rows[a:a + step], head["n"][a:a + step])
            record = record + a
            if per_pass > 1:
                own = window % np.uint64(per_pass) == now
                window, record, place = window[own], record[own], place[own]
            if not len(window):
                continue
            order = np.argsort(window)
            window, record, place = window[order], record[order], place[order]
            runs.append((window, record, place))
            family.add(Level.of(window, head["doc"][record], record, place))
        for window, record, place in runs:
            doc, row, there = family.least(window)
            hit = np.flatnonzero(doc < head["doc"][record])
            if not len(hit):
                continue
            equal = np.concatenate([
                (bytes_of[record[h], place[h]] == bytes_of[row[h], there[h]]).all(axis=1)
                for h in np.array_split(hit, -(-len(hit) // 100_000))])
            mask[record[hit[equal]], place[hit[equal]]] = True
            for w in set(window[hit[~equal]].tolist()):  # different windows with one hash
                _settle_by_bytes(w, runs, rows, head["doc"], mask)
    return mask


def _settle_by_bytes(window: int, runs: list, rows: np.ndarray, doc: np.ndarray, mask: np.ndarray) -> None:
    """The windows with this hash, told apart by their bytes."""
    own = [(r, p) for hashes, record, place in runs
           for r, p in zip(record[hashes == window], place[hashes == window], strict=True)]
    least: dict[bytes, int] = {}
    for r, p in own:
        key = rows[r, p:p + LENGTH].tobytes()
        least[key] = min(least.get(key, doc[r]), doc[r])
    for r, p in own:
        mask[r, p] = least[rows[r, p:p + LENGTH].tobytes()] < doc[r]


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each key; they come sorted by it."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row[key] != now:
                if held:
                    yield now, held
                now, held = row[key], []
            held.append(row)
    if held:
        yield now, held


def _runs(mask: np.ndarray, doc: np.ndarray, tie: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Runs of covered windows of records."""
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    record, start = np.nonzero(edge == 1)
    _, stop = np.nonzero(edge == -1)
    cover = np.empty(len(record), _COVER)
    cover["doc"], cover["tie"] = doc[record], tie[record]
    cover["at"], cover["n"] = at[record] + start, stop - start
    return cover


def _packed_covers(held: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    cover = np.concatenate(held)
    cover = cover[np.lexsort((cover["at"], cover["tie"], cover["doc"]))]
    # Runs that go on in the next record are one.
    new = np.ones(len(cover), bool)
    new[1:] = ((cover["doc"][1:] != cover["doc"][:-1]) | (cover["tie"][1:] != cover["tie"][:-1])
               | (cover["at"][1:] != (cover["at"] + cover["n"])[:-1]))
    first = np.flatnonzero(new)
    n = np.add.reduceat(cover["n"], first)
    cover = cover[first]
    cover["n"] = n
    bucket = _document_bucket(cover["doc"], cover["tie"], buckets)
    order = np.argsort(bucket, kind="stable")
    cover, bucket = cover[order], bucket[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1))
    blobs = [pa.compress(b"".join([np.ascontiguousarray(cover[c][a:b]).tobytes() for c in _COVER.names]), codec="zstd", asbytes=True)
             for a, b in zip(edges, [*edges[1:], len(bucket)], strict=True)]
    sizes = np.diff(np.append(edges, len(bucket)))
    return pa.RecordBatch.from_arrays([pa.array(bucket[edges]), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())],
                                      names=["bucket", "n", "blob"])


def _covers(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """What is covered, packed by the bucket of its document."""
    held: list[np.ndarray] = []
    for _, group in _grouped(batches, "bucket"):
        head, rows = _unpack([r["blob"] for r in group])
        cover = _runs(_covered(head, rows), head["doc"], head["tie"], head["at"])
        if len(cover):
            held.append(cover)
        if sum(map(len, held)) > BATCH:
            yield _packed_covers(held, buckets)
            held = []
    if held:
        yield _packed_covers(held, buckets)


def _spans(at: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes that windows cover."""
    order = np.argsort(at)
    start, stop = at[order], np.maximum.accumulate((at + n - 1 + LENGTH)[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > stop[:-1]
    first = np.flatnonzero(new)
    return list(zip(start[first].tolist(), stop[np.append(first[1:], len(start)) - 1].tolist(), strict=True))


def _cut_out(batches: Iterator[pa.RecordBatch], columns: list[str], as_text: bool) -> Iterator[pa.RecordBatch]:
    """Each document with the bytes that stay, or as text with the characters that stay whole; its bucket's
    covers come first."""
    bucket, cover, ranges = None, None, {}
    packed: list[tuple[int, bytes]] = []

    def unpack() -> None:
        nonlocal cover, ranges
        parts = []
        for n, blob in packed:
            data = pa.decompress(blob, decompressed_size=n * _COVER.itemsize, codec="zstd", asbytes=True)
            part = np.empty(n, _COVER)
            for i, c in enumerate(_COVER.names):
                part[c] = np.frombuffer(data, _COVER[c], n, 8 * n * i)
            parts.append(part)
        cover = np.concatenate(parts) if parts else np.empty(0, _COVER)
        cover = cover[np.lexsort((cover["tie"], cover["doc"]))]
        new = np.ones(len(cover), bool)
        new[1:] = (cover["doc"][1:] != cover["doc"][:-1]) | (cover["tie"][1:] != cover["tie"][:-1])
        edges = np.append(np.flatnonzero(new), len(cover))
        ranges = {(int(cover["doc"][a]), int(cover["tie"][a])): (a, b) for a, b in zip(edges, edges[1:], strict=False)}

    for batch in batches:
        keep, sizes, spans, kept = [], [], [], []
        buckets, ns, blobs, ids, ties = (batch.column(c).to_pylist() for c in ("__bucket", "__n", "__blob", "__id", "__tie"))
        texts = batch.column("text").cast(pa.binary())
        held = 0
        for i in range(len(batch)):
            if buckets[i] != bucket:
                bucket, cover, packed = buckets[i], None, []
            if blobs[i] is not None:
                packed.append((ns[i], blobs[i]))
                continue
            if cover is None:
                unpack()
            data = texts[i].as_py() or b""
            own = ranges.get((ids[i], ties[i]))
            found = _spans(cover["at"][own[0]:own[1]], cover["n"][own[0]:own[1]]) if own else []
            at, parts = 0, []
            for a, b in found:
                parts.append(data[at:a])
                at = b
            parts.append(data[at:])
            keep.append(i)
            sizes.append(len(data))
            spans.append([{"start": a, "end": b} for a, b in found])
            kept.append(b"".join(parts))
            held += len(kept[-1])
            if held > SLICE:
                yield _documents(batch, keep, columns, sizes, spans, kept, as_text)
                keep, sizes, spans, kept, held = [], [], [], [], 0
        if keep:
            yield _documents(batch, keep, columns, sizes, spans, kept, as_text)


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _documents(batch: pa.RecordBatch, keep: list[int], columns: list[str], sizes: list[int], spans: list, kept: list[bytes],
               as_text: bool) -> pa.RecordBatch:
    own = batch.take(pa.array(keep))
    stay = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
    return pa.RecordBatch.from_arrays(
        [*(own.column(c) for c in columns), pa.array(sizes, pa.int64()), pa.array(spans, _SPAN), stay],
        names=[*columns, "n_bytes", "spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without column text, with n_bytes, spans (start, end of each maximal removed run, in
    bytes) and kept (the bytes that stay)."""
    return _without_repeats(docs, as_text=False)


def _without_repeats(docs: DataFrame, as_text: bool) -> DataFrame:
    # Rows that share an id are told apart by their text.
    shared = not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").isEmpty()
    keyed = docs.withColumns({
        "__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")),
        "__tie": F.xxhash64("text") if shared else F.lit(0).cast("long")})
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, total // BUCKET_BYTES)
    rows = keyed.select(F.col("__id").alias("id"), F.col("__tie").alias("tie"), "text")
    repeated = scratch.materialise(
        rows.mapInArrow(trimmed(lambda b: _anchor_rows(b, buckets)), "kind int, key long, bucket long, n long, blob binary")
        .repartition("kind", "key").sortWithinPartitions("kind", "key")
        .mapInArrow(trimmed(lambda b: _repeated(b, buckets)), "kind int, bucket long, anchor long, n long, blob binary"),
        "repeated-anchors")
    hot = _hot(repeated)
    again = _met(repeated, rows, buckets)
    records = again.mapInArrow(trimmed(lambda b: _records(b, buckets, hot)), "bucket long, blob binary")
    covers = (records.repartition("bucket").sortWithinPartitions("bucket")
              .mapInArrow(trimmed(lambda b: _covers(b, buckets)), "bucket long, n long, blob binary"))
    if len(hot.anchors) or len(hot.buckets):
        covers = covers.unionByName(_cover_hot(again, buckets, hot))
    covers = scratch.materialise(covers, "covers")

    columns = [c for c in docs.columns if c not in ("text", "n_bytes", "spans", "kept")]
    own = keyed.select(F.expr(
        f"pmod(__id ^ shiftright(__id, 7) ^ shiftright(__id, 17) ^ __tie, {buckets})").alias("__bucket"), F.lit(None).cast("long").alias("__n"),
                       F.lit(None).cast("binary").alias("__blob"), "__id", "__tie", "text",
                       *[F.col(f"`{c}`") for c in columns])
    fill = {f.name: f.dataType for f in own.schema}
    given = {"__bucket": F.col("bucket"), "__n": F.col("n"), "__blob": F.col("blob")}
    packed = covers.select(*[given.get(c, F.lit(None)).cast(t).alias(c) for c, t in fill.items()])
    met = (packed.unionByName(own).withColumn("__last", F.col("__blob").isNull())
           .repartition("__bucket").sortWithinPartitions("__bucket", "__last").drop("__last"))
    schema = (StructType([f for f in docs.schema if f.name in columns]).add("n_bytes", "long")
              .add("spans", ArrayType(StructType().add("start", "long").add("end", "long"))).add("kept", "string" if as_text else "binary"))
    return met.mapInArrow(trimmed(lambda b: _cut_out(b, columns, as_text)), schema)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of what ``remove_repeats`` found."""
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@carrying("doc_id", "text", "n_chars")
def kept_text(docs: DataFrame) -> DataFrame:
    """``docs`` with each text's bytes that stay, as text; n_chars, where there is one, counts it anew."""
    out = _without_repeats(docs, as_text=True).drop("spans", "n_bytes").withColumnRenamed("kept", "text")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
