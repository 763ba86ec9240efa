"""Near-duplicates by HyperMinHash sketches, banded, estimated, then verified.

Each distinct word shingle of a whole text falls into one of ``BANDS * ROWS`` buckets;
a bucket keeps of its smallest hash the count of leading zeros and ten mantissa
bits, in 16 bits.  Texts with equal sets are one node.  For banding, empty registers borrow
from others.  Nodes that agree on all registers of a band share a key.  A pair at the threshold of 0.8 misses all keys with a
probability of (1 - 0.8 ** ROWS) ** BANDS, about 2 in a million.

Links are found without listing the pairs of a key:

1. every node is verified against one centre, the most connected node of the
   keys it shares most; the verified links give first components;
2. keys whose nodes are still apart are gathered by the component of their
   centre; there, registers of nodes of different components are compared, and
   each pair whose estimate, corrected for chance collisions, could be a
   link (within ``SIGMAS`` standard errors) is verified.

So each pair with a common key ends in one component, or was compared.  Verification
intersects the full shingle sets.  Large gatherings are cut into chunks that meet two by two.

Defined results: a null or empty text, or one without words, has no shingle and no
link; fewer words than a shingle has are one shingle; a row without an id
has no component and is kept; rows that repeat an id are nodes of their own where their
sets differ, and may have different components; an empty table gives an empty result; other
columns are ignored.  Nodes are named by a row that has their set, components by their smallest doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch
from .columns import carrying
from .components import components, roots
from .memory import trimmed
from .words import in_blocks, mix, powers, shingles

BANDS, ROWS = 56, 7
REGISTERS = BANDS * ROWS
#: The chance that two different smallest hashes leave the same register.
COLLISION = 1 / 3 / 1024
SIGMAS = 4.5
#: Buckets that an empty register tries.
_TURNS = 40
#: Nodes of a gathering that one task compares with as many others.
CHUNK = 4_096


def registers(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The sketch of each of n sets: per bucket 1 + leading zeros * 1024 + mantissa; 0 if empty."""
    least = np.full(n * REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    slot = owner * REGISTERS + ((hashes >> np.uint64(20)) % np.uint64(REGISTERS)).astype(np.int64)
    value = mix(hashes ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(1)
    np.minimum.at(least, slot, value)
    there = least != np.iinfo(np.uint64).max
    mantissa, exponent = np.frexp(least.astype(np.float64))
    found = 1 + (np.clip(63 - exponent, 0, 62) << 10) + ((mantissa * 2 - 1) * 1024).astype(np.int64).clip(0, 1023)
    return np.where(there, found, 0).astype(np.uint16).reshape(n, REGISTERS)


def filled(sketches: np.ndarray) -> np.ndarray:
    """Sketches whose empty registers borrow from a bucket that the register's own sequence of
    buckets reaches first, so that a small set fills all bands and one shared shingle makes no band equal."""
    out, buckets = sketches.copy(), np.arange(REGISTERS)
    for turn in range(_TURNS):
        if (out > 0).all():
            return out
        source = (mix(np.arange(REGISTERS, dtype=np.uint64) + np.uint64(turn * REGISTERS + 1))
                  % np.uint64(REGISTERS)).astype(np.int64)
        out = np.where(out > 0, out, sketches[:, source])
    # Sparse ones: the next bucket that has a register.
    place = np.where(sketches > 0, buckets, 4 * REGISTERS)
    after = np.minimum.accumulate(np.concatenate([place, place + REGISTERS], axis=1)[:, ::-1], axis=1)[:, ::-1]
    nearest = after[:, :REGISTERS] % REGISTERS
    return np.where(out > 0, out, np.take_along_axis(sketches, nearest, axis=1))


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """The keys of the bands of sets that are not empty."""
    bands = filled(sketches).reshape(len(sketches), BANDS, ROWS).astype(np.uint64)
    sums = (bands * powers(0xD6E8FEB86659FD93, ROWS + 1)[1:ROWS + 1]).sum(axis=2, dtype=np.uint64)
    return mix(sums + mix(np.arange(1, BANDS + 1, dtype=np.uint64)))


def estimate(one: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The similarity of a sketch to each of others, without what chance collisions add; and the
    registers that it rests on."""
    there, some = one > 0, many > 0
    equal, both, all_some = (x.sum(axis=1, dtype=np.uint16).astype(np.int64)
                             for x in ((many == one) & there, some & there, some))
    either = all_some + there.sum() - both
    by_chance = COLLISION * (both - equal)
    return np.clip((equal - by_chance) / np.maximum(either - by_chance, 1), 0, 1), either


def plausible(one: np.ndarray, size: int, many: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether each pair could be a link: the estimate's standard error shrinks as the registers
    hold more of the union."""
    t = percent / 100
    found, either = estimate(one, many)
    union = (size + sizes) / (1 + t)
    error = np.sqrt(t * (1 - t) / np.maximum(either, 1) * np.clip(1 - either / np.maximum(union, 1), 0.02, 1))
    return (found >= t - SIGMAS * error) & (np.minimum(size, sizes) >= t * np.maximum(size, sizes) - 1e-9)


_SKETCH = "uid long, doc_id long, tie long, n long, sig_a long, sig_b long, regs binary"


def fingerprints(hashes: np.ndarray, owner: np.ndarray, n: int) -> list[np.ndarray]:
    """Of each of n sets, which come sorted by owner, the size and a 128-bit fingerprint."""
    starts, ends = (np.searchsorted(owner, np.arange(n), side) for side in ("left", "right"))
    out = [(ends - starts).astype(np.int64)]
    for h in (hashes, mix(hashes ^ np.uint64(0x2545F4914F6CDD1D))):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h, dtype=np.uint64)])
        out.append((total[ends] - total[starts]).view(np.int64))
    return out


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """uid (of the row), doc_id, tie (a hash of the text), n (distinct shingles), a 128-bit fingerprint
    of the set, and its sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for a, b in in_blocks(texts):
                hashes, owner = shingles(texts[a:b], words)
                regs = registers(hashes, owner, b - a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + b - a)), batch.column("doc_id")[a:b], batch.column("tie")[a:b],
                     *(pa.array(x) for x in fingerprints(hashes, owner, b - a)),
                     pa.array([r.tobytes() for r in regs], pa.binary())],
                    names=["uid", "doc_id", "tie", "n", "sig_a", "sig_b", "regs"])
                row += b - a

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text")
            .mapInArrow(trimmed(run), _SKETCH))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, len(batch), 2000):
            part = batch.slice(a, 2000)
            regs = np.frombuffer(b"".join(part.column("regs").to_pylist()), np.uint16).reshape(len(part), REGISTERS)
            keys = band_keys(regs)
            ids = np.repeat(part.column("id").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(ids)],
                                             names=["key", "id"])


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """id and set (the hashes of the distinct shingles) of texts with the fingerprint n, sig_a, sig_b."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            want = [batch.column(c).to_numpy() for c in ("n", "sig_a", "sig_b")]
            for a, b in in_blocks(texts):
                hashes, owner = shingles(texts[a:b], words)
                found = fingerprints(hashes, owner, b - a)
                same = np.logical_and.reduce([x == w[a:b] for x, w in zip(found, want, strict=True)])
                offsets = np.concatenate([[0], np.cumsum(found[0])]).astype(np.int32)
                rows = pa.RecordBatch.from_arrays(
                    [batch.column("id")[a:b], pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.view(np.int64)))],
                    names=["id", "set"])
                yield rows if same.all() else rows.filter(pa.array(same))

    return docs.select("id", "n", "sig_a", "sig_b", "text").mapInArrow(trimmed(run), "id long, set array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b; other columns stay) whose full sets have the similarity."""
    left, right = (sets.select(F.col("id").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab")
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return (both.withColumn("common", common)
            .filter(F.col("common") * 100 >= percent * (F.size("set_a") + F.size("set_b") - F.col("common")))
            .select(*pairs.columns).distinct())


def _apart(percent: int):
    """Pairs of different components that could be links, with these components, of gatherings that come
    sorted by (component, first chunk, second chunk)."""
    def compare(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        first, second, chunk, ids, comps, sizes, regs = zip(*rows, strict=True)
        matrix = np.frombuffer(b"".join(regs), np.uint16).reshape(len(rows), REGISTERS)
        ids, comps, sizes, chunk = (np.array(x, np.int64) for x in (ids, comps, sizes, chunk))
        same = first[0] == second[0]
        out = []
        for i in range(len(rows)):
            if not same and chunk[i] != first[0]:
                continue
            others = np.flatnonzero((comps != comps[i]) & ((np.arange(len(rows)) > i) if same else (chunk == second[0])))
            others = others[np.minimum(sizes[others], sizes[i]) * 100 >= percent * np.maximum(sizes[others], sizes[i])]
            for at in range(0, len(others), 4096):
                some = others[at:at + 4096]
                hit = some[plausible(matrix[i], int(sizes[i]), matrix[some], sizes[some], percent)]
                above = ids[hit] > ids[i]
                out.append([np.where(above, ids[hit], ids[i]), np.where(above, ids[i], ids[hit]),
                            np.where(above, comps[hit], comps[i]), np.where(above, comps[i], comps[hit])])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)],
                                             names=["a", "b", "comp_a", "comp_b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # two chunks at most
        now = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("first", "second", "chunk", "id", "comp", "n", "regs")]
            for group, row in zip(batch.column("gathering").to_pylist(), zip(*columns, strict=True), strict=True):
                if (here := (group, row[0], row[1])) != now:
                    if len(held) > 1:
                        yield from compare(held)
                    held, now = [], here
                held.append(row)
        if len(held) > 1:
            yield from compare(held)

    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return _judged(docs, words, percent).drop("tie", "component")


def _judged(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """One row per document: doc_id, tie, component (null without words), n_shingles, component_id, kept."""
    marks = scratch.materialise(sketches(docs, words), "sketches")
    # Equal sets are one node, named by one of its rows.
    classes = (marks.filter("n > 0 AND doc_id IS NOT NULL").groupBy("n", "sig_a", "sig_b")
               .agg(F.min("uid").alias("id"), F.min("doc_id").alias("least")))
    classes = scratch.materialise(classes, "classes")
    nodes = scratch.materialise(
        marks.select(F.col("uid").alias("id"), "n", "regs").join(classes.select("id"), "id", "left_semi"), "nodes")

    keys = nodes.select("id", "regs").mapInArrow(trimmed(_keys), "key long, id long")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = scratch.materialise(keys.join(shared, "key"), "members")

    weight = members.groupBy("id").agg(F.sum("n").alias("weight"))
    weight = scratch.materialise(weight, "weights")
    centres = members.join(weight, "id").groupBy("key").agg(F.max(F.struct("weight", (-F.col("id")).alias("neg"))).alias("c"))
    centres = scratch.materialise(centres.select("key", (-F.col("c.neg")).alias("centre")), "centres")
    # Each node has one centre, of more weight or, at the same weight, a smaller id: no path returns.
    stars = (members.select("key", "id").join(centres, "key").filter("id <> centre").repartition("id").groupBy("id", "centre")
             .agg(F.count(F.lit(1)).alias("n")).groupBy("id")
             .agg(F.max(F.struct("n", (-F.col("centre")).alias("neg"))).alias("c"))
             .select(F.col("id").alias("a"), (-F.col("c.neg")).alias("b")))
    stars = scratch.materialise(stars, "stars")

    linked = weight.select("id")
    # A node's text is that of its smallest doc_id, or one of them: the one with its fingerprint.
    texts = docs.select(F.col("doc_id").cast("long").alias("least"), "text").join(classes.join(linked, "id", "left_semi"), "least")
    sets = scratch.materialise(shingle_sets(texts, words), "sets")

    first = roots(verified(stars, sets, percent))
    labels = scratch.materialise(
        linked.join(first, "id", "left").select("id", F.coalesce("component", "id").alias("comp")), "labels")

    of_centre = labels.select(F.col("id").alias("centre"), F.col("comp").alias("gathering"))
    apart = (members.select("key", "id").join(labels, "id").groupBy("key")
             .agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("key")
             .join(centres, "key").join(of_centre, "centre").select("key", "gathering"))
    gathered = scratch.materialise(
        members.select("key", "id").join(apart, "key").select("gathering", "id").distinct(), "gathered")
    chunks = gathered.groupBy("gathering").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    placed = (gathered.join(chunks, "gathering").withColumn("chunk", F.expr("cast(pmod(xxhash64(id), chunks) as int)"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .select("gathering", "id", "chunk", F.least("chunk", "other").alias("first"),
                      F.greatest("chunk", "other").alias("second")))
    full = placed.join(nodes.join(labels, "id"), "id")
    ordered = full.repartition("gathering", "first", "second").sortWithinPartitions("gathering", "first", "second", "id")
    pairs = scratch.materialise(ordered.mapInArrow(trimmed(_apart(percent)), "a long, b long, comp_a long, comp_b long")
                                .distinct(), "pairs")
    more = components(verified(pairs, sets, percent).select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))

    final = (labels.withColumnRenamed("comp", "first").join(more.withColumnRenamed("id", "first"), "first", "left")
             .select("id", F.coalesce("component", "first").alias("component")))
    least = final.join(classes.select("id", "least"), "id").groupBy("component").agg(F.min("least").alias("component_id"))
    names = final.join(least, "component").select("id", "component", "component_id")
    named = (marks.select("doc_id", "tie", "n", "sig_a", "sig_b")
             .join(classes.join(names, "id", "left"), ["n", "sig_a", "sig_b"], "left"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(
        F.coalesce("component_id", "least", "doc_id"))
    return named.select("doc_id", "tie", F.coalesce("component", "id").alias("component"), F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


@carrying("doc_id", "text")
def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, all columns kept.  Where different texts of a component
    share its smallest doc_id, the one whose hash is smallest stays; equal rows stay or go together."""
    judged = scratch.materialise(_judged(docs, words, percent).filter("doc_id IS NOT NULL"), "judged")
    alone = F.when(F.col("n_shingles") == 0, F.col("tie"))  # a text without words is a group of its own
    stay = (judged.filter("kept").groupBy("doc_id", "component", alone.alias("alone")).agg(F.min("tie").alias("tie"))
            .select("doc_id", "tie"))
    gone = judged.select("doc_id", "tie").join(stay, ["doc_id", "tie"], "left_anti").distinct()
    return (docs.withColumn("tie", F.xxhash64("text")).join(gone, ["doc_id", "tie"], "left_anti").select(*docs.columns))
