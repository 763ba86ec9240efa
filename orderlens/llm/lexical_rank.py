"""Ranked lexical search over document FP-trees with branch and bound.

1. One scan counts the terms of every whole text.  Of each document it keeps the number of its
   terms and the frequencies of those that items may ask for: a bitmap of fixed size, made of the
   items' terms, lets them pass.
2. An aggregate over these vectors gives each item term's document frequency and weight.
3. Items go in blocks with about ``BLOCK_TERMS`` terms.  For a block, each task reads its documents
   some thousands at a time and orders each vector's terms by falling document frequency.  Vectors
   with a common beginning share a path of a trie.  Each node keeps, of all documents below it, the
   largest frequency of each term and the smallest length norm m; both together bound every score
   below.  An item walks the trie depth first, the best child first, and leaves out what cannot
   reach its k best so far, which stay with it from one trie to the next.
4. A window over the tasks' k best rows gives the ranks.

Memory: a trie holds as many documents as ``CELLS`` cells of (document, term) allow, 64 at least.

Defined results: a null or empty text, or one without terms, has no rank and counts in nothing; texts
of any length are read whole, slice by slice; rows that repeat a doc_id are documents of their own;
equal scores go by ascending doc_id, a null doc_id behind all others; rows that repeat an item_id are
one item with the terms of all; rows without item_id are no item; empty tables give an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scratch
from .memory import trimmed

#: Bits of the bitmap that holds back terms of no item; a term that passes by chance changes no result.
FILTER_BITS = 1 << 22
#: (item, term) rows of a block of items, about.
BLOCK_TERMS = 16_384
#: Cells (document, term) and documents of a trie, at most.
CELLS, TREE_DOCS = 1 << 27, 16_384
#: Documents below which a node is not divided.
LEAF = 64
#: Bytes of a text that are split at a time.
SLICE = 4 << 20

# The contract's constants: length norm m = 100 - 25 + (25 * n * N) div L; saturation 12 * m.
_FLAT, _BY_LENGTH, _SATURATION, _UNIT = 75, 25, 12, 1_000_000_000

#: Letters A-Z become a-z; other bytes below 128, digits and a-z apart, part terms.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a list for each slice; none is cut in two."""
    at = 0
    while len(data) - at > SLICE:
        part = data[at:at + SLICE].translate(_TABLE)
        end = part.rfind(b" ") + 1
        while not end:  # one endless term: up to its end
            more = data[at + len(part):at + len(part) + SLICE].translate(_TABLE)
            end = len(part) + (more.find(b" ") + 1 if b" " in more else len(more))
            part, end = part + more, end if b" " in more or not more else 0
        yield part[:end].split()
        at += end
    yield data[at:].translate(_TABLE).split()


def frequencies(data: bytes | None) -> Counter:
    """How often each term is in a text."""
    found: Counter = Counter()
    for some in terms(data or b""):
        found.update(some)
    return found


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, q (its occurrences)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                found = frequencies(text)
                for a in range(0, len(found), 10_000):
                    some = list(found.items())[a:a + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column("item_id")[i].as_py()] * len(some), pa.int64()),
                         pa.array([t for t, _ in some], pa.binary()).cast(pa.string()),
                         pa.array([q for _, q in some], pa.int64())], names=["item_id", "term", "q"])

    rows = items.filter("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    return (rows.mapInArrow(trimmed(run), "item_id long, term string, q long")
            .groupBy("item_id", "term").agg(F.sum("q").alias("q")))


def _bitmap(found: DataFrame) -> bytes:
    """FILTER_BITS bits, those of the terms set: a table of fixed size, whatever the items."""
    place = F.crc32(F.col("term").cast("binary")) % F.lit(FILTER_BITS) + 1
    rows = (found.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect())
    parts = {r["bucket"]: bytes(r["bits"]) for r in rows}
    size = 4096  # bytes of Spark's bitmaps
    return b"".join(parts.get(i + 1, bytes(size)) for i in range(FILTER_BITS // 8 // size))


def vectors(docs: DataFrame, bits: bytes) -> DataFrame:
    """doc_id, n (terms with repeats), terms and tfs of those that pass, of documents with terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes: dict[bytes, bool] = {}

        def asked(term: bytes) -> bool:
            at = zlib.crc32(term) % FILTER_BITS
            return bool(bits[at >> 3] >> (at & 7) & 1)

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for a in range(0, len(batch), 500):
                part, ids = texts[a:a + 500], batch.column("doc_id")[a:a + 500]
                rows, sizes, names, tfs, counts = [], [], [], [], [0]
                for i in range(len(part)):
                    found = frequencies(part[i].as_py())
                    if not found:
                        continue
                    if len(passes) > 500_000:
                        passes.clear()
                    for t, c in found.items():
                        ok = passes.get(t)
                        if ok is None:
                            ok = passes[t] = asked(t)
                        if ok:
                            names.append(t)
                            tfs.append(c)
                    rows.append(i)
                    sizes.append(found.total())
                    counts.append(len(names))
                offsets = pa.array(counts, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(names, pa.binary()).cast(pa.string())),
                     pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))],
                    names=["doc_id", "n", "terms", "tfs"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(trimmed(run), "doc_id long, n long, terms array<string>, tfs array<long>"))


def _gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return _UNIT * tf // (1000 * tf + _SATURATION * m)


class Tree:
    """An FP-tree of vectors: of document i the terms ``term[ptr[i]:ptr[i + 1]]``, rising from
    the most frequent one (0), with frequencies ``tf`` and the norm ``m[i]``."""

    def __init__(self, term: np.ndarray, tf: np.ndarray, ptr: np.ndarray, m: np.ndarray, n_terms: int):
        path = term.astype(">u4").tobytes()
        paths = [path[4 * a:4 * b] for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist(), strict=True)]
        self.docs = np.array(sorted(range(len(m)), key=paths.__getitem__), np.int64)
        size = np.diff(ptr)[self.docs]
        self.ptr = np.concatenate([[0], np.cumsum(size)])
        entry = np.repeat(ptr[self.docs] - self.ptr[:-1], size) + np.arange(self.ptr[-1])
        self.term, tf, m = term[entry], tf[entry], m[self.docs]
        self.gain = _gain(tf, np.repeat(m, size))
        # Terms that a path shares with the path before it.
        shared = np.zeros(len(m), np.int64)
        for i in range(1, len(m)):
            k = min(size[i - 1], size[i])
            one, two = self.term[self.ptr[i - 1]:self.ptr[i - 1] + k], self.term[self.ptr[i]:self.ptr[i] + k]
            differ = np.flatnonzero(one != two)
            shared[i] = differ[0] if len(differ) else k
        self.low, self.high, self.children = [0], [len(m)], [[]]
        todo = [0]
        while todo:
            node = todo.pop()
            low, high = self.low[node], self.high[node]
            if high - low <= LEAF:
                continue
            inner = shared[low + 1:high]
            if inner.min() == size[low:high].max():  # equal paths: one leaf
                continue
            for a, b in _together(np.concatenate([[low], low + 1 + np.flatnonzero(inner == inner.min()), [high]])):
                self.children[node].append(len(self.low))
                todo.append(len(self.low))
                self.low.append(a)
                self.high.append(b)
                self.children.append([])
        # Largest frequencies and smallest norms, from the leaves up.
        most = np.zeros((len(self.low), n_terms), np.int64 if len(tf) and tf.max() > 1 << 30 else np.int32)
        least = np.full(len(self.low), np.iinfo(np.int64).max)
        leaf = np.zeros(len(m), np.int64)
        for node, below in enumerate(self.children):
            if not below:
                leaf[self.low[node]:self.high[node]] = node
        np.maximum.at(most, (np.repeat(leaf, size), self.term), tf.astype(most.dtype))
        np.minimum.at(least, leaf, m)
        for node in range(len(self.low) - 1, -1, -1):
            if below := self.children[node]:
                most[node], least[node] = most[below].max(axis=0), least[below].min()
        self.bound = np.empty((n_terms, len(self.low)), np.int32)
        for node in range(len(self.low)):
            self.bound[:, node] = _gain(most[node].astype(np.int64), least[node])

    def search(self, asked: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: list, k: int, named) -> None:
        """Bring the documents that belong there into ``best``: up to k keys, the best first.  ``dense``
        holds the weights by term, ``named`` makes the key of a score and a document."""
        bound = (weights @ self.bound[asked].astype(np.int64)).tolist()
        todo = [0]
        while todo:
            node = todo.pop()
            if bound[node] <= 0 or len(best) == k and bound[node] < -best[-1][0]:
                continue
            if below := self.children[node]:
                todo.extend(sorted(below, key=bound.__getitem__))
                continue
            low, high = self.low[node], self.high[node]
            a, b = self.ptr[low], self.ptr[high]
            scores = np.add.reduceat(dense[self.term[a:b]] * self.gain[a:b], self.ptr[low:high] - a)
            hit = np.flatnonzero(scores > 0 if len(best) < k else scores >= max(1, -best[-1][0]))
            for i in hit.tolist():
                key = named(int(scores[i]), self.docs[low + i])
                if len(best) < k or key < best[-1]:
                    insort(best, key)
                    del best[k:]


def _together(edges: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of siblings; small neighbours share one of at most LEAF documents."""
    start = int(edges[0])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if a > start and b - start > LEAF:
            yield start, a
            start = a
    yield start, int(edges[-1])


def _searcher(items: list[int], asked: list[np.ndarray], weights: list[np.ndarray], names: list[str],
              n_docs: int, n_terms: int, k: int):
    """Each task's k best documents of each item."""
    per_tree = max(64, min(TREE_DOCS, CELLS // max(1, len(names))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(names, pa.string())
        best: list[list[tuple]] = [[] for _ in items]
        dense = np.zeros(len(names), np.int64)

        def look(ids: list, m: list, term: list, tf: list, sizes: list) -> None:
            known = [i is not None for i in ids]
            tree = Tree(np.concatenate(term), np.concatenate(tf), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]),
                        np.array(m, np.int64), len(names))

            def named(score: int, at: int) -> tuple:
                return (-score, not known[at], ids[at] if known[at] else 0)

            for of, w, found in zip(asked, weights, best, strict=True):
                dense[of] = w
                tree.search(of, w, dense, found, k, named)
                dense[of] = 0

        ids, m, term, tf, sizes = [], [], [], [], []
        for batch in batches:
            for a in range(0, len(batch), 1_000):
                part = batch.slice(a, 1_000)
                lists = part.column("terms")
                at = pc.index_in(lists.flatten(), value_set=vocabulary)
                there = np.asarray(at.is_valid())
                owner = np.asarray(pc.list_parent_indices(lists))[there]
                of, often = np.asarray(at.fill_null(0))[there], np.asarray(part.column("tfs").flatten())[there]
                order = np.lexsort((of, owner))
                found = np.bincount(owner, minlength=len(part))
                rows = np.flatnonzero(found)
                if not len(rows):
                    continue
                own, n = part.column("doc_id").to_pylist(), part.column("n").to_pylist()
                ids.extend(own[i] for i in rows)
                m.extend(_FLAT + _BY_LENGTH * n[i] * n_docs // n_terms for i in rows)
                term.append(of[order].astype(np.int64))
                tf.append(often[order])
                sizes.append(found[rows])
                if len(ids) >= per_tree:
                    look(ids, m, term, tf, sizes)
                    ids, m, term, tf, sizes = [], [], [], [], []
        if ids:
            look(ids, m, term, tf, sizes)
        rows = [(items[i], None if null else doc, -score) for i, found in enumerate(best) for score, null, doc in found]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                             names=["item_id", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item with a score above 0."""
    spark = docs.sparkSession
    wanted = scratch.materialise(item_terms(items), "item-terms")
    found = scratch.materialise(vectors(docs, _bitmap(wanted)), "term-vectors")
    total = found.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    df = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n_blocks = max(1, -(-wanted.count() // BLOCK_TERMS))
    wanted = scratch.materialise(
        wanted.join(df, "term").withColumn("block", F.expr(f"pmod(xxhash64(item_id), {n_blocks})")), "item-weights")
    parts = []
    for block in range(n_blocks):
        rows = wanted.filter(F.col("block") == block).select("item_id", "term", "q", "df").collect()
        if not rows:
            continue
        order = sorted({(-r["df"], r["term"]) for r in rows})
        place = {term: i for i, (_, term) in enumerate(order)}
        by_item: dict[int, list] = {}
        for r in rows:
            by_item.setdefault(r["item_id"], []).append((place[r["term"]], r["q"] * weight(total["docs"], r["df"])))
        ids = sorted(by_item)
        pairs = [np.array(by_item[i], np.int64) for i in ids]
        run = _searcher(ids, [p[:, 0] for p in pairs], [p[:, 1] for p in pairs], [t for _, t in order],
                        total["docs"], total["terms"], k)
        parts.append(scratch.materialise(found.mapInArrow(trimmed(run), "item_id long, doc_id long, score long"), "best"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
