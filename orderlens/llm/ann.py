"""Approximate nearest neighbours by a permutation index.

Pivots are taken, far apart, from a bounded, hash-ordered sample.  A vector is
represented by its nearest pivots in order, and posted under each of them with the
pivot's place in that order.  Vectors are dealt over tasks; each task keeps the
inverted files of its own vectors.  A query adds up, list by list, the footrule
distance between its order and theirs, and vectors no farther than the
query's threshold are reranked by exact Euclidean distance.  The threshold is the
quantile ``share(n)`` of the query's footrule distances to the sample, so the
result does not depend on how vectors are dealt, and nothing is capped.

Equal vectors are one entry of the index, which holds the smallest of their ids, as
many as a result can need; a vector that a third of the rows share is one posting.

Queries are answered in blocks of ``BLOCK`` vectors, which is what is broadcast.

Defined results: vectors that are null, all zero, or hold a null or non-finite
component take no part, nor do those without an id or of another length than most; with fewer
candidates than asked for all are returned; ties go to the smaller id; rows that repeat an
id and its vector count once; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scratch

#: Pivots, and how many of them make a vector's order.
PIVOTS, ORDER = 256, 128
#: Vectors that pivots and thresholds are taken from.
SAMPLE = 1_024
#: The share of all vectors that is reranked: this, and more where the table is small.
SHARE, LEAST = 0.15, 200
#: Query vectors in a block, about; vectors of an inverted file.
BLOCK, SHARD = 4_096, 8_192


def share(n: int) -> float:
    return min(1.0, SHARE + LEAST / max(n, 1))


def orders(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first; ties to the smaller number."""
    square = (pivots ** 2).sum(axis=1) - 2 * (vectors @ pivots.T)
    return np.argsort(np.round(square, 9), axis=1, kind="stable")[:, :length].astype(np.int32)


def spread(sample: np.ndarray, n: int) -> np.ndarray:
    """n vectors of the sample that lie far apart: each next one is the farthest from those
    before it, so a crowd of similar vectors gives few pivots."""
    chosen = [0]
    gap = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(np.argmax(np.round(gap, 9))))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


class InvertedFiles:
    """The postings of some vectors: for each pivot which of them have it in their order, and where."""

    def __init__(self, order: np.ndarray, pivots: int):
        self.n, self.length = order.shape
        flat = order.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.rows = (by_pivot // self.length).astype(np.int32)
        self.places = (by_pivot % self.length).astype(np.int32)
        self.starts = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """The footrule distance of each vector to a query's order; a pivot that one of
        them lacks counts as if it came after all others."""
        length = self.length
        out = np.full(self.n, length * (length + 1), np.int32)
        for place, pivot in enumerate(order):
            a, b = self.starts[pivot], self.starts[pivot + 1]
            places = self.places[a:b]
            out[self.rows[a:b]] += np.abs(places - place) + places - (2 * length - place)
        return out


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.filter(
        F.col("id").isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0)).withColumn("vector", F.transform(v, lambda x: x + F.lit(0.0)))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def search(vectors: DataFrame, id_col: str, vector_col: str, is_query: str, k: int = 10) -> DataFrame:
    """For each row of ``vectors`` that the condition ``is_query`` (on ``id``) holds for its k
    nearest others: query_id, rank (from 1), vec_id, score (the Euclidean distance)."""
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, vector_col)
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("vector") == sizes[0]["d"]).distinct()

    # Of equal vectors the smallest ids, as many as a result can need; the limit applies before the shuffle.
    nth = Window.partitionBy("vector").orderBy("id")
    few = rows.withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") <= k + 1)
    entries = scratch.materialise(
        few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .withColumn("first", F.element_at("ids", 1)), "ann-entries")
    asked = rows.filter(F.expr(is_query))
    questions = scratch.materialise(asked.select("vector").distinct()
                                    .join(entries, "vector").select("first", "vector"), "ann-queries")
    n, n_questions = entries.count(), questions.count()
    # Bounded: SAMPLE vectors.
    sample = _matrix(pa.array([r["vector"] for r in entries.select("first", "vector").orderBy(
        F.xxhash64("first"), "first").limit(SAMPLE).collect()], pa.list_(pa.float64())))
    pivots = spread(sample, PIVOTS)
    length = max(1, min(ORDER, len(pivots) * ORDER // PIVOTS))
    sampled, quantile = InvertedFiles(orders(sample, pivots, length), len(pivots)), share(n)
    blocks = -(-n_questions // BLOCK)
    found = None
    for block in range(blocks):
        own = questions.filter(F.expr(f"pmod(xxhash64(first), {blocks}) = {block}")).orderBy("first").collect()
        ids = np.array([r["first"] for r in own], np.int64)
        asked_vectors = np.array([r["vector"] for r in own], np.float64)
        asked_orders = orders(asked_vectors, pivots, length) if len(own) else np.zeros((0, length), np.int32)
        limits = np.array([np.quantile(sampled.footrule(o), quantile, method="higher") for o in asked_orders])
        shared = spark.sparkContext.broadcast((ids, asked_vectors, asked_orders, limits, pivots, length))
        part = entries.select("first", "vector", "ids").mapInArrow(
            _searcher(shared, k), "query long, score double, first long, ids array<long>")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], schema)
    best = Window.partitionBy("query").orderBy("score", "first")
    top = (found.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k + 1)
           .select("query", "score", F.explode("ids").alias("vec_id")))
    nearest = Window.partitionBy("query").orderBy("score", "vec_id")
    listed = (top.withColumn("nth", F.row_number().over(nearest)).filter(F.col("nth") <= k + 1)
              .groupBy("query").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("near")))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (asked.withColumnRenamed("id", "query_id").join(questions, "vector")
            .join(listed, F.col("first") == F.col("query"))
            .select("query_id", F.posexplode(others).alias("place", "hit"))
            .select("query_id", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                    F.col("hit.score").alias("score")))


def _searcher(shared, k: int):
    """Answers all queries of a block over the vectors of one task, shard by shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, asked, asked_orders, limits, pivots, length = shared.value

        def answer(shard: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(shard).combine_chunks()
            first = table.column("first").to_numpy()
            matrix = np.concatenate([_matrix(c) for c in table.column("vector").chunks])
            files = InvertedFiles(orders(matrix, pivots, length), len(pivots))
            queries, rows, scores = [], [], []
            for i in range(len(ids)):
                near = np.flatnonzero(files.footrule(asked_orders[i]) <= limits[i])
                distance = np.sqrt(((matrix[near] - asked[i]) ** 2).sum(axis=1))
                best = np.lexsort((first[near], distance))[:k + 1]
                queries.append(np.full(len(best), ids[i]))
                rows.append(near[best])
                scores.append(distance[best])
            at = np.concatenate(rows)
            lists = table.column("ids").take(pa.array(at)).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(queries), pa.int64()), pa.array(np.concatenate(scores)), pa.array(first[at]),
                 lists if isinstance(lists, pa.Array) else lists.chunk(0)], names=["query", "score", "first", "ids"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            for a in range(0, len(batch), SHARD):
                held.append(batch.slice(a, SHARD))
                if sum(map(len, held)) >= SHARD and len(ids):
                    yield answer(held)
                    held = []
        if held and len(ids):
            yield answer(held)

    return run
