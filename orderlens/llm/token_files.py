"""Token ids as Parquet list columns.

``write_tokens`` encodes every whole text, appends the end id, and writes
documents in ascending id order: files are range-partitioned by doc_id and
sorted inside.  The id column is dictionary-encoded (format version 2, so
pages beyond a dictionary's size and the counters fall to delta encodings),
row groups and pages have a fixed size, and column and offset indexes let a
reader skip what it does not ask for: ``read_documents`` with ids or a token
range reads only the pages that hold them, ``read_metadata`` no token at all.

Defined results: a null text is empty and still has its end id; null ids come
first; rows that repeat an id stay, in an order fixed by their text; an empty
table gives an empty file set; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import scratch
from .encode import END_ID, encoder, in_turn
from .memory import trimmed

#: Bytes of a row group and of a page.
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10

_SCHEMA = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("row", pa.int64()),
                     ("part_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
_DDL = "doc_id long, part int, row long, part_start long, n_tokens long, ids array<int>"


def id_lists(packed: list[bytes]) -> pa.Array:
    """A list column of the ids, without a copy for each."""
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(x) // 4 for x in packed], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), "<i4")))


def packed_lists(column: pa.ListArray) -> Iterator[memoryview]:
    """The bytes of each list of such a column; null is empty."""
    values = memoryview(np.ascontiguousarray(column.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
    offsets = column.offsets.to_pylist()
    for a, b in zip(offsets, offsets[1:], strict=False):
        yield values[4 * a:4 * b]


def write_tokens(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write the ids of every whole text to ``path``."""
    end = np.array([END_ID], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, part, row, start = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            ids, texts = batch.column("doc_id"), [t or "" for t in batch.column("text").to_pylist()]
            for a, b in in_turn(texts):
                packed = [x + end for x in encode_texts(texts[a:b])]
                sizes = np.array([len(x) // 4 for x in packed], np.int64)
                before = start + np.cumsum(sizes) - sizes
                yield pa.RecordBatch.from_arrays(
                    [ids[a:b], pa.array(np.full(b - a, part, np.int32)), pa.array(np.arange(row, row + b - a)),
                     pa.array(before), pa.array(sizes), id_lists(packed)], schema=_SCHEMA)
                row, start = row + b - a, start + int(sizes.sum())

    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        F.xxhash64("text").alias("tie"))
            .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"))
    scratch.write(rows.mapInArrow(trimmed(encode, encodes=True), _DDL), path, parquet__writer__version="v2",
                  parquet__enable__dictionary="true", parquet__block__size=ROW_GROUP_BYTES,
                  parquet__page__size=PAGE_BYTES)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, row, start, n_tokens of each document; no page of ids is read."""
    meta = spark.read.schema(_DDL).parquet(path).drop("ids")
    return _with_start(meta, meta)


def read_documents(spark: SparkSession, path: str, doc_ids: list[int] | None = None,
                   token_range: tuple[int, int] | None = None) -> DataFrame:
    """Documents with their ids: all, some by id, or those that touch a range of the token stream."""
    rows = spark.read.schema(_DDL).parquet(path)
    meta = rows.drop("ids")
    if doc_ids is not None:
        rows = rows.filter(F.col("doc_id").isin(doc_ids))
    if token_range is None:
        return _with_start(rows, meta)
    first, last = token_range
    edges = _edges(meta, first, last)
    if edges is None:
        return _with_start(rows, meta).limit(0)
    (low, low_start), (high, high_start) = edges
    # Stored columns only, so the scan gets these filters and reads the pages that hold the range.
    some = rows.filter((F.col("part") >= low) & (F.col("part") <= high)
                       & ((F.col("part") > low) | (F.col("part_start") >= low_start))
                       & ((F.col("part") < high) | (F.col("part_start") < high_start)))
    return _with_start(some, meta).filter((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first))


def _edges(meta: DataFrame, first: int, last: int) -> tuple[tuple[int, int], tuple[int, int]] | None:
    """Where a range of the token stream begins and ends: (part, the first stored start there that it can
    touch) and (part, the stored start there that is behind it).  Two rows, whatever the files' number."""
    starts = _with_start(meta.withColumn("stored", F.col("part_start")), meta)
    place = F.struct("part", "stored")
    found = (starts.filter((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first))
             .agg(F.min(place).alias("a"), F.max(place).alias("b")).first())
    if found["a"] is None:
        return None
    return tuple(found["a"]), (found["b"]["part"], found["b"]["stored"] + 1)


def _with_start(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """start: ids of all documents before it.  One row per file part is prefix-summed,
    so what is broadcast is bounded by the number of parts."""
    parts = meta.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (rows.join(F.broadcast(bases), "part")
            .withColumn("start", F.col("base") + F.col("part_start")).drop("base", "part_start"))


def checksums(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of documents that were read."""
    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [zlib.crc32(x) for x in packed_lists(batch.column("ids"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (rows.select("doc_id", "start", "n_tokens", "ids")
            .mapInArrow(crc, "doc_id long, start long, n_tokens long, ids_crc32 long"))
