"""Exact deduplication by composable polynomial fingerprints.

A text's UTF-8 bytes, read as one big number, are taken modulo two fixed
62-bit primes (a polynomial in base 256).  The fingerprint of a
concatenation follows from those of its parts::

    f(x + y) = f(x) * 256 ** len(y) + f(y)    (mod p)

so a text longer than ``CHUNK`` is cut, its chunks are hashed in parallel by
any task, and their length-shifted hashes are summed.  Texts with the same
fingerprint and length are then compared chunk by chunk as streams: if
all copies of a chunk are equal, the smallest is also the largest, and both
are kept by partial aggregation, so no group is ever gathered.  A
fingerprint whose texts differ (a collision) is split by the texts' SHA-256.

Apart from the chunks of long texts, which other tasks hash, only texts that may have
a copy are moved: a bitmap of fixed size, made of the texts whose fingerprint others
share, is looked up in the scan.

Defined results: a null text counts as empty; empty texts are equal to each
other; null ids sort before all others; of rows that repeat an id and its
text one stays; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scratch
from .columns import carrying
from .memory import trimmed
from .skew import hot_keys

#: Bytes of a chunk.
CHUNK = 1 << 16
#: Bits of the bitmap that lets texts pass which share no fingerprint; one that is held by chance changes
#: no result.
SHARED_BITS = 1 << 26
#: The moduli: fixed primes below 2 ** 62.
PRIMES = (3649569658711240703, 3425262418145465951)


def shifted(hashed: int, rest: int, prime: int) -> int:
    """The share of a chunk that ``rest`` bytes follow in its text's fingerprint."""
    return hashed * pow(256, rest, prime) % prime


def fingerprint(data: bytes) -> tuple[int, int]:
    """Both fingerprints of a whole text in one step; what the chunks add up to."""
    number = int.from_bytes(data, "big")
    return number % PRIMES[0], number % PRIMES[1]


_PARTS = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                    ("text_sha256", pa.string()), ("seq", pa.int32()), ("rest", pa.int64()),
                    ("part_a", pa.int64()), ("part_b", pa.int64()), ("data", pa.binary())])
_PARTS_DDL = ("uid long, doc_id long, n_bytes long, text_sha256 string, seq int, rest long, "
              "part_a long, part_b long, data binary")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int | None, bytes]]:
    texts = batch.column("text").cast(pa.binary())
    for i, (uid, doc_id) in enumerate(zip(batch.column("uid").to_pylist(),
                                          batch.column("doc_id").to_pylist(), strict=True)):
        yield uid, doc_id, texts[i].as_py() or b""


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Short texts hashed at once; of long ones the chunks, to be hashed elsewhere."""
    for batch in batches:
        rows, held = [], 0
        for uid, doc_id, data in _rows(batch):
            size, sha = len(data), hashlib.sha256(data).hexdigest()
            if size <= CHUNK:
                rows.append((uid, doc_id, size, sha, 0, 0, *fingerprint(data), None))
                continue
            for seq, at in enumerate(range(0, size, CHUNK)):
                piece = data[at:at + CHUNK]
                rows.append((uid, doc_id, size, sha, seq, size - at - len(piece), None, None, piece))
                held += len(piece)
                if held > 8 * CHUNK:
                    yield _batch(rows, _PARTS)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, _PARTS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _hash_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shifted hash of each chunk."""
    narrow = pa.schema([f for f in _PARTS if f.name not in ("seq", "rest", "data")])
    for batch in batches:
        rest, data = batch.column("rest").to_pylist(), batch.column("data")
        a, b = batch.column("part_a").to_pylist(), batch.column("part_b").to_pylist()
        for i in range(len(batch)):
            if a[i] is None:
                hashed = fingerprint(data[i].as_py())
                a[i], b[i] = (shifted(h, rest[i], p) for h, p in zip(hashed, PRIMES, strict=True))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in ("uid", "doc_id", "n_bytes", "text_sha256")),
             pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=narrow)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: uid, doc_id, n_bytes, text_sha256, fp_a, fp_b."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"),
                       F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = rows.mapInArrow(trimmed(_cut), _PARTS_DDL)
    # Only chunks of long texts carry bytes through this shuffle.
    dealt = parts.repartition(F.col("uid"), F.col("seq"))
    hashed = dealt.mapInArrow(
        _hash_parts, "uid long, doc_id long, n_bytes long, text_sha256 string, part_a long, part_b long")
    total = [(F.sum(F.col(f"part_{k}").cast("decimal(38,0)")) % F.lit(p).cast("decimal(38,0)"))
             .cast("long").alias(f"fp_{k}") for k, p in zip("ab", PRIMES, strict=True)]
    return hashed.groupBy("uid").agg(F.first("doc_id").alias("doc_id"),
                                     F.first("n_bytes").alias("n_bytes"),
                                     F.first("text_sha256").alias("text_sha256"), *total)


_KEYED = pa.schema([("fp_a", pa.int64()), ("fp_b", pa.int64()), ("n_bytes", pa.int64()),
                    ("spread", pa.int32()), ("seq", pa.int32()), ("data", pa.binary())])
_KEYED_DDL = "fp_a long, fp_b long, n_bytes long, spread int, seq int, data binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's chunks under its fingerprint, which is composed from theirs."""
    for batch in batches:
        rows, held = [], 0
        for uid, _, data in _rows(batch):
            size, a, b = len(data), 0, 0
            for at in range(0, size, CHUNK):
                part = fingerprint(data[at:at + CHUNK])
                rest = size - min(size, at + CHUNK)
                a, b = ((f + shifted(h, rest, p)) % p
                        for f, h, p in zip((a, b), part, PRIMES, strict=True))
            for seq, at in enumerate(range(0, size, CHUNK)):
                rows.append((a, b, size, uid % 1_000_003, seq, data[at:at + CHUNK]))
                held += CHUNK if size > CHUNK else size
            if held > 64 * CHUNK:
                yield _batch(rows, _KEYED)
                rows, held = [], 0
        if rows:
            yield _batch(rows, _KEYED)


_KEY = ["fp_a", "fp_b", "n_bytes"]


def collisions(docs: DataFrame, groups: DataFrame, rows: int) -> DataFrame:
    """Fingerprints whose texts differ; ``groups`` has a row for each that several texts share."""
    hot = hot_keys(groups, rows).select(*_KEY, "n_salts")
    shared = (groups.join(F.broadcast(hot), _KEY, "left")
              .select(*_KEY, F.explode(F.sequence(
                  F.lit(0), F.coalesce("n_salts", F.lit(1)) - 1)).alias("salt")))
    pieces = (docs.select(F.monotonically_increasing_id().alias("uid"),
                          F.col("doc_id").cast("long").alias("doc_id"), "text")
              .filter(F.length("text") > 0).mapInArrow(trimmed(_chunks), _KEYED_DDL)
              .join(F.broadcast(hot), _KEY, "left")
              .withColumn("salt", F.expr("pmod(spread, coalesce(n_salts, 1))")))
    some = (pieces.join(shared, [*_KEY, "salt"], "left_semi")
            .groupBy(*_KEY, "salt", "seq")
            .agg(F.min("data").alias("least"), F.max("data").alias("most")))
    return (some.groupBy(*_KEY, "seq").agg(F.min("least").alias("least"), F.max("most").alias("most"))
            .filter(F.col("least") != F.col("most")).select(*_KEY).distinct())


def shared_bits(marks: DataFrame, groups: DataFrame) -> DataFrame:
    """``(bucket, bits)``: a bitmap of SHARED_BITS bits in which the texts are set whose fingerprint others
    share.  It has SHARED_BITS / 32,768 rows of 4 KB at most, whatever the input, and so may be broadcast."""
    found = marks.join(groups, _KEY, "left_semi").select(_place(F.col("text_sha256")).alias("place"))
    return (found.groupBy(F.bitmap_bucket_number("place").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")))


def _place(sha: Column) -> Column:
    return F.pmod(F.xxhash64(sha), F.lit(SHARED_BITS)) + 1


def split_shared(docs: DataFrame, bits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``__sha``: the rows whose text is certainly no copy, and those that may share it."""
    place = _place(F.col("__sha"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.expr("substring(__bits.bits, cast(__at div 8 as int) + 1, 1)")), 16, 10).cast("long")
    marked = (docs.withColumn("__sha", F.sha2(F.coalesce("text", F.lit("")), 256))
              .withColumn("__at", at).withColumn("__bucket", F.bitmap_bucket_number(place))
              .join(F.broadcast(bits.select(F.col("bucket").alias("__bucket"), F.struct("bits").alias("__bits"))),
                    "__bucket", "left")
              .withColumn("__may", F.coalesce(F.getbit(byte, F.col("__at") % 8) == 1, F.lit(False))))
    own = [*docs.columns, "__sha"]
    return marked.filter(~F.col("__may")).select(*own), marked.filter("__may").select(*own)


def _judged(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The result of ``exact_duplicates``, the bitmap of texts that may be shared, and the number of rows."""
    marks = scratch.materialise(fingerprints(docs), "fingerprints")
    rows = marks.count()
    groups = marks.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    groups = scratch.materialise(groups, "fingerprint-groups")
    bits = scratch.materialise(shared_bits(marks, groups), "shared-texts")
    _, may = split_shared(docs.select("doc_id", "text"), bits)
    differ = scratch.materialise(collisions(may, groups, rows), "collisions")
    keyed = (marks.join(differ.withColumn("differs", F.lit(True)), _KEY, "left")
             .withColumn("variant", F.when(F.col("differs"), F.col("text_sha256")).otherwise(F.lit("")))
             .drop("differs"))
    key = [*_KEY, "variant"]
    best = scratch.materialise(
        keyed.groupBy(*key).agg(F.max(F.struct("doc_id", "uid")).alias("best"),
                                F.count(F.lit(1)).alias("group_size")).filter("group_size > 1"), "best")
    # The few largest groups are looked up where their rows are; only rows of other groups are joined by a shuffle.
    hot = hot_keys(best, rows, "group_size").drop("n_salts")
    rest = keyed.join(F.broadcast(hot.select(*key)), key, "left_anti")
    joined = keyed.join(F.broadcast(hot), key).unionByName(
        rest.join(best.join(F.broadcast(hot.select(*key)), key, "left_anti"), key, "left"),
        allowMissingColumns=True)
    return joined.select(
        "doc_id", F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("uid") == F.col("best.uid"), F.lit(True)).alias("kept"), "text_sha256", "uid"), bits, rows


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, uid.

    The row with the largest doc_id of equal texts stays.
    """
    return _judged(docs)[0]


@carrying("doc_id", "text")
def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    Texts that no other shares are not shuffled, and copies in the largest groups go before the shuffle."""
    judged, bits, n_rows = _judged(docs)
    kept = scratch.materialise(judged.filter("kept AND group_size > 1").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__kept_sha"), "group_size"), "kept-copies")
    single, may = split_shared(docs, bits)

    def without_copies(rows: DataFrame, stays: DataFrame) -> DataFrame:
        met = rows.join(stays, F.col("__sha") == F.col("__kept_sha"), "left")
        return (met.filter(F.col("__kept_sha").isNull() | F.col("doc_id").eqNullSafe(F.col("__id")))
                .drop("__kept_sha", "__id"))

    stays = kept.drop("group_size")
    hot = hot_keys(kept, n_rows, "group_size").drop("group_size", "n_salts")
    chosen = without_copies(without_copies(may, F.broadcast(hot)), stays).dropDuplicates(["doc_id", "__sha"])
    return single.unionByName(chosen).select(*docs.columns)
