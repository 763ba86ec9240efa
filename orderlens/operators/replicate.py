"""Row replication by a count column, without building huge arrays.

``replicate(df, n)`` emits each row ``n`` times.  Counts are split into
chunks of at most ``chunk`` rows; chunk descriptors are hash-spread over
the cluster before the second expansion, so one row with a count in the
billions still fans out over many tasks and no single array grows past
``chunk`` elements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_CHUNK = 1 << 16


def replicate(df: DataFrame, count_col: str, chunk: int = DEFAULT_CHUNK,
              spread_cols: list[str] | None = None) -> DataFrame:
    """Emit each row ``count_col`` times (rows with count <= 0 vanish).

    ``spread_cols`` identify a row for hashing chunks over partitions
    (defaults to every column).
    """
    n = F.col(count_col).cast("bigint")
    keep = df.filter(n > 0)
    n_chunks = F.floor((n - 1) / F.lit(chunk)).cast("bigint")
    chunks = keep.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), n_chunks)))
    chunks = chunks.withColumn(
        "__len", F.least(F.lit(chunk).cast("bigint"), n - F.col("__chunk") * chunk))
    key = [F.col(c) for c in (spread_cols or df.columns)] + [F.col("__chunk")]
    spread = chunks.repartition(*key)
    out = spread.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__len"))))
    return out.drop("__chunk", "__len", "__i")
