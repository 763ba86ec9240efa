"""Ranking operators: RANK within groups and top-k per group.

Ties share a rank and are all kept.

* ``top_k``: a filter ``rank <= k`` directly above the window lets Spark
  insert a ``WindowGroupLimit`` below the shuffle, so each task forwards at
  most k (plus ties) rows per group: a group holding a third of all rows costs
  a per-task top-k, not a full sort in one task.
* ``with_rank``: the plain window, for groups of a known small size.
* ``ranged_rank``: the rank of every row, in groups of any size, the whole
  table as one group included.  No task holds a group; it holds one range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import Scratch


def _window(partition_by: Sequence[str], order_by: Sequence[Column]):
    w = Window.partitionBy(*partition_by) if partition_by else Window
    return w.orderBy(*order_by)


def with_rank(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column],
              name: str) -> DataFrame:
    """Add ``RANK() OVER (PARTITION BY .. ORDER BY ..)`` as bigint.

    With no partition columns the window is global (single partition):
    only use that on inputs with a known small bound (e.g. 12 months).
    """
    return df.withColumn(name, F.rank().over(_window(partition_by, order_by)).cast("bigint"))


def top_k(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column],
          k: int, name: str) -> DataFrame:
    """Rows whose rank within their group is <= k (ties kept)."""
    ranked = df.withColumn(name, F.rank().over(_window(partition_by, order_by)))
    return ranked.filter(F.col(name) <= k).withColumn(name, F.col(name).cast("bigint"))


def ranged_rank(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str], name: str,
                scratch: Scratch, descending: bool = True, buckets: int | None = None) -> DataFrame:
    """Add ``RANK() OVER (PARTITION BY .. ORDER BY ..)`` as bigint to every row.

    1. Rows are counted by (group, order values): a hash aggregate, so ties collapse before the
       shuffle and one value that a third of all rows share is one row.
    2. These counts are range-partitioned on (group, order values), sorted, and pinned with the
       number of their range, so a lost executor cannot move a border.
    3. Inside (range, group) a window sums the counts before each value: a range at most.
    4. Each range's total by group is a row; a window over a group's ranges, which are no more than
       the shuffle partitions, gives what stands before a range.  Ties never cross a border, as equal
       values are one row.
    5. rank = both sums + 1, joined back to the rows by group and order values; AQE splits that
       join where many rows share a value.

    Null order values stand behind all others and share a rank; null groups are a group.
    """
    direction = (lambda c: F.col(c).desc_nulls_last()) if descending else (lambda c: F.col(c).asc_nulls_last())
    keys, order = [*partition_by, *order_by], [direction(c) for c in order_by]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    ranges = [*[F.col(c).asc() for c in partition_by], *order]
    ranged = counts.repartitionByRange(buckets, *ranges) if buckets else counts.repartitionByRange(*ranges)
    pinned = scratch.pin(ranged.sortWithinPartitions(*ranges).withColumn("__range", F.spark_partition_id()), name)

    before = Window.partitionBy("__range", *partition_by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = pinned.withColumn("__inside", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    totals = pinned.groupBy("__range", *partition_by).agg(F.sum("__n").alias("__total"))
    # A group's ranges: no more rows than shuffle partitions.  Without groups all ranges are one.
    of = Window.partitionBy(*partition_by, *([] if partition_by else [F.col("__range") < 0]))
    outside = totals.select("__range", *partition_by, F.coalesce(
        F.sum("__total").over(of.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__outside"))

    def same(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> Column:
        return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in cols])

    ranks = inside.join(outside, same(inside, outside, ["__range", *partition_by])).select(
        *[inside[c].alias(f"__k{i}") for i, c in enumerate(keys)],
        (F.col("__inside") + F.col("__outside") + 1).cast("bigint").alias(name))
    match = reduce(lambda x, y: x & y, [df[c].eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(keys)])
    return df.join(ranks, match).select(*[df[c] for c in df.columns], name)
