"""Longest gap between consecutive orders, per customer.

Semantics (row level): order the customer's order rows by date, take
``gap = date - previous date`` for every row but the first, keep the
rows with the maximum gap and, among them, the earliest date.  Several
rows on one date make gaps of 0, so a customer whose orders are all on
one day yields ``n - 1`` identical rows with gap 0.

Scalable form: a summary of a span of days that merges with the next one's,

    first day, last day, longest gap inside, the day that ends it, number of rows,

so no window is needed and no customer's rows are sorted:

1. rows are reduced to (customer, span of ``SPAN`` days): the days as bits of one
   number, or-ed together, and the number of rows.  Both are hash aggregates that
   combine before the shuffle, so a hot customer collapses map-side;
2. a span's bits give its summary;
3. a customer's summaries, no more than the calendar has spans, are folded in the order
   of time: between two spans lies the gap from the last day of one to the first
   of the next.  Of equal gaps the earliest stays.

Then

* customers with >= 2 distinct dates have the summary's gap, as one row: the
  first row of a later date has the gap to the date before, all other rows 0;
* customers with exactly one date and n >= 2 rows: ``n - 1`` rows
  ``(d, d, 0.0)``, produced by the chunked ``replicate``, which takes the rows of all customers
  (one each, few next to the orders), so that what is before it runs once;
* customers with one row: absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.replicate import replicate

#: Days of a span: the bits of a long without its sign.
SPAN = 63
#: The longest gap is kept with the day that ends it, negated: the greater of two is the longer, then the earlier.
_SUMMARY = "struct<first:int,last:int,best:struct<gap:int,ends:int>,n:bigint>"


def _gap(days: Column, until: Column) -> Column:
    return F.struct(days.cast("int").alias("gap"), (-until).cast("int").alias("ends"))


def span_summary(bits: Column, start: Column, n: Column) -> Column:
    """The summary of the days ``start + i`` of the set bits i."""
    # The runs of zeros from the lowest bit on: before the first day, between days, behind the last (empty).
    zeros = F.reverse(F.split(F.bin(bits), "1"))

    def step(acc: Column, run: Column) -> Column:
        day = acc["last"] + F.length(run) + 1
        return F.struct(acc["first"].alias("first"), day.alias("last"),
                        F.greatest(acc["best"], _gap(F.length(run) + 1, day)).alias("best"), acc["n"].alias("n")).cast(_SUMMARY)

    first = start + F.length(F.get(zeros, 0))
    begin = F.struct(first.alias("first"), first.alias("last"), _gap(F.lit(0), first).alias("best"), n.alias("n")).cast(_SUMMARY)
    return F.aggregate(F.slice(zeros, 2, F.bit_count(bits) - 1), begin, step)


def merged(one: Column, later: Column) -> Column:
    """The summary of two spans, the second behind the first."""
    best = F.greatest(one["best"], _gap(later["first"] - one["last"], later["first"]), later["best"])
    return F.struct(one["first"].alias("first"), later["last"].alias("last"), best.alias("best"),
                    (one["n"] + later["n"]).alias("n")).cast(_SUMMARY)


def longest_gaps(day_counts: DataFrame, key: str = "CustomerID",
                 date_col: str = "OrderDate", count_col: str = "n",
                 names: DataFrame | None = None) -> DataFrame:
    """``day_counts``: rows ``(key, date, n)``, not necessarily distinct.

    Returns ``(key, OrderDate, PreviousOrderDate, MaxDaysWithoutOrder)`` and the columns of
    ``names`` (one row per key), which is joined on the windows' partitioning.

    Rows without a date have no gap and count for nothing.
    """
    day = F.unix_date(date_col)
    spans = (day_counts.filter(F.col(date_col).isNotNull())
             .groupBy(key, F.floor(day / SPAN).cast("int").alias("__span"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(SPAN)))).alias("__bits"),
                  F.sum(count_col).cast("bigint").alias("__n")))
    summary = span_summary(F.col("__bits"), F.col("__span") * SPAN, F.col("__n"))
    lists = spans.select(key, summary.alias("__s")).groupBy(key).agg(F.array_sort(F.collect_list("__s")).alias("__all"))
    whole = lists.select(key, F.aggregate(F.slice("__all", 2, F.size("__all")), F.get("__all", 0), merged).alias("__s"))
    single = F.col("__s.first") == F.col("__s.last")
    chosen = whole.withColumn("__copies", F.when(single, F.col("__s.n") - 1).otherwise(F.lit(1))).filter(
        F.col("__copies") > 0).select(
        key, F.date_from_unix_date(-F.col("__s.best.ends")).alias("OrderDate"),
        F.date_from_unix_date(-F.col("__s.best.ends") - F.col("__s.best.gap")).alias("PreviousOrderDate"),
        F.col("__s.best.gap").cast("double").alias("MaxDaysWithoutOrder"), "__copies")
    if names is not None:
        chosen = chosen.join(names, key)
    return replicate(chosen, "__copies", spread_cols=[key]).drop("__copies")
