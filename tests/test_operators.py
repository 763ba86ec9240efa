"""Operator tests against brute force on small fixtures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderlens.operators import quality
from orderlens.operators.gaps import longest_gaps
from orderlens.operators.keys import dense_ids
from orderlens.operators.replicate import replicate


def test_dense_ids(spark, scratch):
    rnd = random.Random(7)
    rows = [(rnd.choice("abcde"), rnd.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, tie long")
    out = dense_ids(df, ["k", F.col("v").desc(), "tie"], "id", scratch, buckets=6).collect()
    got = {r.tie: r.id for r in out}
    want = {t: i + 1 for i, (_, _, t) in
            enumerate(sorted(rows, key=lambda r: (r[0], -r[1], r[2])))}
    assert got == want


def _gaps_brute(rows):
    """Reference semantics at row level: lag, max gap, earliest date."""
    by = {}
    for c, d in rows:
        by.setdefault(c, []).append(d)
    out = []
    for c, ds in by.items():
        ds = sorted(ds)
        pairs = [(ds[i], ds[i - 1], (ds[i] - ds[i - 1]).days) for i in range(1, len(ds))]
        if not pairs:
            continue
        m = max(p[2] for p in pairs)
        first = min(p[0] for p in pairs if p[2] == m)
        out += [(c, d, p, float(g)) for d, p, g in pairs if g == m and d == first]
    return sorted(out)


def test_longest_gaps_brute_force(spark):
    rnd = random.Random(3)
    base = dt.date(2020, 1, 1)
    rows = []
    for c in range(60):
        n = rnd.choice([1, 2, 3, 5, 12])
        span = rnd.choice([0, 1, 30, 400])
        rows += [(c, base + dt.timedelta(days=rnd.randint(0, span))) for _ in range(n)]
    df = spark.createDataFrame([(c, d, 1) for c, d in rows], "CustomerID long, OrderDate date, n long")
    got = sorted(tuple(r) for r in longest_gaps(df).collect())
    assert got == _gaps_brute(rows)


def test_replicate_chunks(spark):
    df = spark.createDataFrame([("a", 7), ("b", 0), ("c", 1), ("d", 10)], "k string, n long")
    out = replicate(df, "n", chunk=3).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in out} == {"a": 7, "c": 1, "d": 10}


def test_quality_checks(spark):
    parent = spark.createDataFrame([(1, "x"), (2, None), (2, "y")], "id long, v string")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, 3), (13, None)], "cid long, pid long")
    nulls = {(r.table_name, r.column_name): r.null_count
             for r in quality.null_counts({"p": parent, "c": child}).collect()}
    assert nulls == {("p", "id"): 0, ("p", "v"): 1, ("c", "cid"): 0, ("c", "pid"): 1}
    dups = [tuple(r) for r in quality.duplicate_keys({"p": (parent, ["id"])}).collect()]
    assert dups == [("p", "2", 2)]
    orphans = [tuple(r) for r in quality.orphan_keys([("c->p", child, "pid", parent, "id")]).collect()]
    assert orphans == [("c->p", "3", 2)]


def test_golden_csv_reader(spark, workdir):
    import os

    from orderlens.sources.tables import read_golden_csv

    path = os.path.join(workdir, "golden.csv")
    with open(path, "w", newline="") as f:
        f.write('ProductCategoryID,ProductCategory,ProductCategoryDescription\r\n'
                '1,Tools,"Hammers, saws, and drills"\r\n'
                '2,Paint,"Brushes, rollers, ""quick-dry"" paint"\r\n')
    rows = [tuple(r) for r in read_golden_csv(spark, path, "ProductCategory").collect()]
    assert rows == [(1, "Tools", "Hammers, saws, and drills"),
                    (2, "Paint", 'Brushes, rollers, "quick-dry" paint')]


def test_packed_order_key_matches_struct_order(spark):
    from orderlens.sources.wide import packed_entry_order

    rnd = random.Random(21)
    rows = []
    for _ in range(400):
        task = rnd.randint(0, 50)
        rows.append((rnd.randint(1, 5), rnd.choice([0, 1 << 27, 1 << 39]),
                     (task << 33) | rnd.randint(0, 1000), rnd.randint(0, (1 << 28) - 1)))
    # lines of one split share one task id: make it so
    task_of = {}
    fixed = []
    for f, b, seq, pos in rows:
        t = task_of.setdefault((f, b), rnd.randint(0, 50))
        fixed.append((f, b, (t << 33) | (seq & ((1 << 33) - 1)), pos))
    df = spark.createDataFrame(fixed, "file_idx int, block_start long, line_seq long, pos int")
    got = [tuple(r)[:4] for r in df.withColumn("k", packed_entry_order()).orderBy("k").collect()]
    assert got == sorted(fixed)
    bad = spark.createDataFrame([(1, 0, 0, 1 << 28)], "file_idx int, block_start long, "
                                                      "line_seq long, pos int")
    with pytest.raises(Exception, match="order key overflow"):
        bad.select(packed_entry_order()).collect()

