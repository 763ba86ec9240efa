"""Joint publication, refused CSV lines, long lines and ranks in ranges."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from orderlens.functions import text
from orderlens.operators import gaps
from orderlens.operators.ranking import ranged_rank
from orderlens.plans import normalize as N
from orderlens.sources import tables as T
from orderlens.sources.snapshots import Snapshots
from orderlens.sources.wide import CHUNK, explode_entries, list_chunks, read_wide, stage_lines

from .conftest import write_wide
from .test_plans import plan_text


def line(name, n=2, date="20200102", price="3.5"):
    lists = [";".join(f"{what}{i}" for i in range(n)) for what in ("P", "C", "D")]
    return "\t".join([name, "1 Road", "Town", "Land", "North", *lists, ";".join([price] * n),
                      ";".join(str(i + 1) for i in range(n)), ";".join([date] * n)])


# ---- all tables or none

def counts(n):
    return {t: n.table(t).count() for t in T.SCHEMAS}


def test_a_failed_run_leaves_the_tables_as_they_were(spark, workdir, monkeypatch):
    out = os.path.join(workdir, "out")
    good = N.normalize(spark, write_wide(f"{workdir}/a", [line("A B"), line("C D")]), out)
    before = counts(good)
    assert before["Customer"] == 2 and good.rows["OrderDetail"] == 4
    # A date that does not parse: found in the last step, when five tables are written.
    bad = write_wide(f"{workdir}/b", [line("E F", 3, date="2020-99-99")])
    with pytest.raises(Exception):
        N.normalize(spark, bad, out)
    # A failure behind the last table.
    real = N.order_detail_table

    def broken(*args, **kwargs):
        found = real(*args, **kwargs)
        return type(found)(found.order_detail, found.rejects.withColumn("reason", F.raise_error(F.lit("lost"))))

    monkeypatch.setattr(N, "order_detail_table", broken)
    with pytest.raises(Exception, match="lost"):
        N.normalize(spark, write_wide(f"{workdir}/c", [line("G H"), line("No")]), out)
    monkeypatch.undo()
    again = N.open_normalized(spark, out)
    assert again.version == 1 and counts(again) == before
    assert sorted(r.FirstName for r in again.customer.collect()) == ["A", "C"]
    assert len(os.listdir(f"{out}/_versions")) == 1  # the failed runs' folders are gone
    new = N.normalize(spark, write_wide(f"{workdir}/d", [line("I J")]), out)
    assert new.version == 2 and counts(new)["Customer"] == 1
    assert counts(N.open_normalized(spark, out, 1)) == before  # a reader of the version before goes on


def test_versions(spark, workdir):
    store = Snapshots(spark, f"{workdir}/v")
    with pytest.raises(FileNotFoundError):
        store.manifest()
    for i in range(4):
        with store.write() as version:
            saved = version.save(spark.range(i), "T")
        assert version.number == i + 1 and saved.count() == i == store.manifest().rows["T"]
    with pytest.raises(KeyError):
        store.manifest().path("U")
    assert store.vacuum(keep=2) == [1, 2] and store.numbers() == [3, 4]
    assert len(os.listdir(f"{workdir}/v/_versions")) == 2
    assert spark.read.parquet(store.manifest(3).path("T")).count() == 2


def test_two_publishers_get_two_numbers(spark, workdir, monkeypatch):
    one, two = Snapshots(spark, f"{workdir}/v"), Snapshots(spark, f"{workdir}/v")
    one.publish("_versions/a", {"T": 1})
    seen = one.numbers()
    assert two.publish("_versions/b", {"T": 2}) == 2
    # The first publisher's list is out of date: the taken number is refused, the next one is tried.
    real, first = one.numbers, [seen]
    monkeypatch.setattr(one, "numbers", lambda: first.pop() if first else real())
    assert one.publish("_versions/c", {"T": 3}) == 3
    assert [two.manifest(i).rows["T"] for i in (1, 2, 3)] == [1, 2, 3]


# ---- golden CSV

def test_corrupt_csv_lines(spark, workdir):
    path = f"{workdir}/p.csv"
    with open(path, "w") as f:
        f.write('ProductID,ProductName,ProductUnitPrice,ProductCategoryID\n1,"a ""b"", c",2.5,1\nx,d,1.0,1\n3,e,n/a,1\n4,f,1.0\n')
    with pytest.raises(Exception):
        T.read_golden_csv(spark, path, "Product").collect()
    assert [tuple(r) for r in T.golden_csv_rows(spark, path, "Product").collect()] == [(1, 'a "b", c', 2.5, 1)]
    got = {r.line: r.bad_columns for r in T.golden_csv_rejects(spark, path, "Product").collect()}
    assert got == {"x,d,1.0,1": "ProductID", "3,e,n/a,1": "ProductUnitPrice", "4,f,1.0": "ProductCategoryID"}
    with open(path, "w") as f:
        f.write("ProductID,Name,ProductUnitPrice,ProductCategoryID\n1,a,2.5,1\n")
    with pytest.raises(Exception):
        T.read_golden_csv(spark, path, "Product").collect()


# ---- long lines

def test_list_chunks(spark):
    rows = ["", ";", "a", "a;b", "a;b;c", ";;x;;", ";".join(map(str, range(1000)))]
    got = spark.createDataFrame([(r,) for r in rows], "v string").select(
        "v", text.list_chunks(F.col("v"), 3).alias("c"), text.list_size(F.col("v")).alias("n")).collect()
    for r in got:
        parts = r.v.split(";")
        assert r.n == len(parts)
        assert [c.split(";") for c in r.c] == [parts[i:i + 3] for i in range(0, len(parts), 3)]


def test_a_line_with_most_entries_is_divided(spark, workdir, scratch):
    n = 300_000
    dates = "20200101;" * (n - 3) + "20200101"  # two dates too few
    huge = line("Big One", 1).split("\t")
    huge[5:] = [";".join(f"P{i % 50}" for i in range(n)), ";".join(["C"] * n), ";".join(["D"] * n), ";".join(["2.5"] * (n - 1)),
                ";".join(str(i % 9) for i in range(n + 5)), dates]
    path = write_wide(f"{workdir}/in", [line("A B", 3), "\t".join(huge), line("C D", CHUNK), line("E F", CHUNK + 1)])
    lines = stage_lines(read_wide(spark, path), scratch)
    chunks = list_chunks(lines.filter(F.col("n_entries") > CHUNK))
    assert chunks.agg(F.max(F.size(text.split_list(F.col("ProductName"))))).first()[0] == CHUNK
    assert chunks.count() == -(-(n + 5) // CHUNK) + 2
    assert any("hashpartitioning(file_idx" in x and "chunk" in x for x in plan_text(chunks).split("\n"))
    entries = explode_entries(lines)
    by_line = {r.n: (r.k, r.top, r.m) for r in entries.groupBy("line_seq").agg(
        F.max("n_triples").alias("n"), F.count(F.lit(1)).alias("k"), F.max("pos").alias("top"),
        F.count("OrderDate").alias("m")).collect()}
    assert by_line == {3: (3, 2, 3), n - 1: (n + 5, n + 4, n - 2), CHUNK: (CHUNK, CHUNK - 1, CHUNK),
                       CHUNK + 1: (CHUNK + 1, CHUNK, CHUNK + 1)}
    wrong = entries.filter((F.col("n_triples") == n - 1) & (F.col("QuantityOrdered") != (F.col("pos") % 9).cast("string"))
                           & (F.col("pos") < n))
    assert wrong.count() == 0
    out = N.normalize(spark, path, f"{workdir}/out")
    assert out.rows["OrderDetail"] == 3 + (n - 2) + CHUNK + CHUNK + 1
    assert {r.reason: r["count"] for r in out.rejects.groupBy("reason").count().collect()} == {"missing or bad date": 2}
    top = out.order_detail.orderBy(F.desc("OrderID")).first()
    assert top.OrderID == out.rows["OrderDetail"] and top.QuantityOrdered == CHUNK + 1


def test_blank_lines_and_header(spark, workdir, scratch):
    path = f"{workdir}/in"
    os.makedirs(path)
    for i in range(3):
        with open(f"{path}/f{i}.tsv", "w") as f:
            f.write("\n  \n\t\t\nName\tHeader\n\n" + line(f"N {i}") + "\n \t \n" + line(f"M {i}") + "\n\n")
    lines = stage_lines(read_wide(spark, path), scratch)
    assert sorted(r.Name for r in lines.collect()) == [f"{c} {i}" for c in "MN" for i in range(3)]
    assert "SortAggregate" not in plan_text(lines)


# ---- ranks

def test_ranged_rank(spark, scratch):
    rnd = random.Random(2)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([None, 5, 5, 5, *range(300)]), i) for i in range(4_000)]
    df = spark.createDataFrame(rows, "g string, v int, i int")

    def want(groups, up):
        key = (lambda v: (v is None, v or 0)) if up else (lambda v: (v is None, -(v or 0)))
        out = {}
        for g, v, i in rows:
            out[i] = 1 + sum(key(w) < key(v) for h, w, _ in rows if not groups or h == g)
        return out

    for groups, up in (([], False), (["g"], False), (["g"], True)):
        got = ranged_rank(df, groups, ["v"], "r", scratch, descending=not up, buckets=7)
        assert got.columns == ["g", "v", "i", "r"] and "SinglePartition" not in plan_text(got)
        assert {r.i: r.r for r in got.collect()} == want(groups, up)
    assert ranged_rank(df.limit(0), [], ["v"], "r", scratch).count() == 0


# ---- gaps

def test_summaries_merge_in_any_grouping(spark):
    rnd = random.Random(6)
    days = sorted(rnd.sample(range(-900, 900), 40))
    spans = {}
    for d in days:
        spans.setdefault(d // gaps.SPAN, []).append(d)
    rows = [(s, sum(1 << (d % gaps.SPAN) for d in ds), len(ds)) for s, ds in sorted(spans.items())]
    found = spark.createDataFrame(rows, "s int, b long, n long").orderBy("s").select(
        gaps.span_summary(F.col("b"), F.col("s") * gaps.SPAN, F.col("n")).alias("x")).collect()
    sums = [tuple(r.x) for r in found]
    pairs = [(b - a, b) for a, b in zip(days, days[1:], strict=False)]
    longest = max(g for g, _ in pairs)
    want = (days[0], days[-1], (longest, -min(u for g, u in pairs if g == longest)), len(days))

    def join(one, two):
        df = spark.createDataFrame([(one, two)], f"a {gaps._SUMMARY}, b {gaps._SUMMARY}")
        return tuple(df.select(gaps.merged(F.col("a"), F.col("b")).alias("x")).first().x)

    left = sums[0]
    for s in sums[1:6]:
        left = join(left, s)
    right = sums[6]
    for s in sums[7:]:
        right = join(right, s)
    assert join(left, right) == want


def test_gaps_across_spans(spark):
    base = dt.date(1969, 12, 1)
    rows = [(1, base, 1), (1, base + dt.timedelta(200), 1), (1, base + dt.timedelta(400), 3), (2, base, 4), (3, base, 1),
            (4, None, 2), (5, base, 1), (5, None, 1)]
    got = sorted(tuple(r) for r in gaps.longest_gaps(spark.createDataFrame(rows, "CustomerID long, OrderDate date, n long")).collect())
    assert got == [(1, base + dt.timedelta(200), base, 200.0), *[(2, base, base, 0.0)] * 3]


# ---- layout

def test_order_detail_is_clustered_by_customer(spark, workdir):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [line("Hot One", 400)] + [line(f"N M{i}", 4) for i in range(60)]
        out = N.normalize(spark, write_wide(f"{workdir}/in", rows), f"{workdir}/out")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = out.order_detail.groupBy(F.input_file_name().alias("f")).agg(
        F.min("CustomerID").alias("low"), F.max("CustomerID").alias("high"), F.count(F.lit(1)).alias("n")).orderBy("low", "high").collect()
    assert len(files) > 2
    assert all(a.high <= b.low for a, b in zip(files, files[1:], strict=False))
    hot = out.customer.filter("FirstName = 'Hot'").first().CustomerID
    assert sum(f.low <= hot <= f.high for f in files) > 1  # the hot customer is divided
    assert out.order_detail.agg(F.count_distinct("OrderID"), F.max("OrderID")).first()[:] == (640, 640)
