"""Physical-plan properties the design relies on (checked on sf0.01)."""

import contextlib
import datetime
import glob
import gzip
import io
import re

import pytest

from orderlens.plans import analytics as A
from orderlens.sources.star import star_model

from .conftest import SF_MID


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def model(spark):
    return star_model(spark, SF_MID)


def test_top_k_uses_window_group_limit(model):
    for q in (A.q09_top5_customers_per_quarter(model), A.q07_top_country_per_region(model)):
        assert "WindowGroupLimit" in plan_text(q)


def test_customer_filter_reaches_the_scan(model):
    text = plan_text(A.q01_customer_orders(model, "Customer#000000001"))
    scan = next(x for x in text.split("\n\n") if "Scan parquet" in x and "o_custkey" in x)
    assert "EqualTo(o_custkey" in scan.replace(" ", "") and "Subquery" in scan


def test_no_job_runs_before_the_action(spark, model):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "building q01 and q02")
    try:
        A.q01_customer_orders(model, "Customer#000000001")
        A.q02_customer_total(model, "Customer#000000001")
        assert not tracker.getJobIdsForGroup("lazy")
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_scans_are_pruned(model):
    text = plan_text(A.q10_month_rank(model))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text


def test_lines_aggregated_per_basket_before_orders_join(model):
    text = plan_text(A.q03_totals_by_customer(model))
    # partial + final aggregate on the basket key feed the orders join
    assert text.count("HashAggregate") >= 4
    assert "Keys [1]: [OrderKey" in text


@pytest.mark.parametrize("name", ["q03_totals_by_customer", "q08_customer_quarter_totals",
                                  "q09_top5_customers_per_quarter", "q11_longest_order_gap"])
def test_no_single_partition_exchange_on_growing_outputs(model, name):
    q = getattr(A, name)(model)
    assert "SinglePartition" not in plan_text(q)


def test_month_rank_single_partition_only_after_aggregation(model):
    text = plan_text(A.q10_month_rank(model))
    # the one global window runs on the (at most 12) month rows
    assert text.count("SinglePartition") == 1


def test_first_occurrence_aggregations_hash_over_all_entries(spark, scratch):
    from orderlens.operators import dims
    from orderlens.plans.wide_fixture import write_wide_fixture
    from orderlens.sources.wide import read_wide, stage_entries, stage_lines

    from .conftest import SF_SMALL

    lines = stage_lines(read_wide(spark, write_wide_fixture(spark, SF_SMALL)), scratch)
    entries = stage_entries(lines, scratch)
    category = dims.product_category_table(entries, scratch)
    # product triples: hash aggregates only
    assert "SortAggregate" not in plan_text(dims.product_table(entries, category, scratch))
    # category: the pass over all entries is a hash aggregate; the first-wins
    # pick sorts only the (category, description) pairs
    text = plan_text(category)
    assert "HashAggregate" in text



def test_wide_fixture_never_gathers_a_customer(spark):
    from orderlens.plans.wide_fixture import packed_lines

    from .conftest import SF_SMALL

    text = plan_text(packed_lines(spark, SF_SMALL))
    assert "collect_list" not in text and "Keys [2]: [o_orderkey" in text


def test_normalized_totals_sum_quantities_before_the_product_join(spark):
    from orderlens.plans.roundtrip import RoundTrip

    from .conftest import SF_SMALL

    trip = RoundTrip()
    text = plan_text(A.q03_totals_by_customer(trip(spark, SF_SMALL).model()))
    assert "Keys [2]: [CustomerID" in text and "sum(QuantityOrdered" in text
    trip.close(spark)


def _small_star(spark, folder):
    """Two orders of a customer whose row is repeated, one of them out of file order; an order of another
    customer; an order without lines and one without a customer."""
    tables = {
        "region": ("r_regionkey int, r_name string", [(1, "EAST")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(7, "FAR", 1)]),
        "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
                     [(1, "C#1", 7, "S"), (1, "C#1b", 7, "T"), (2, "C#2", 7, "S")]),
        "part": ("p_partkey bigint, p_name string, p_type string, p_retailprice double",
                 [(5, "nut", "METAL", 1.5), (6, None, None, 2.0)]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderdate date",
                   [(k, c, datetime.date(2020, 1, k)) for k, c in ((9, 2), (4, 1), (2, 1), (8, 1), (5, None))]),
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double",
                     [(9, 5, 1, 1.0), (4, 6, 2, 3.0), (4, 5, 1, 2.0), (2, 5, 1, 4.0), (5, 5, 1, 1.0), (None, 5, 1, 1.0)])}
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_wide_fixture_shuffles_orders_once_and_no_packed_text(spark, workdir):
    from orderlens.plans.wide_fixture import packed_lines

    _small_star(spark, workdir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_text(packed_lines(spark, workdir))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The lists are made where the one range shuffle of the orders put them, and go nowhere.
    assert text.count("rangepartitioning(o_orderkey") == 1
    assert not re.search(r"hashpartitioning\(o_orderkey#\w+, (o_custkey|owner)", text)


def test_wide_fixture_lines(spark, workdir):
    from orderlens.plans.wide_fixture import SORTED_GROUPS, write_wide_fixture

    _small_star(spark, workdir)
    before = spark.conf.get(SORTED_GROUPS)
    path = write_wide_fixture(spark, workdir, f"{workdir}/wide")
    assert spark.conf.get(SORTED_GROUPS) == before
    files = sorted(glob.glob(f"{path}/part-*"))
    assert files and all(f.endswith(".gz") for f in files)
    lines = [x.split("\t") for f in files for x in gzip.open(f, "rt").read().splitlines()[1:]]
    assert [sorted(x[0] for x in lines[i:i + 2]) for i in (0, 2)] == [["C 1", "C 1b"]] * 2
    two, four = ["nut 00000005", "METAL", "Parts of type METAL", "1.50", "4", "20200102"], [
        "nut 00000005;00000006", "METAL", "Parts of type METAL", "1.50;2.00", "2;3", "20200104;20200104"]
    assert [x[5:] for x in lines[:4]] == [two, two, four, four]
    assert [x[0] for x in lines[4:]] == ["C 2"]


def test_entries_carry_no_product_name_behind_the_product_join(spark, scratch, workdir):
    from orderlens.operators.facts import order_detail_table
    from orderlens.sources.wide import read_wide, stage_entries, stage_lines

    from .conftest import write_wide

    row = "A B\ta\tc\tN\tR\tp;q;\tc;c\td;d\t1;2\t3;4;5;6\t20200101;20200102;20200103"
    lines = stage_lines(read_wide(spark, write_wide(f"{workdir}/in", [row])), scratch)
    customers = spark.createDataFrame([("A B", 1)], "Name string, CustomerID long")
    products = spark.createDataFrame([("p", 1)], "ProductName string, ProductID long")
    seen = []
    pin = scratch.pin
    scratch.pin = lambda df, name="pinned": (seen.append(plan_text(df)) if name == "order_entries" else None, pin(df, name))[1]
    fact = order_detail_table(lines, stage_entries(lines, scratch), customers, products, scratch)
    assert "Unknown" in seen[0] and "listed" in seen[0]
    assert fact.order_detail.count() == 1
    assert sorted((r.pos, r.reason) for r in fact.rejects.collect()) == [(1, "unknown product: q"), (2, "unknown product: ")]


def test_entries_are_not_shuffled_by_their_line(spark, scratch, workdir):
    """A line meets its customer before its lists are split, long lists in chunks, too."""
    from orderlens.operators.facts import order_detail_table
    from orderlens.sources.wide import CHUNK, read_wide, stage_entries, stage_lines

    from .conftest import write_wide

    n = 2 * CHUNK + 3
    long = ["p"] * n, ["c"] * n, ["d"] * n, ["1"] * n, [str(i) for i in range(n)], ["20200101"] * (n - 1)
    rows = ["A B\ta\tc\tN\tR\tp;q\tc;c\td;d\t1;2\t3;4\t20200101;20200102", "No Body\ta\tc\tN\tR\tp\tc\td\t1\tbad\t20200101",
            "A B\ta\tc\tN\tR\t" + "\t".join(";".join(x) for x in long)]
    lines = stage_lines(read_wide(spark, write_wide(f"{workdir}/in", rows)), scratch)
    customers = spark.createDataFrame([("A B", 1)], "Name string, CustomerID long")
    products = spark.createDataFrame([("p", 1)], "ProductName string, ProductID long")
    seen = []
    pin = scratch.pin
    scratch.pin = lambda df, name="pinned": (seen.append(plan_text(df)) if name == "order_entries" else None, pin(df, name))[1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = order_detail_table(lines, stage_entries(lines, scratch), customers, products, scratch)
        got = fact.order_detail.orderBy("OrderID").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(Product" in seen[0] and "hashpartitioning(line_seq" not in seen[0]
    assert [(r.OrderID, r.CustomerID, r.QuantityOrdered) for r in got] == [(1, 1, 3)] + [(i + 2, 1, i) for i in range(n - 1)]
    assert sorted((r.pos, r.reason) for r in fact.rejects.collect()) == [
        (-1, "unknown customer: No Body"), (1, "unknown product: q"), (n - 1, "missing or bad date")]


def test_longest_gaps_read_the_orders_and_names_once(spark):
    from orderlens.operators.gaps import longest_gaps

    day = datetime.date(2020, 1, 1)
    rows = [(1, day, 3), (2, day, 1), (2, day + datetime.timedelta(100), 2), (3, day, 1), (1, None, 5)]
    counts = spark.createDataFrame(rows, "CustomerID long, OrderDate date, n long")
    names = spark.createDataFrame([(i, f"c{i}") for i in (1, 2, 3)], "CustomerID long, Name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        gaps = longest_gaps(counts, names=names)
        text = plan_text(gaps)
        got = sorted((r.CustomerID, r.Name, r.MaxDaysWithoutOrder) for r in gaps.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Union" not in text and len(re.findall(r"Scan ExistingRDD\s*\[CustomerID|Scan ExistingRDD \(\d+\)", text)) <= 2
    assert got == [(1, "c1", 0.0), (1, "c1", 0.0), (2, "c2", 100.0)]
