"""Hand-written wide lines, one per edge case of the normalisation rules."""

import glob
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlens.functions import money
from orderlens.plans import analytics as A
from orderlens.plans.normalize import normalize
from orderlens.sources.wide import ORDER_KEY, read_wide, stage_lines

from .conftest import write_wide


def line(name, country="Norland", region="North", products="Bolt", cats="Hardware",
         descs="Hand tools", prices="17.50", qtys="2", dates="20120814",
         address="Main Road  8", city="Northport"):
    return "\t".join([name, address, city, country, region, products, cats, descs, prices,
                      qtys, dates])


@pytest.fixture()
def base_rows():
    return [
        line("Lena Maria Holm", country="Sudland", region="South",
             products="Bolt;Nut", cats="Hardware;Fasteners", descs="Hand tools;Small parts",
             prices="17.50;4.75", qtys="1;2", dates="20120101;20120301"),
        line("Kai Berg", country="Westland", region="West",
             products="Nut;Bolt;Nut", cats="Fasteners;Hardware;Fasteners",
             descs="Small parts;Hand tools;Small parts", prices="4.75;17.50;4.75",
             qtys="3;1;1", dates="20120105;20120110;20120301",
             address='Harbour St. 5, "rear"'),
        line("Solo", country="Sudland", region="South"),
        line("Rui  Costa", country="Midland", region="Middle"),
        line("Kai Berg", country="Westland", region="North",
             products="Bolt", cats="Hardware", descs="Hand tools", prices="17.50",
             qtys="4", dates="20120201"),
        line("Tom Same", country="Sudland", region="South", products="Bolt;Bolt;Bolt",
             cats="Hardware;Hardware;Hardware", descs="Hand tools;Hand tools;Hand tools",
             prices="17.50;17.50;17.50", qtys="1;1;1", dates="20120505;20120505;20120505"),
        line("Uno Order", country="Sudland", region="South"),
    ]


def test_blank_lines_and_header_skipped(spark, scratch, workdir, base_rows):
    path = write_wide(os.path.join(workdir, "in"), base_rows, blank_lines=True)
    parsed = stage_lines(read_wide(spark, path), scratch)
    assert parsed.count() == len(base_rows)
    assert parsed.filter(~F.col("ok")).count() == 0
    # file order restored by the line order key
    names = [r.Name for r in parsed.orderBy(*ORDER_KEY).collect()]
    assert names == [r.split("\t")[0] for r in base_rows]


def test_header_per_file_in_multi_file_input(spark, scratch, workdir, base_rows):
    d = os.path.join(workdir, "in")
    write_wide(os.path.join(d, "a"), base_rows[:3])
    write_wide(os.path.join(d, "b"), base_rows[3:])
    parsed = stage_lines(read_wide(spark, f"{d}/*"), scratch)
    assert parsed.count() == len(base_rows)
    names = [r.Name for r in parsed.orderBy(*ORDER_KEY).collect()]
    assert names == [r.split("\t")[0] for r in base_rows]


def test_normalized_tables(spark, workdir, base_rows):
    n = normalize(spark, write_wide(os.path.join(workdir, "in"), base_rows),
                  out_dir=os.path.join(workdir, "out"))
    regions = [tuple(r) for r in n.region.orderBy("RegionID").collect()]
    assert [r[1] for r in regions] == ["Middle", "North", "South", "West"]
    assert [r[0] for r in regions] == list(range(1, len(regions) + 1))

    # Country: first line wins (Westland -> West, not North)
    rid = {r.Region: r.RegionID for r in n.region.collect()}
    countries = {r.Country: r.RegionID for r in n.country.collect()}
    assert countries["Westland"] == rid["West"]
    assert [r.Country for r in n.country.orderBy("CountryID").collect()] == sorted(countries)

    cust = n.customer.orderBy("CustomerID").collect()
    # one customer per line, sorted by (FirstName, LastName), file order on ties
    assert len(cust) == len(base_rows)
    keys = [(c.FirstName, c.LastName) for c in cust]
    assert keys == sorted(keys)
    by_name = {}
    for c in cust:
        by_name.setdefault((c.FirstName, c.LastName), []).append(c)
    assert ("Lena", "Maria Holm") in by_name                 # three-token name
    assert by_name[("Solo", "")][0].LastName == ""            # one-token name
    assert ("Rui", "Costa") in by_name                     # inner spaces normalised
    assert len(by_name[("Kai", "Berg")]) == 2             # no de-duplication
    assert by_name[("Kai", "Berg")][0].Address == 'Harbour St. 5, "rear"'  # kept as is
    assert by_name[("Lena", "Maria Holm")][0].Address == "Main Road  8"

    cats = [(r.ProductCategory, r.ProductCategoryDescription)
            for r in n.product_category.orderBy("ProductCategoryID").collect()]
    assert cats == [("Fasteners", "Small parts"), ("Hardware", "Hand tools")]

    od = n.order_detail
    ids = [r.OrderID for r in od.orderBy("OrderID").collect()]
    assert ids == list(range(1, len(ids) + 1))
    kai_ids = [c.CustomerID for c in by_name[("Kai", "Berg")]]
    per_cust = {r.CustomerID: r["count"] for r in od.groupBy("CustomerID").count().collect()}
    # duplicate name: all orders (3 + 1) go to the last id
    assert per_cust.get(max(kai_ids)) == 4 and min(kai_ids) not in per_cust
    # one-token name and double-space name: orders dropped
    assert by_name[("Solo", "")][0].CustomerID not in per_cust
    assert by_name[("Rui", "Costa")][0].CustomerID not in per_cust
    # OrderID follows file order: Lena's two orders come first
    lena = by_name[("Lena", "Maria Holm")][0].CustomerID
    first_two = od.orderBy("OrderID").limit(2).collect()
    assert [r.CustomerID for r in first_two] == [lena, lena]
    reasons = {r.reason.split(":")[0] for r in n.rejects.collect()}
    assert "unknown customer" in reasons


def test_longest_gap_edge_rows(spark, workdir, base_rows):
    n = normalize(spark, write_wide(os.path.join(workdir, "in"), base_rows),
                  out_dir=os.path.join(workdir, "out"))
    q11 = A.q11_longest_order_gap(n.model()).collect()
    cust = {r.CustomerID: (r.FirstName, r.LastName) for r in n.customer.collect()}
    rows = [(cust[r.CustomerID], r.MaxDaysWithoutOrder, str(r.OrderDate)) for r in q11]
    # all three orders on one day -> two rows with gap 0
    assert [x for x in rows if x[0] == ("Tom", "Same")] == [(("Tom", "Same"), 0.0, "2012-05-05")] * 2
    # single order -> absent
    assert not [x for x in rows if x[0] == ("Uno", "Order")]
    # Kai (last id): dates 01-05, 01-10, 02-01, 03-01 -> gaps 5, 22, 29 -> 29 ending 03-01
    assert (("Kai", "Berg"), 29.0, "2012-03-01") in rows


def test_reopen_written_tables(spark, workdir, base_rows):
    from orderlens.plans.normalize import open_normalized

    n = normalize(spark, write_wide(os.path.join(workdir, "in"), base_rows),
                  out_dir=os.path.join(workdir, "out"))
    again = open_normalized(spark, n.out_dir)
    for t in ("Region", "Country", "Customer", "ProductCategory", "Product", "OrderDetail"):
        assert sorted(map(tuple, again.table(t).collect())) == \
            sorted(map(tuple, n.table(t).collect()))


def test_duplicate_price_text_makes_two_products(spark, workdir):
    rows = [line("A B", products="Bolt", prices="39", qtys="1", dates="20120101"),
            line("C D", products="Bolt", prices="39.0", qtys="2", dates="20120102")]
    n = normalize(spark, write_wide(os.path.join(workdir, "in"), rows),
                  out_dir=os.path.join(workdir, "out"))
    prods = n.product.orderBy("ProductID").collect()
    assert [(p.ProductName, p.ProductUnitPrice) for p in prods] == [("Bolt", 39.0), ("Bolt", 39.0)]
    # orders bind to the last id
    assert {r.ProductID for r in n.order_detail.collect()} == {2}


def test_short_date_list_goes_to_rejects(spark, workdir):
    rows = [line("A B", products="Bolt;Bolt", cats="Hardware;Hardware",
                 descs="Hand tools;Hand tools", prices="17.50;17.50", qtys="1;2",
                 dates="20120101")]
    n = normalize(spark, write_wide(os.path.join(workdir, "in"), rows),
                  out_dir=os.path.join(workdir, "out"))
    assert n.order_detail.count() == 1
    assert [r.reason for r in n.rejects.collect()] == ["missing or bad date"]


def test_wrong_field_count_is_rejected(spark, workdir):
    rows = [line("A B"), "X Y\tonly\tten\tfields\there\ta\tb\tc\td\te"]
    n = normalize(spark, write_wide(os.path.join(workdir, "in"), rows),
                  out_dir=os.path.join(workdir, "out"))
    assert n.customer.count() == 1
    assert [r.reason for r in n.rejects.collect()] == ["field count 10"]


@pytest.mark.parametrize("bad", [{"qtys": "x"}, {"dates": "2012-08-14"}])
def test_bad_values_strict_and_lenient(spark, workdir, bad):
    rows = [line("A B", **bad), line("C D")]
    path = write_wide(os.path.join(workdir, "in"), rows)
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT|CANNOT_PARSE_TIMESTAMP|CAST"):
        normalize(spark, path, out_dir=os.path.join(workdir, "strict"), strict=True)
    n = normalize(spark, path, out_dir=os.path.join(workdir, "lenient"), strict=False)
    assert n.order_detail.count() == 1
    assert n.rejects.count() == 1


def test_unknown_region_fails_strict_lookup(spark, scratch, workdir):
    from orderlens.operators import dims

    lines = stage_lines(read_wide(spark, write_wide(os.path.join(workdir, "in"), [line("A B")])),
                        scratch)
    region = spark.createDataFrame([(1, "Elsewhere")], "RegionID long, Region string")
    with pytest.raises(PySparkException, match="unknown region"):
        dims.country_table(lines, region, scratch).collect()


def test_bad_price_strict_and_lenient(spark, workdir):
    rows = [line("A B", prices="abc"), line("C D", products="Nut", prices="2.50")]
    path = write_wide(os.path.join(workdir, "in"), rows)
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        normalize(spark, path, out_dir=os.path.join(workdir, "strict"), strict=True)
    n = normalize(spark, path, out_dir=os.path.join(workdir, "lenient"), strict=False)
    assert [r.ProductName for r in n.product.collect()] == ["Nut"]
    assert n.order_detail.count() == 1
    assert sorted(r.reason for r in n.rejects.collect()) == ["bad price: abc of Bolt",
                                                             "unknown product: Bolt"]


def test_bad_quantity_on_unmatched_line_does_not_fail_strict(spark, workdir):
    # one-token name: its lookup key is "Solo " so the line never matches;
    # its quantities are never parsed, as in the source workload
    rows = [line("Solo", qtys="x"), line("C D")]
    n = normalize(spark, write_wide(os.path.join(workdir, "in"), rows),
                  out_dir=os.path.join(workdir, "out"), strict=True)
    assert n.order_detail.count() == 1
    assert [r.reason for r in n.rejects.collect()] == ["unknown customer: Solo"]


def test_fields_behind_the_eleventh_are_ignored(spark, workdir):
    n = normalize(spark, write_wide(os.path.join(workdir, "in"), [line("A B") + "\tmore\tfields"]),
                  out_dir=os.path.join(workdir, "out"))
    assert (n.customer.count(), n.product.count(), n.order_detail.count()) == (1, 1, 1)
    assert n.rejects.count() == 0


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_money_is_exact_or_fails(spark, workdir, ansi):
    saved = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        n = normalize(spark, write_wide(os.path.join(workdir, "in"), [line("A B", prices="0.125", qtys="4")]),
                      out_dir=os.path.join(workdir, "out"))
        assert [r.Total for r in A.q03_totals_by_customer(n.model()).collect()] == [0.50]
        big = normalize(spark, write_wide(os.path.join(workdir, "in2"), [line("A B", prices="1e13")]),
                        out_dir=os.path.join(workdir, "out2"))
        with pytest.raises(PySparkException, match="price not exact"):
            A.q03_totals_by_customer(big.model()).collect()
        with pytest.raises(PySparkException, match="quantity not exact"):
            spark.createDataFrame([(1.5,)], "q double").select(money.whole("q")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", saved)


def test_a_run_leaves_no_scratch_and_no_table(spark, workdir):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    runs = lambda: sorted(os.path.basename(p) for p in glob.glob(f"{shared}/**/run-*", recursive=True))
    before = runs()
    normalize(spark, write_wide(os.path.join(workdir, "in"), [line("A B")]), out_dir=os.path.join(workdir, "out"))
    with pytest.raises(PySparkException):
        normalize(spark, write_wide(os.path.join(workdir, "in2"), [line("A B", qtys="x")]),
                  out_dir=os.path.join(workdir, "out2"))
    assert runs() == before
    assert not spark.catalog.listTables()
