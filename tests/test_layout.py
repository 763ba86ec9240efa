"""Lines and baskets laid out by order: results, plans, hot orders, odd rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from orderlens.plans import analytics as A
from orderlens.plans.layout import hot_orders, write_layout
from orderlens.plans.model import RetailModel
from orderlens.sources.star import star_model

from .conftest import SF_SMALL
from .test_plans import plan_text

QUERIES = [*A.ALL_QUERIES.values(), lambda m: A.q01_customer_orders(m, "Customer#000000001"),
           lambda m: A.q02_customer_total(m, "Customer#000000001")]


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def star(spark):
    return star_model(spark, SF_SMALL)


@pytest.mark.parametrize("least, share", [(100_000, 0.001), (3, 0.0)])
def test_every_query_gives_the_same_rows(star, least, share):
    layout = write_layout(star, buckets=3, least=least, share=share)
    model = layout.model()
    parts = model.lines.agg(F.max("Part")).first()[0]
    assert parts == 0 if least > 100 else parts > 0
    for query in QUERIES:
        assert rows(query(model)) == rows(query(star))
    layout.delete()


def test_lines_and_baskets_do_not_move(spark, star):
    layout = write_layout(star, buckets=3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for priced in (True, False):
            measure = F.col("LineTotal") if priced else F.lit(1)
            text = plan_text(layout.model().basket_sums(priced=priced, total=measure))
            assert "SortMergeJoin" in text and "Exchange" not in text
            assert "Exchange" in plan_text(star.basket_sums(priced=priced, total=measure))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    layout.delete()


def odd_model(spark, lines, baskets):
    day = datetime.date(2020, 1, 2)
    return RetailModel(
        region=spark.createDataFrame([(1, "R")], "RegionID long, Region string"),
        country=spark.createDataFrame([(1, "C", 1)], "CountryID long, Country string, RegionID long"),
        customer=spark.createDataFrame([(1, "A", "B", "A B", 1)], "CustomerID long, FirstName string, "
                                       "LastName string, Name string, CountryID long"),
        product=spark.createDataFrame([(1, "P", 2), (2, "Q", None)], "ProductID long, ProductName string, p int")
        .select("ProductID", "ProductName", F.col("p").cast("decimal(18,6)").alias("ProductUnitPrice")),
        lines=spark.createDataFrame(lines, "OrderKey long, ProductID long, QuantityOrdered long"),
        baskets=spark.createDataFrame([(o, c, day) for o, c in baskets],
                                      "OrderKey long, CustomerID long, OrderDate date"))


def test_a_hot_order_is_divided_and_odd_rows_keep_their_meaning(spark):
    lines = [(7, 1, 1)] * 900 + [(8, 2, 5), (9, 99, 1), (None, 1, 1), (8, None, 1), (8, 1, None), (5, 1, 1)]
    model = odd_model(spark, lines, [(7, 1), (8, 1), (8, 1), (9, 1), (None, 1)])
    assert [tuple(r) for r in hot_orders(model.lines, 100, 0.01).collect()] == [(7, 9)]
    layout = write_layout(model, buckets=4, least=100, share=0.01)
    own = layout.model()
    counts = own.lines.filter("OrderKey = 7").groupBy("Part").count().collect()
    assert len(counts) == 9 and max(r["count"] for r in counts) <= 110
    for priced, measure in ((True, F.col("LineTotal")), (False, F.lit(1))):
        def per_day(m, priced=priced, measure=measure):
            return rows(m.basket_sums(priced=priced, t=measure).groupBy("CustomerID", "OrderDate").agg(F.sum("t")))
        assert per_day(own) == per_day(model)
    assert own.lines.count() == len(lines)
    layout.delete()


def test_empty_tables(spark):
    layout = write_layout(odd_model(spark, [], []), buckets=2)
    assert layout.model().lines.count() == 0 and layout.model().basket_sums(t=F.col("LineTotal")).count() == 0
    layout.delete()


def test_reading_a_layout_leaves_no_table(spark):
    layout = write_layout(odd_model(spark, [(7, 1, 1)], [(7, 1)]), buckets=2)
    model = layout.model()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("orderlens_")]
    assert rows(model.basket_sums(t=F.col("QuantityOrdered")).select("CustomerID", "t")) == [(1, 1)]
    layout.delete()
