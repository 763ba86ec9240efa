"""The eleven sales queries over a ``RetailModel``.

Each function returns a lazy DataFrame with the reference's output
columns and order.  Totals are exact decimals until the final
round-and-cast to double.  Every sum is taken per basket, then per
customer (or period), before any dimension join, so the joins see one
row per customer instead of one per order line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import dates, money
from orderlens.operators.gaps import longest_gaps
from orderlens.operators.ranking import top_k, with_rank
from orderlens.plans.model import RetailModel


def _line():
    return F.col("LineTotal")


def _customer_id(model: RetailModel, customer_name: str):
    """Name -> CustomerID, last id wins on duplicate names, as a scalar subquery: the
    filters on it are evaluated at run time and pushed into the scans."""
    return (model.customer.filter(F.col("Name") == F.lit(customer_name))
            .agg(F.max("CustomerID")).scalar())


def _customer_rows(model: RetailModel, customer_id) -> DataFrame:
    """Order lines of one customer: ``ProductID, QuantityOrdered, CustomerID, OrderDate``."""
    if model.baskets is None:
        return model.lines.filter(F.col("CustomerID") == customer_id)
    return model.lines.join(model.baskets.filter(F.col("CustomerID") == customer_id), list(model.basket_keys))


def q01_customer_orders(model: RetailModel, customer_name: str) -> DataFrame:
    """All order lines of one customer with the line total (2 dp)."""
    cid = _customer_id(model, customer_name)
    rows = _customer_rows(model, cid)
    prod = model.product.select("ProductID", "ProductName", "ProductUnitPrice")
    who = model.customer.filter(F.col("CustomerID") == cid).select("CustomerID", "Name")
    return (rows.join(prod, "ProductID").join(who, "CustomerID")
            .select("Name", "ProductName", "OrderDate",
                    money.to_double(F.col("ProductUnitPrice")).alias("ProductUnitPrice"),
                    F.col("QuantityOrdered").cast("bigint").alias("QuantityOrdered"),
                    money.round_to_double(
                        money.line_total(F.col("ProductUnitPrice"), F.col("QuantityOrdered")),
                        2).alias("Total")))


def q02_customer_total(model: RetailModel, customer_name: str) -> DataFrame:
    """Sum of one customer's line totals, rounded to 2 dp."""
    cid = _customer_id(model, customer_name)
    priced = _customer_rows(model, cid).join(
        model.product.select("ProductID", "ProductUnitPrice"), "ProductID")
    total = money.line_total(F.col("ProductUnitPrice"), F.col("QuantityOrdered"))
    who = model.customer.filter(F.col("CustomerID") == cid).select("CustomerID", "Name")
    return (priced.groupBy("CustomerID").agg(F.sum(total).alias("total"))
            .join(who, "CustomerID")
            .select("Name", money.round_to_double(F.col("total"), 2).alias("Total")))


def q03_totals_by_customer(model: RetailModel) -> DataFrame:
    """Name, Total (2 dp) per customer, Total descending."""
    sums = model.totals()
    return (sums.join(model.customer.select("CustomerID", "Name"), "CustomerID")
            .select("Name", money.round_to_double(F.col("total"), 2).alias("Total"),
                    "CustomerID")
            .orderBy(F.col("Total").desc(), F.col("CustomerID").asc())
            .drop("CustomerID"))


def _geo_sums(model: RetailModel) -> DataFrame:
    """Per-customer exact totals with Country and Region attached."""
    return model.totals().join(model.customer_geo(), "CustomerID")


def q04_totals_by_region(model: RetailModel) -> DataFrame:
    """Region, Total (2 dp), Total descending."""
    return (_geo_sums(model).groupBy("Region").agg(F.sum("total").alias("total"))
            .select("Region", money.round_to_double(F.col("total"), 2).alias("Total"))
            .orderBy(F.col("Total").desc(), F.col("Region").asc()))


def q05_totals_by_country(model: RetailModel) -> DataFrame:
    """Country, CountryTotal (0 dp), descending."""
    return (_geo_sums(model).groupBy("Country").agg(F.sum("total").alias("total"))
            .select("Country", money.round_to_double(F.col("total"), 0).alias("CountryTotal"))
            .orderBy(F.col("CountryTotal").desc(), F.col("Country").asc()))


def _region_country_sums(model: RetailModel) -> DataFrame:
    return _geo_sums(model).groupBy("Region", "Country").agg(F.sum("total").alias("total"))


def q06_country_rank_in_region(model: RetailModel) -> DataFrame:
    """Rank countries within their region by the ROUNDED total."""
    t = _region_country_sums(model).select(
        "Region", "Country", money.round_to_double(F.col("total"), 0).alias("CountryTotal"))
    ranked = with_rank(t, ["Region"], [F.col("CountryTotal").desc()], "CountryRegionalRank")
    return ranked.orderBy("Region", "CountryRegionalRank", "Country")


def q07_top_country_per_region(model: RetailModel) -> DataFrame:
    """Rank-1 country per region, ranked by the UNROUNDED total."""
    t = _region_country_sums(model)
    best = top_k(t, ["Region"], [F.col("total").desc()], 1, "CountryRegionalRank")
    return (best.select("Region", "Country",
                        money.round_to_double(F.col("total"), 0).alias("CountryTotal"),
                        "CountryRegionalRank")
            .orderBy("Region", "Country"))


def _quarter_totals(model: RetailModel) -> DataFrame:
    d = F.col("OrderDate")
    return (model.totals(Year=dates.year_of(d), Quarter=dates.quarter_label(d))
            .select("Quarter", "Year", "CustomerID",
                    money.round_to_double(F.col("total"), 0).alias("Total")))


def q08_customer_quarter_totals(model: RetailModel) -> DataFrame:
    """Quarter, Year, CustomerID, Total (0 dp); by Year (then Quarter, id)."""
    return _quarter_totals(model).orderBy("Year", "Quarter", "CustomerID")


def q09_top5_customers_per_quarter(model: RetailModel, k: int = 5) -> DataFrame:
    """Top-k customers per (Quarter, Year) by rounded Total, ties kept."""
    best = top_k(_quarter_totals(model), ["Quarter", "Year"], [F.col("Total").desc()],
                 k, "CustomerRank")
    return best.orderBy("Year", "Quarter", "CustomerRank", "CustomerID")


def q10_month_rank(model: RetailModel) -> DataFrame:
    """Month name over all years, sum of per-line ROUNDED totals, rank.

    The global rank runs on at most 12 rows (one per month name)."""
    b = model.basket_sums(rounded=F.round(_line(), 0))
    months = (b.groupBy(dates.month_name(F.col("OrderDate")).alias("Month"))
              .agg(F.sum("rounded").alias("rounded"))
              .select("Month", money.to_double(F.col("rounded")).alias("Total")))
    return with_rank(months, [], [F.col("Total").desc()], "TotalRank").orderBy(
        "TotalRank", "Month")


def q11_longest_order_gap(model: RetailModel) -> DataFrame:
    """Per customer, the earliest occurrence of the longest gap between
    consecutive orders (see ``operators.gaps``)."""
    counts = model.basket_sums(priced=False, n=F.lit(1))
    names = (model.customer.select("CustomerID", "FirstName", "LastName", "CountryID")
             .join(model.country.select("CountryID", "Country"), "CountryID").drop("CountryID"))
    return (longest_gaps(counts.select("CustomerID", "OrderDate", "n"), names=names)
            .select("CustomerID", "FirstName", "LastName", "Country", "OrderDate",
                    "PreviousOrderDate", "MaxDaysWithoutOrder")
            .orderBy(F.col("MaxDaysWithoutOrder").desc(), F.col("CustomerID").desc()))


ALL_QUERIES = {
    "q03_totals_by_customer": q03_totals_by_customer,
    "q04_totals_by_region": q04_totals_by_region,
    "q05_totals_by_country": q05_totals_by_country,
    "q06_country_rank_in_region": q06_country_rank_in_region,
    "q07_top_country_per_region": q07_top_country_per_region,
    "q08_customer_quarter_totals": q08_customer_quarter_totals,
    "q09_top5_customers_per_quarter": q09_top5_customers_per_quarter,
    "q10_month_rank": q10_month_rank,
    "q11_longest_order_gap": q11_longest_order_gap,
}
