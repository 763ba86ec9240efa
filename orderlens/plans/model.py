"""The logical retail model the analytics queries run against.

Six logical tables with the reference schema::

    Region(RegionID, Region)
    Country(CountryID, Country, RegionID)
    Customer(CustomerID, FirstName, LastName, Name, CountryID, ...)
    ProductCategory(ProductCategoryID, ProductCategory, ...)
    Product(ProductID, ProductName, ProductUnitPrice decimal(18,6), ...)
    OrderDetail(CustomerID, ProductID, OrderDate, QuantityOrdered)

``OrderDetail`` is held in two parts so that work can be aggregated
before the expensive join: ``lines`` (one row per order line, keyed by a
basket ``OrderKey``) and ``baskets`` (``OrderKey -> CustomerID,
OrderDate``).  All lines of a basket share customer and date, so any
additive measure can be summed per basket first (partial + final hash
aggregate, shuffling one row per basket instead of one per line) and
only then joined to the baskets.  When ``baskets`` is ``None`` the lines
already carry ``CustomerID`` and ``OrderDate`` (the normalised tables).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import money


@dataclass(frozen=True)
class RetailModel:
    region: DataFrame
    country: DataFrame
    customer: DataFrame
    product: DataFrame
    lines: DataFrame
    baskets: DataFrame | None = None
    product_category: DataFrame | None = None
    #: What lines and baskets are joined by (see ``layout``, where orders may have parts).
    basket_keys: tuple[str, ...] = ("OrderKey",)

    # ------------------------------------------------------------------
    # OrderDetail views
    # ------------------------------------------------------------------
    def order_detail(self) -> DataFrame:
        """Row-level OrderDetail: CustomerID, ProductID, OrderDate,
        QuantityOrdered (one row per order line)."""
        cols = ["CustomerID", "ProductID", "OrderDate", "QuantityOrdered"]
        if self.baskets is None:
            return self.lines.select(*cols)
        return self.lines.join(self.baskets, list(self.basket_keys)).select(*cols)

    def priced_lines(self) -> DataFrame:
        """Lines joined to Product with the exact line total.

        Product grows with the data, so no broadcast is forced: the
        planner broadcasts it only under ``autoBroadcastJoinThreshold``
        (AQE re-checks the real size at run time) and sort-merges beyond.
        Lines that carry their price (see ``layout``) need no join.
        """
        if "LinePrice" in self.lines.columns:
            priced, price = self.lines.filter("HasProduct"), F.col("LinePrice")
        else:
            prod = self.product.select("ProductID", "ProductName", "ProductUnitPrice")
            priced, price = self.lines.join(prod, "ProductID"), F.col("ProductUnitPrice")
        return priced.withColumn("LineTotal", money.line_total(price, F.col("QuantityOrdered")))

    def basket_sums(self, priced: bool = True, **measures: Column) -> DataFrame:
        """Per-basket sums of line-level measures, with the basket's
        CustomerID and OrderDate: ``(CustomerID, OrderDate, <measures>)``.

        ``measures`` are expressions over the (priced) line columns, e.g.
        ``total=F.col("LineTotal")``.  Lines are aggregated by OrderKey
        before joining the baskets (eager aggregation).
        """
        src = self.priced_lines() if priced else self.lines
        if self.baskets is None:
            return src.select("CustomerID", "OrderDate",
                              *[e.alias(k) for k, e in measures.items()])
        per_basket = src.groupBy(*self.basket_keys).agg(
            *[F.sum(e).alias(k) for k, e in measures.items()])
        return (per_basket.join(self.baskets, list(self.basket_keys))
                .select("CustomerID", "OrderDate", *measures.keys()))

    def totals(self, **period: Column) -> DataFrame:
        """``(CustomerID, <period>, total)``: line totals summed per customer and period
        (expressions over OrderDate), before any customer join.

        Where lines carry their customer, quantities are summed per product first, as a
        product has one price: the product join then sees one row per customer, period and
        product."""
        keys = [e.alias(k) for k, e in period.items()]
        if self.baskets is None:
            sums = (self.lines.groupBy("CustomerID", *keys, "ProductID")
                    .agg(F.sum("QuantityOrdered").alias("q")))
            prod = self.product.select("ProductID", "ProductUnitPrice")
            total = money.line_total(F.col("ProductUnitPrice"), F.col("q"))
            return (sums.join(prod, "ProductID").groupBy("CustomerID", *period)
                    .agg(F.sum(total).alias("total")))
        return (self.basket_sums(total=F.col("LineTotal")).groupBy("CustomerID", *keys)
                .agg(F.sum("total").alias("total")))

    def customer_geo(self) -> DataFrame:
        """Customer -> Country -> Region (inner joins, as in the queries)."""
        return (self.customer.select("CustomerID", "CountryID")
                .join(self.country.select("CountryID", "Country", "RegionID"), "CountryID")
                .join(self.region.select("RegionID", "Region"), "RegionID"))
