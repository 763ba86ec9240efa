"""Dimension builders (normalisation steps 1-10) over parsed wide lines.

Input: the parsed lines of ``sources.wide`` (only ``ok`` lines are used).
Every builder is a handful of DataFrame operations: distinct / first-wins
aggregation (partial + final, so hot values collapse map-side), a lookup
join, and ``dense_ids`` for the 1..n key in the reference's sort order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import text
from orderlens.operators.keys import dense_ids
from orderlens.operators.lookup import lookup_map, strict_join
from orderlens.session import Scratch
from orderlens.sources.wide import ORDER_KEY, packed_entry_order, packed_line_order


def _ok(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("ok"))


# -- Region ------------------------------------------------------------

def region_table(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """N1: distinct Region values, sorted, RegionID = 1..n."""
    regions = _ok(lines).select("Region").distinct()
    return dense_ids(regions, ["Region"], "RegionID", scratch).select(
        "RegionID", "Region")


def region_lookup(region: DataFrame) -> DataFrame:
    """N2: Region -> RegionID."""
    return lookup_map(region, "Region", "RegionID", key_name="Region")


# -- Country -----------------------------------------------------------

def country_table(lines: DataFrame, regions: DataFrame, scratch: Scratch) -> DataFrame:
    """N3: each country takes the region of its FIRST line; sorted by
    country; RegionID through the strict region lookup."""
    # (country, region) pairs first: a hash aggregate over all lines; the
    # first-wins pick then runs on the small pairs table.
    pairs = (_ok(lines).groupBy("Country", "Region")
             .agg(F.min(packed_line_order()).alias("__o")))
    first = pairs.groupBy("Country").agg(F.min_by("Region", "__o").alias("RegionName"))
    linked = strict_join(first, "RegionName", region_lookup(regions), "Region",
                         "RegionID", "region")
    return dense_ids(linked, ["Country"], "CountryID", scratch).select(
        "CountryID", "Country", "RegionID")


def country_lookup(country: DataFrame) -> DataFrame:
    """N4: Country -> CountryID."""
    return lookup_map(country, "Country", "CountryID", key_name="Country")


# -- Customer ----------------------------------------------------------

def customer_table(lines: DataFrame, countries: DataFrame, scratch: Scratch) -> DataFrame:
    """N5: one customer per line (no de-duplication).  Name split into the
    first token and the rest; sorted by (FirstName, LastName) with file
    order breaking ties (Python's stable sort)."""
    name = F.col("Name")
    cust = _ok(lines).select(
        "file_idx", "block_start", "line_seq",
        text.first_token(name).alias("FirstName"),
        text.rest_tokens(name).alias("LastName"),
        "Address", "City", F.col("Country").alias("CountryName"))
    linked = strict_join(cust, "CountryName", country_lookup(countries), "Country",
                         "CountryID", "country")
    ided = dense_ids(linked, ["FirstName", "LastName", "file_idx", "block_start", "line_seq"],
                     "CustomerID", scratch)
    return ided.select("CustomerID", "FirstName", "LastName", "Address", "City", "CountryID")


def customer_lookup(customer: DataFrame) -> DataFrame:
    """N6: 'FirstName LastName' -> CustomerID, last id wins."""
    return lookup_map(customer, text.full_name(F.col("FirstName"), F.col("LastName")),
                      "CustomerID", key_name="Name")


# -- ProductCategory ---------------------------------------------------

def product_category_table(entries: DataFrame, scratch: Scratch) -> DataFrame:
    """N7: (category, description) pairs linked by list position; the
    first pair (file order, then position) of each category; sorted by
    category, ProductCategoryID = 1..n.  ``entries``: see
    ``sources.wide.explode_entries``."""
    pairs = (entries
             .filter(F.col("ProductCategory").isNotNull()
                     & F.col("ProductCategoryDescription").isNotNull())
             .groupBy("ProductCategory", "ProductCategoryDescription")
             .agg(F.min(packed_entry_order()).alias("__o")))
    first = pairs.groupBy("ProductCategory").agg(
        F.min_by("ProductCategoryDescription", "__o").alias("ProductCategoryDescription"))
    return dense_ids(first, ["ProductCategory"], "ProductCategoryID", scratch).select(
        "ProductCategoryID", "ProductCategory", "ProductCategoryDescription")


def product_category_lookup(category: DataFrame) -> DataFrame:
    """N8: ProductCategory -> ProductCategoryID."""
    return lookup_map(category, "ProductCategory", "ProductCategoryID",
                      key_name="ProductCategory")


# -- Product -----------------------------------------------------------

def _triples(entries: DataFrame) -> DataFrame:
    return entries.filter(F.col("pos") < F.col("n_triples"))


def price_rejects(entries: DataFrame) -> DataFrame:
    """Lenient mode: a reject row for every entry whose price is no number."""
    bad = F.expr("try_cast(ProductUnitPrice AS double)").isNull()
    return _triples(entries).filter(bad).select(
        *ORDER_KEY, "pos", F.concat(F.lit("bad price: "), F.col("ProductUnitPrice"),
                                    F.lit(" of "), F.col("ProductName")).alias("reason"))


def product_table(entries: DataFrame, categories: DataFrame, scratch: Scratch,
                  strict: bool = True) -> DataFrame:
    """N9: positional zip of (name, category, price text), shortest list
    wins; distinct triples on the RAW price text; stable sort by name
    (first occurrence breaks ties); price -> double; category -> id."""
    triples = (_triples(entries)
               .select(F.col("ProductName"), F.col("ProductCategory").alias("CategoryName"),
                       F.col("ProductUnitPrice").alias("PriceText"),
                       packed_entry_order().alias("__o")))
    distinct = (triples.groupBy("ProductName", "CategoryName", "PriceText")
                .agg(F.min("__o").alias("__first")))
    linked = strict_join(distinct, "CategoryName", product_category_lookup(categories),
                         "ProductCategory", "ProductCategoryID", "product category")
    if strict:
        priced = linked.withColumn("ProductUnitPrice", F.col("PriceText").cast("double"))
    else:
        priced = (linked.withColumn("ProductUnitPrice", F.expr("try_cast(PriceText AS double)"))
                  .filter(F.col("ProductUnitPrice").isNotNull()))
    ided = dense_ids(priced, ["ProductName", "__first"], "ProductID", scratch)
    return ided.select("ProductID", "ProductName", "ProductUnitPrice", "ProductCategoryID")


def product_lookup(product: DataFrame) -> DataFrame:
    """N10: ProductName -> ProductID, last id wins."""
    return lookup_map(product, "ProductName", "ProductID", key_name="ProductName")
