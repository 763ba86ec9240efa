"""Adapter: driver star schema (TPC-H-like Parquet) -> logical retail model.

Mapping (one logical table per driver table, no data copied)::

    Region          <- region(r_regionkey, r_name)
    Country         <- nation(n_nationkey, n_name, n_regionkey)
    Customer        <- customer(c_custkey, c_name, c_nationkey); Name = c_name
    ProductCategory <- part.p_type (category) ; description 'Parts of type <t>'
    Product         <- part(p_partkey, p_name, p_retailprice, p_type)
    OrderDetail     <- lineitem (lines: l_orderkey, l_partkey, l_quantity)
                       + orders (baskets: o_orderkey, o_custkey, o_orderdate)

Only the needed columns are selected so Parquet scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import money, text
from orderlens.plans.model import RetailModel

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def star_model(spark: SparkSession, sf_dir: str) -> RetailModel:
    """The logical model over one star-schema folder (lazy relations)."""
    t = lambda n: read_table(spark, sf_dir, n)

    region = t("region").select(
        F.col("r_regionkey").cast("bigint").alias("RegionID"),
        F.col("r_name").alias("Region"))
    country = t("nation").select(
        F.col("n_nationkey").cast("bigint").alias("CountryID"),
        F.col("n_name").alias("Country"),
        F.col("n_regionkey").cast("bigint").alias("RegionID"))
    name = F.col("c_name")
    customer = t("customer").select(
        F.col("c_custkey").cast("bigint").alias("CustomerID"),
        text.first_token(name).alias("FirstName"),
        text.rest_tokens(name).alias("LastName"),
        name.alias("Name"),
        F.col("c_nationkey").cast("bigint").alias("CountryID"))
    product = t("part").select(
        F.col("p_partkey").cast("bigint").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        money.as_price(F.col("p_retailprice")).alias("ProductUnitPrice"),
        F.col("p_type").alias("ProductCategory"))
    lines = t("lineitem").select(
        F.col("l_orderkey").alias("OrderKey"),
        F.col("l_partkey").cast("bigint").alias("ProductID"),
        money.whole("l_quantity").alias("QuantityOrdered"))
    baskets = t("orders").select(
        F.col("o_orderkey").alias("OrderKey"),
        F.col("o_custkey").cast("bigint").alias("CustomerID"),
        F.to_date(F.col("o_orderdate")).alias("OrderDate"))
    return RetailModel(region=region, country=country, customer=customer,
                       product=product, lines=lines, baskets=baskets)
