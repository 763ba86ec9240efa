"""Pack the driver star schema into the wide text format, one line per order.

This produces the input the normalisation job expects, from the given
tables, so the round trip (pack -> normalise -> compare with the star
schema) can be checked against DuckDB.  Lines come in ``o_orderkey`` order,
list entries in ``(l_linenumber, l_partkey, l_quantity)`` order.  A line
repeats its customer's name, so a customer is never gathered into one
row, and the last-id-wins rule decides whose orders they are.

Fixed value rules of the fixture (not reference values)::

    Name                       replace(c_name, '#', ' ');
                               c_custkey % 11 = 4: replace(c_name, '#', '  ')   doubled blank
                               c_custkey % 11 = 6: replace(c_name, '#', '-')    one token
    Address                    c_mktsegment || ', ' || c_custkey
    City                       'City ' || c_nationkey
    Country                    n_name
    Region                     r_name; o_orderkey % 13 = 5: 'Elsewhere'         two regions
    ProductName                p_name || ' ' || lpad(p_partkey, 8, '0')
    ProductCategory            p_type
    ProductCategoryDescription 'Parts of type ' || p_type
    ProductUnitPrice           p_retailprice as decimal(12,2) text;
                               o_orderkey % 17 = 3: 1 more                      two prices
    QuantityOrdered            l_quantity as whole number text
    OrderDate                  date_format(o_orderdate, 'yyyyMMdd')

Uneven lists, in orders of two entries or more::

    o_orderkey % 23 = 9        the last price is missing
    o_orderkey % 29 = 11       the last date is missing
    o_orderkey % 31 = 3        one more quantity, 7

and a line of white space only behind the line of each order with o_orderkey % 19 = 7.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.functions import money
from orderlens.session import scratch_path
from orderlens.sources.star import read_table
from orderlens.sources.wide import LIST_FIELDS, SCALAR_FIELDS

HEADER = SCALAR_FIELDS + LIST_FIELDS
INPUTS = ("region", "nation", "customer", "part", "orders", "lineitem")

#: Rows that come sorted by the grouping keys are aggregated one group at a time; else listagg holds, sorts
#: and spills the lists of all groups.
SORTED_GROUPS = "spark.sql.execution.replaceHashWithSortAgg"

#: The value that an entry has in each list.
_VALUES = {
    "ProductName": lambda: F.when(F.col("entry"), F.concat_ws(
        " ", "p_name", F.lpad(F.col("l_partkey").cast("string"), 8, "0"))),
    "ProductCategory": lambda: F.col("p_type"),
    "ProductCategoryDescription": lambda: F.concat(F.lit("Parts of type "), F.col("p_type")),
    "ProductUnitPrice": lambda: (F.col("p_retailprice").cast("decimal(12,2)")
                                 + F.when(F.col("o_orderkey") % 17 == 3, 1).otherwise(0))
    .cast("decimal(12,2)").cast("string"),
    "QuantityOrdered": lambda: money.whole("l_quantity").cast("string"),
    "OrderDate": lambda: F.date_format("o_orderdate", "yyyyMMdd")}


def packed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed lines, in ranges of ``o_orderkey``.

    The entries, joined while they are a few numbers, and one row per order with the customer's
    texts are dealt to the ranges in one shuffle.  An order is put together and sorted there, so
    no packed text is shuffled, and the lists are built once."""
    t = lambda n: read_table(spark, sf_dir, n)
    li = t("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    od = t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    pt = t("part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    cust = (t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
            .join(t("nation").select("n_nationkey", "n_name", "n_regionkey"),
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t("region").select("r_regionkey", "r_name"),
                  F.col("n_regionkey") == F.col("r_regionkey")))
    texts = ["c_name", "c_nationkey", "c_mktsegment", "n_name", "r_name"]
    # Rows that repeat a c_custkey are owners of their own, and each has a line.
    cust = cust.withColumn("c_row", F.row_number().over(Window.partitionBy("c_custkey").orderBy(*texts)))
    owned = od.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    entries = (li.join(owned.select("o_orderkey", "o_custkey", "c_row", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
               .join(pt, F.col("l_partkey") == F.col("p_partkey"))
               .select("o_orderkey", "o_custkey", "c_row", F.lit(True).alias("entry"), "l_linenumber", "l_partkey",
                       "l_quantity", "p_name", "p_type", "p_retailprice", "o_orderdate"))
    heads = owned.filter(F.col("o_orderkey").isNotNull()).select(
        "o_orderkey", "o_custkey", "c_row", F.struct(*texts).alias("who"))
    # Sorted while rows are small: the lists are then made group by group (see SORTED_GROUPS).
    rows = (entries.unionByName(heads, allowMissingColumns=True).repartitionByRange("o_orderkey")
            .withColumn("owner", F.struct("o_custkey", "c_row")).sortWithinPartitions("o_orderkey", "owner"))
    # An order has a handful of lines, whatever the size of the data.
    lists = [F.expr(f"listagg({f}, ';') WITHIN GROUP (ORDER BY place)").alias(f) for f in _VALUES]
    orders = (rows.select("o_orderkey", "owner", "entry", "who",
                          F.struct("l_linenumber", "l_partkey", "l_quantity").alias("place"),
                          *[v().alias(f) for f, v in _VALUES.items()])
              .groupBy("o_orderkey", "owner")
              .agg(*lists, F.count("entry").alias("n"), F.any_value("who", True).alias("who"))
              .filter(F.col("n") > 0))
    uneven = lambda c, m, r, to: F.when((F.col("n") > 1) & (F.col("o_orderkey") % m == r), to).otherwise(c)
    short = lambda c: F.regexp_replace(c, ";[^;]*$", "")
    orders = orders.withColumns({
        "ProductUnitPrice": uneven(F.col("ProductUnitPrice"), 23, 9, short("ProductUnitPrice")),
        "OrderDate": uneven(F.col("OrderDate"), 29, 11, short("OrderDate")),
        "QuantityOrdered": uneven(F.col("QuantityOrdered"), 31, 3, F.concat("QuantityOrdered", F.lit(";7")))})
    custkey = F.col("owner.o_custkey")
    odd = custkey % 11
    blank = F.when(odd == 4, "  ").when(odd == 6, "-").otherwise(" ")
    return orders.select(
        "o_orderkey",
        F.replace(F.col("who.c_name"), F.lit("#"), blank).alias("Name"),
        F.concat(F.col("who.c_mktsegment"), F.lit(", "), custkey.cast("string"))
        .alias("Address"),
        F.concat(F.lit("City "), F.col("who.c_nationkey").cast("string")).alias("City"),
        F.col("who.n_name").alias("Country"),
        F.when(F.col("o_orderkey") % 13 == 5, "Elsewhere").otherwise(F.col("who.r_name")).alias("Region"),
        *LIST_FIELDS)


def write_wide_fixture(spark: SparkSession, sf_dir: str, out: str | None = None) -> str:
    """Write the packed lines as tab-separated gzip text files, each with a
    header line, in ``o_orderkey`` order across and within files."""
    path = out or scratch_path(spark, "wide_fixture")
    # Empty fields make a line of tabs, which is a blank line.
    blank = F.when(F.col("o_orderkey") % 19 == 7, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    lines = packed_lines(spark, sf_dir).withColumn("blank", F.explode(blank))
    # The lines come in ranges of orders, so sorting inside them is enough.
    sorted_lines = lines.sortWithinPartitions("o_orderkey", "blank").select(
        *[F.when(F.col("blank"), F.lit("")).otherwise(F.col(c)).alias(c) for c in HEADER])
    before = spark.conf.get(SORTED_GROUPS)
    spark.conf.set(SORTED_GROUPS, "true")
    try:
        (sorted_lines.write.mode("overwrite")
         .option("sep", "\t").option("header", True).option("compression", "gzip")
         .option("quoteAll", False).option("escapeQuotes", False)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .option("emptyValue", "").option("nullValue", "")
         .csv(path))
    finally:
        spark.conf.set(SORTED_GROUPS, before)
    return path
