"""OrderDetail builder (normalisation step 11).

Per line: look the raw name up (unknown -> the whole line is dropped);
for every entry of a matched line parse the quantity (strict mode fails
on a bad one anywhere in the line, as the reference parses them all
before looking at products); entries are driven by the product list:
look the product up (unknown -> dropped), take the date and quantity at
the same position and parse the ``yyyyMMdd`` date.  Entries whose date
or quantity is missing (lists shorter than the product list) go to the
reject table; positions beyond the product list are ignored.

OrderID is dense 1..n in file order over the surviving rows.  The flagged
entries are written once, so the ids and the reject table read the same rows and
a lost executor cannot change them in between; ``dense_ids`` then splits the
survivors by ranges of (line, position), which divides a long line, too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import dates
from orderlens.operators.keys import dense_ids
from orderlens.operators.lookup import lenient_join, missing_keys
from orderlens.session import Scratch
from orderlens.sources.wide import ORDER_KEY, explode_parts, list_parts

#: The lists that a row of OrderDetail is made of.
_LISTS = ("ProductName", "QuantityOrdered", "OrderDate")


@dataclass(frozen=True)
class FactResult:
    order_detail: DataFrame
    rejects: DataFrame


def order_detail_table(lines: DataFrame, entries: DataFrame, customers: DataFrame,
                       products: DataFrame, scratch: Scratch, strict: bool = True) -> FactResult:
    """N11.  ``lines``: staged wide lines; ``customers`` = N6 lookup (Name, CustomerID);
    ``products`` = N10 lookup (ProductName, ProductID).

    A line meets its customer while it is a row of packed lists, and those three lists are split
    behind that join: joined afterwards, every entry would be shuffled by its line.  So the
    staged ``entries``, which other builders read, are not needed here."""
    parts = list_parts(lines, ["Name"], _LISTS).withColumnRenamed("Name", "RawName")
    owned = lenient_join(parts, "RawName", customers, "Name", "CustomerID")
    ents = explode_parts(owned, ["CustomerID"], _LISTS).select(
        *ORDER_KEY, "pos", "CustomerID", F.col("ProductName").alias("Product"),
        F.col("QuantityOrdered").alias("QtyText"), F.col("OrderDate").alias("DateText"))
    lk = products.withColumnRenamed("ProductName", "__pn")
    # Behind the product join only unknown names are carried on, not every entry's.
    known = (ents.join(lk, F.col("Product") == F.col("__pn"), "left")
             .select(*ORDER_KEY, "pos", "CustomerID", "ProductID", "QtyText", "DateText",
                     F.col("Product").isNotNull().alias("listed"),
                     F.when(F.col("ProductID").isNull(), F.col("Product")).alias("Unknown")))

    qty = (F.col("QtyText").cast("bigint") if strict
           else F.expr("try_cast(QtyText AS bigint)"))
    date = F.when(F.col("ProductID").isNotNull(),
                  dates.parse_compact_date(F.col("DateText"), strict))
    # The quantity test comes first so every quantity of a matched line is
    # parsed (strict mode raises on a bad one, even beyond the products).
    status = (F.when(qty.isNull() & F.col("listed"), F.lit("missing or bad quantity"))
              .when(~F.col("listed"), F.lit("extra"))
              .when(F.col("ProductID").isNull(),
                    F.concat(F.lit("unknown product: "), F.col("Unknown")))
              .when(date.isNull(), F.lit("missing or bad date"))
              .otherwise(F.lit("ok")))
    flagged = scratch.pin(known.select(*ORDER_KEY, "pos", "CustomerID", "ProductID",
                                       date.alias("OrderDate"), qty.alias("QuantityOrdered"),
                                       status.alias("status")), "order_entries")
    good = flagged.filter(F.col("status") == "ok").drop("status")
    order_detail = dense_ids(good, [*ORDER_KEY, "pos"], "OrderID", scratch).select(
        "OrderID", "CustomerID", "ProductID", "OrderDate", "QuantityOrdered")

    unknown_customer = missing_keys(lines.filter(F.col("ok")), "Name", customers, "Name").select(
        *ORDER_KEY, F.lit(-1).cast("int").alias("pos"),
        F.concat(F.lit("unknown customer: "), F.col("Name")).alias("reason"))
    entry_rejects = flagged.filter(~F.col("status").isin("ok", "extra")).select(
        *ORDER_KEY, "pos", F.col("status").alias("reason"))
    return FactResult(order_detail=order_detail,
                      rejects=unknown_customer.unionByName(entry_rejects))
