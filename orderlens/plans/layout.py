"""OrderDetail laid out by order: lines and baskets that join without a shuffle.

``write_layout`` writes the lines, priced once, and the baskets of a model into the
same number of buckets by (OrderKey, Part), one file for each bucket.  Sums per
basket, and the join of baskets to them, then run bucket by bucket: a query over
``Layout.model`` moves neither a line nor a basket, whatever the size of the
products, as the price stands in the line.

An order may hold a third of all lines.  Orders with more than ``HOT_SHARE`` of the
lines are divided over several parts, dealt by the line's position, and their baskets
stand in each of them; of any other order Part is 0.  Parts are summed one by one, so
only measures that add up may be asked of ``basket_sums``, which all of the queries'
are.  At most ``1 / HOT_SHARE`` orders can be hot, which bounds what is broadcast.

Defined results: a line without a product stays and says so (``HasProduct``); sums of
line totals leave it out, as the product join does.  Baskets that repeat an OrderKey
each count, as they do in the queries' joins; products have distinct ids.  A line or
basket without an OrderKey joins nothing.  Empty tables give an empty layout.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderlens.plans.model import RetailModel
from orderlens.session import delete_path, scratch_path

#: An order with more than this share of all lines is divided.
HOT_SHARE = 0.001
#: Orders with no more lines than this are never divided.
HOT_LINES = 100_000

KEYS = ("OrderKey", "Part")


def hot_orders(lines: DataFrame, least: int = HOT_LINES, share: float = HOT_SHARE) -> DataFrame:
    """``(OrderKey, parts)`` of the orders with more lines than ``least`` and than ``share`` of all."""
    counts = lines.groupBy("OrderKey").agg(F.count(F.lit(1)).alias("n"))
    limit = lines.agg((F.count(F.lit(1)) * F.lit(share)).alias("limit"))
    bound = F.greatest(F.lit(float(least)), F.lit(limit.scalar()))
    return counts.filter(F.col("n") > bound).select(
        "OrderKey", F.ceil(F.col("n") / bound).cast("int").alias("parts"))


@dataclass(frozen=True)
class Layout:
    """Bucketed tables in one folder of the shared file system."""

    spark: SparkSession
    folder: str
    buckets: int
    source: RetailModel

    def _table(self, name: str, schema: StructType) -> DataFrame:
        """The bucketed files of a folder, declared to this session's catalog until they are resolved."""
        table, keys = f"orderlens_{name}_{uuid.uuid4().hex[:12]}", ", ".join(KEYS)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({keys}) "
                       f"SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{name}'")
        rows = self.spark.table(table)
        self.spark.sql(f"DROP TABLE {table}")  # the files stay, and so do the buckets that rows knows
        return rows

    def model(self) -> RetailModel:
        """The source's model with its lines and baskets read from the layout."""
        lines, baskets = (self._table(n, rows.schema) for n, rows in _rows(self.source, None).items())
        return replace(self.source, lines=lines, baskets=baskets, basket_keys=KEYS)

    def delete(self) -> None:
        delete_path(self.spark, self.folder)


def _rows(model: RetailModel, hot: DataFrame | None) -> dict[str, DataFrame]:
    """The lines and baskets of a layout; without ``hot`` only their columns count."""
    if hot is None:
        hot = model.lines.select("OrderKey", F.lit(1).alias("parts")).limit(0)
    prices = model.product.select("ProductID", F.col("ProductUnitPrice").alias("LinePrice"),
                                  F.lit(True).alias("HasProduct"))
    lines = (model.lines.withColumn("nth", F.monotonically_increasing_id())
             .join(hot, "OrderKey", "left")
             .withColumn("Part", F.coalesce(F.expr("pmod(nth, parts)"), F.lit(0)).cast("int"))
             .join(prices, "ProductID", "left")
             .select(*KEYS, "ProductID", "QuantityOrdered", "LinePrice",
                     F.coalesce("HasProduct", F.lit(False)).alias("HasProduct")))
    baskets = (model.baskets.join(hot, "OrderKey", "left")
               .withColumn("Part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
               .select(*KEYS, "CustomerID", "OrderDate"))
    return {"lines": lines, "baskets": baskets}


def write_layout(model: RetailModel, folder: str | None = None, buckets: int | None = None,
                 least: int = HOT_LINES, share: float = HOT_SHARE) -> Layout:
    """Write the lines and baskets of ``model``, whose lines have baskets, by order."""
    spark = model.lines.sparkSession
    folder = folder or scratch_path(spark, "layout")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_orders(model.lines, least, share))
    for name, rows in _rows(model, hot).items():
        table = f"orderlens_write_{uuid.uuid4().hex[:12]}"
        (rows.repartition(buckets, *KEYS).write.format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS)
         .option("path", f"{folder}/{name}").saveAsTable(table))
        spark.sql(f"DROP TABLE {table}")  # the files stay: the table is external
    return Layout(spark, folder, buckets, model)


class Layouts:
    """Layouts that the queries of one ``queries()`` call share, one for each folder of tables."""

    def __init__(self, read: Callable[[SparkSession, str], RetailModel]):
        self._read = read
        self._made: dict[tuple, Layout] = {}

    def __call__(self, spark: SparkSession, sf_dir: str) -> RetailModel:
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        if key not in self._made:
            self._made[key] = write_layout(self._read(spark, sf_dir))
        return self._made[key].model()

    def close(self) -> None:
        for made in self._made.values():
            made.delete()
        self._made.clear()
