"""Name -> surrogate-key lookups and the two join policies.

* ``lookup_map``: natural key -> id with *last id wins* on duplicate keys
  (the reference builds a dict by iterating rows in id order).
* ``strict_join`` (J4): a missing key is an error.  The check is lazy and
  in-line: a left join plus ``raise_error`` when the id is NULL, so there
  is no extra pass and nothing is collected.
* ``lenient_join`` (J5): a missing key drops the row; ``missing_keys``
  gives the dropped rows for the reject table.

No broadcast is forced: lookups such as Customer and Product grow with
the data, so the planner broadcasts them only under its size threshold
(re-checked by AQE at run time) and shuffles beyond it; AQE's skew-join
handling splits a hot key's partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_map(table: DataFrame, key: Column | str, id_col: str,
               key_name: str = "key") -> DataFrame:
    """``(key_name, id_col)`` with the largest id per key."""
    k = F.col(key) if isinstance(key, str) else key
    return table.groupBy(k.alias(key_name)).agg(F.max(id_col).alias(id_col))


def strict_join(df: DataFrame, df_key: str, lookup: DataFrame, key_name: str,
                id_col: str, what: str) -> DataFrame:
    """Attach ``id_col``; fail the job on a key missing from ``lookup``."""
    lk = lookup.withColumnRenamed(key_name, "__lk")
    joined = df.join(lk, F.col(df_key) == F.col("__lk"), "left")
    checked = F.when(F.col(id_col).isNull(),
                     F.raise_error(F.concat(F.lit(f"unknown {what}: "),
                                            F.coalesce(F.col(df_key).cast("string"),
                                                       F.lit("NULL"))))
                     ).otherwise(F.col(id_col))
    return joined.withColumn(id_col, checked.cast("bigint")).drop("__lk")


def lenient_join(df: DataFrame, df_key: str, lookup: DataFrame, key_name: str,
                 id_col: str) -> DataFrame:
    """Attach ``id_col``; rows whose key is missing are dropped."""
    lk = lookup.withColumnRenamed(key_name, "__lk")
    return df.join(lk, F.col(df_key) == F.col("__lk"), "inner").drop("__lk")


def missing_keys(df: DataFrame, df_key: str, lookup: DataFrame, key_name: str) -> DataFrame:
    """Rows of ``df`` whose key has no match (what ``lenient_join`` drops)."""
    lk = lookup.select(F.col(key_name).alias("__lk"))
    return df.join(lk, F.col(df_key) == F.col("__lk"), "left_anti")

