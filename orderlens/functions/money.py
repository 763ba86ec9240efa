"""Money arithmetic: exact decimals inside, double at the edge.

Unit prices are held as ``decimal(18,6)`` and quantities as
``decimal(19,0)``, so a line total (``decimal(38,6)``), its sums and its
rounding are exact and agree across engines; ``to_double`` converts only
the final value.  A price or quantity that these types cannot hold
exactly fails the query, whatever the ANSI setting: nothing is rounded
on the way in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE_TYPE = "decimal(18,6)"
QTY_TYPE = "decimal(19,0)"


def _exact(c: Column | str, kind: str, what: str) -> Column:
    """``c`` as ``kind``; an error where the value does not survive the cast."""
    c = F.col(c) if isinstance(c, str) else c
    exact = c.try_cast(kind)
    lost = c.isNotNull() & (exact.isNull() | (exact.cast("double") != c.cast("double")))
    return F.when(lost, F.raise_error(F.concat(F.lit(f"{what} not exact: "), c.cast("string")))
                  .cast(kind)).otherwise(exact)


def as_price(c: Column | str) -> Column:
    return _exact(c, PRICE_TYPE, "price")


def as_qty(c: Column | str) -> Column:
    return _exact(c, QTY_TYPE, "quantity")


def whole(c: Column | str) -> Column:
    """A quantity as bigint; a fraction fails instead of being cut off."""
    return _exact(c, "bigint", "quantity")


def line_total(price: Column, qty: Column) -> Column:
    """price x quantity, exact, for a price from ``as_price`` and a whole quantity."""
    return price.cast(PRICE_TYPE) * qty.cast(QTY_TYPE)


def round_to_double(c: Column, digits: int) -> Column:
    """ROUND(x, digits) (half away from zero on decimals), then double."""
    return F.round(c, digits).cast("double")


def to_double(c: Column) -> Column:
    return c.cast("double")
