"""Hot keys: those that hold more than a fixed share of all rows.

At most ``1 / share`` keys can each hold more than ``share`` of the rows,
so the table of hot keys has a proven size bound and may be broadcast,
whatever the input's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this share of the rows is hot; so there are 1,000 hot keys at most.
HOT_SHARE = 0.001
#: Fewer rows than this need no salt at any share.
HOT_ROWS = 1_000


def hot_keys(groups: DataFrame, rows: int, count: str = "n_rows") -> DataFrame:
    """Of ``groups`` (one row per key with its row count) the hot keys, each
    with ``n_salts``, over which its rows shall be spread."""
    least = max(HOT_ROWS, int(rows * HOT_SHARE))
    return (groups.filter(F.col(count) > least)
            .withColumn("n_salts", F.ceil(F.col(count) / F.lit(least)).cast("int")))
