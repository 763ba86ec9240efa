"""orderlens: retail order normalisation and sales analytics on Spark.

Subpackages
-----------
sources    wide delimited text scan, star-schema adapter, table sinks
functions  column expressions (money, dates, text) kept JVM-side
operators  dense ids, dimension/fact builders, lookups, quality checks,
           top-k, gap and replication operators
plans      the analytics queries and the end-to-end normalisation job
"""

from orderlens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
