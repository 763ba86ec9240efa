"""Send this package to the executors, which import its functions in their Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once for each application; Spark serves the archive to executors that come later, too."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    fd, archive = tempfile.mkstemp(prefix="orderlens-", suffix=".zip")
    with os.fdopen(fd, "wb") as out, zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _sent.add(context.applicationId)
