"""Versions of a set of tables that are published together, or not at all.

A run writes its tables to a folder of its own below ``<root>/_versions``; nobody
reads it there.  When all are written, one manifest that names the folder and
its tables is renamed into ``<root>/_manifests``: a single step of the file system,
refused if that number is taken.  Readers resolve the manifest with the highest number
(or an earlier one), so they see all tables of one run.  A run that fails
publishes nothing and deletes its folder; the tables of the last good run stay.

Manifests are JSON: ``{"folder": ..., "tables": {name: {"rows": n}}}``; rows are
counted while the table is written.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlens.session import delete_path


@dataclass(frozen=True)
class Manifest:
    number: int
    folder: str
    rows: dict[str, int]

    def path(self, table: str) -> str:
        if table not in self.rows:
            raise KeyError(f"version {self.number} has no table {table}")
        return f"{self.folder}/{table}"


class Snapshots:
    """The published versions below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)
        self.root = self._fs.makeQualified(self._path("")).toString()

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def numbers(self) -> list[int]:
        """Published versions, oldest first."""
        folder = self._path("_manifests")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, number: int | None = None) -> Manifest:
        """A version's manifest, by default the last one's."""
        found = self.numbers()
        if not found or (number is not None and number not in found):
            raise FileNotFoundError(f"no published version{'' if number is None else f' {number}'} in {self.root}")
        number = found[-1] if number is None else number
        stream = self._fs.open(self._path(f"_manifests/{number:012d}.json"))
        try:
            data = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Manifest(number, f"{self.root}/{data['folder']}", {t: x["rows"] for t, x in data["tables"].items()})

    def write(self) -> Version:
        """A version to write::

            with snapshots.write() as version:
                version.save(df, "Region")
        """
        return Version(self)

    def publish(self, folder: str, rows: dict[str, int]) -> int:
        """Publish a folder's tables as the next version; returns its number.  Of two runs that
        publish at once both get a number, the later one the higher."""
        text = json.dumps({"folder": folder, "tables": {t: {"rows": n} for t, n in sorted(rows.items())}})
        draft = self._path(f"_manifests/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        no_option = self.spark.sparkContext._gateway.new_array(
            getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        while True:
            number = (self.numbers() or [0])[-1] + 1
            try:
                files.rename(draft, self._path(f"_manifests/{number:012d}.json"), no_option)
                return number
            except Py4JJavaError as e:
                if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                    raise

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete all but the last ``keep`` versions (one at least), manifests first; returns their numbers.
        Folders of runs that have not published are left alone."""
        old = self.numbers()[:-max(keep, 1)]
        for number in old:
            folder = self.manifest(number).folder
            delete_path(self.spark, f"{self.root}/_manifests/{number:012d}.json")
            delete_path(self.spark, folder)
        return old


class Version:
    """The tables of one run; published when its block ends, deleted when it fails."""

    def __init__(self, snapshots: Snapshots):
        self.snapshots = snapshots
        self.folder = f"_versions/{uuid.uuid4().hex}"
        self.rows: dict[str, int] = {}
        self.number: int | None = None

    def path(self, table: str) -> str:
        return f"{self.snapshots.root}/{self.folder}/{table}"

    def save(self, df: DataFrame, table: str) -> DataFrame:
        """Write a table of this version and return it read back."""
        counted = Observation(f"{table}-{uuid.uuid4().hex[:8]}")
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(self.path(table))
        self.rows[table] = counted.get["rows"]
        return df.sparkSession.read.schema(df.schema).parquet(self.path(table))

    def __enter__(self) -> Version:
        return self

    def __exit__(self, failure: type | None, *rest: object) -> None:
        if failure is None:
            self.number = self.snapshots.publish(self.folder, self.rows)
        else:
            delete_path(self.snapshots.spark, f"{self.snapshots.root}/{self.folder}")
