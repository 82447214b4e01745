"""Atomic publishing: tables are written to folders of their own and become
visible by one row in a log.

A writer fills new folders under `<root>/data` and then appends a single small
file to `<root>/published` that names them; Spark's commit renames that file into
place, so readers see either all of the new folders or none. A job that dies
before leaves folders that nothing points at. A reader resolves the
folders once and keeps reading them while a later load is written.

A publication carries the id of its batch, so a replayed batch is recognised and
changes nothing. One writer at a time is assumed per root.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "seq bigint, batch string, name string, folder string"


class Published:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.root}/published")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def folders(self) -> dict[str, str]:
        """Name -> folder of everything visible now."""
        log = self._log()
        if log is None:
            return {}
        rows = log.groupBy("name").agg(F.max_by("folder", "seq").alias("folder")).collect()
        return {r.name: f"{self.root}/data/{r.folder}" for r in rows}

    def has(self, batch: str) -> bool:
        log = self._log()
        return log is not None and not log.where(F.col("batch") == batch).isEmpty()

    def new_folder(self, name: str) -> str:
        """A folder for a table to be published: its name below `<root>/data`."""
        return f"{name}-{uuid.uuid4().hex}"

    def path(self, folder: str) -> str:
        return f"{self.root}/data/{folder}"

    def publish(self, folders: dict[str, str], batch: str) -> None:
        """Make the folders (as named by `new_folder`) visible, all at once."""
        log = self._log()
        last = None if log is None else log.agg(F.max("seq")).first()[0]
        rows = [((last or 0) + 1, batch, name, folder) for name, folder in sorted(folders.items())]
        self.spark.createDataFrame(rows, _LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/published")

    def remove_replaced(self) -> list[str]:
        """Delete folders that were published once and that nothing shows now;
        for a time when no reader holds on to an earlier load. A part of a folder
        (`folder/bucket=3`) goes alone, its neighbours stay."""
        log = self._log()
        if log is None:
            return []
        shown = {p.removeprefix(f"{self.root}/data/") for p in self.folders().values()}
        gone = sorted({r.folder for r in log.select("folder").distinct().collect()} - shown)
        conf = self.spark._jsc.hadoopConfiguration()
        for folder in gone:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(folder))
            path.getFileSystem(conf).delete(path, True)
        return gone

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.folders()[name])
