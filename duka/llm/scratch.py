"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from duka.session import ensure_checkpoint_dir


class Scratch:
    """Writes tables under `spark.checkpoint.dir` (so lost executors cost no
    recomputation from the start) and removes them when they are done with."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.paths: list[tuple[DataFrame, str]] = []

    def cut(self, df: DataFrame) -> DataFrame:
        """`df` written once and read back."""
        path = f"{self.root}/{len(self.paths)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((out, path))
        return out

    def drop(self, df: DataFrame) -> None:
        """Remove a table made by `cut`."""
        for path in [p for table, p in self.paths if table is df]:
            self._delete(path)

    def clear(self) -> None:
        """Remove all tables made here; for callers that have written their result."""
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def settle(self) -> None:
        """Let Spark remove the shuffle files of plans that are done with."""
        gc.collect()
        self.spark._jvm.System.gc()
