"""Stored customer history: batches of observations merged into SCD type 2 versions.

Observations (key, date, attribute) and the versions made of them are stored by
buckets of the key. A batch reads, rebuilds and rewrites only the
buckets its keys fall into and publishes them at once; the files of all other
buckets stay as they are. Observations are kept beside the versions, so late ones are
merged exactly: any sequence of batches leaves what one build from all
observations would. Of two observations of a key on one day the later batch wins
(within a batch the greater value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duka.operators import scd2
from duka.sources.publish import Published

BUCKETS = 256


class History:
    """SCD2 versions of `attr` per `key` under one folder."""

    def __init__(self, spark: SparkSession, root: str, key: str, date: str, attr: str, buckets: int = BUCKETS):
        self.spark, self.key, self.date, self.attr, self.buckets = spark, key, date, attr, buckets
        self.published = Published(spark, root)

    def _read(self, table: str, only: set[int] | None = None) -> DataFrame | None:
        found = [p for n, p in self.published.folders().items()
                 if n.startswith(f"{table}/") and (only is None or int(n.split("/")[1]) in only)]
        return self.spark.read.parquet(*sorted(found)) if found else None

    def apply(self, observations: DataFrame, batch: str) -> list[int]:
        """Merge a batch; returns the buckets that were rewritten."""
        if self.published.has(batch):
            return []
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("bucket")
        new = observations.select(bucket, self.key, self.date, self.attr, F.lit(1).alias("_new"))
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())   # at most `buckets` rows
        if not touched:
            return []
        old = self._read("observations", set(touched))
        if old is not None:
            new = new.unionByName(old.select(bucket, self.key, self.date, self.attr, F.lit(0).alias("_new")))
        whole = new.groupBy("bucket", self.key, self.date).agg(
            F.max(F.struct("_new", self.attr)).getField(self.attr).alias(self.attr))
        seen, made = self.published.new_folder("observations"), self.published.new_folder("versions")
        self._write(whole, seen)
        whole = self.spark.read.schema(whole.schema).parquet(self.published.path(seen))
        versions = scd2.build_versions(whole, self.key, self.date, self.attr)
        self._write(versions, made)
        self.published.publish({f"{table}/{b}": f"{folder}/bucket={b}" for b in touched
                                for table, folder in (("observations", seen), ("versions", made))}, batch)
        return touched

    def _write(self, df: DataFrame, folder: str) -> None:
        # a bucket is written by several tasks, so its size is not a task's
        part = F.pmod(F.xxhash64(self.key, F.lit(1)), F.lit(8))
        df.repartition(F.col("bucket"), part).write.partitionBy("bucket").parquet(self.published.path(folder))

    def versions(self) -> DataFrame | None:
        return self._read("versions")
