"""Surrogate keys that stay the same over reloads.

The map natural key -> surrogate key is stored beside the tables. A load looks its
rows up, numbers only natural keys that are not in the map (dense, after the greatest key so
far, in the order of the natural columns) and publishes them as one more part of the map, so a
key once given never changes. The new keys are numbered by the distributed
numbering operator; a load that dies before it publishes leaves the map as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duka.operators.numbering import dense_index
from duka.sources.publish import Published


class KeyMap:
    """The map of one table: natural columns -> bigint `name`."""

    def __init__(self, spark: SparkSession, root: str, natural: list[str], name: str):
        self.spark, self.natural, self.name = spark, natural, name
        self.published = Published(spark, root)

    def known(self) -> DataFrame | None:
        folders = self.published.folders()
        return self.spark.read.parquet(*sorted(folders.values())) if folders else None

    def assign(self, df: DataFrame, batch: str | None = None) -> DataFrame:
        """`df` with its keys; unknown natural keys (NULL counts as a value) are added to the map."""
        batch = batch or uuid.uuid4().hex
        if not self.published.has(batch):
            self._add(df.select(*self.natural).distinct(), batch)
        known = self.known()
        same = None
        for c in self.natural:
            pair = df[c].eqNullSafe(known[c])
            same = pair if same is None else same & pair
        return df.join(known, same, "left").select(*[df[c] for c in df.columns], known[self.name])

    def _add(self, keys: DataFrame, batch: str) -> None:
        known, last = self.known(), 0
        if known is not None:
            same = None
            for c in self.natural:
                pair = keys[c].eqNullSafe(known[c])
                same = pair if same is None else same & pair
            keys = keys.join(known, same, "left_anti")
            last = known.agg(F.max(self.name)).first()[0] or 0
        fresh = dense_index(keys, [F.col(c) for c in self.natural], name=self.name)
        folder = self.published.new_folder("keys")
        fresh.select(*self.natural, (F.col(self.name) + last).cast("bigint").alias(self.name)) \
            .write.parquet(self.published.path(folder))
        self.published.publish({f"part-{batch}": folder}, batch)
