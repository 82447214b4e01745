"""Incremental load of the campaign-day marketing fact with Structured Streaming.

The batch build (`Warehouse.fact_marketing`) aggregates the whole event log.
Here new event files are picked up incrementally: a streaming aggregation
keeps the funnel counts per (day, campaign) in the state store, and every
micro-batch writes the fact anew from that state joined to the campaign-day
cost rows and publishes it under the batch's id. The state is bounded by days x campaigns, so `complete` output
mode is the right one: a late event (any lateness) still lands in its day,
and the written fact is always whole.

A batch that dies while it writes leaves readers the fact they had; a replayed
batch finds its id published and changes nothing.

Progress and state live under a checkpoint folder inside the cluster's
`spark.checkpoint.dir`, so a restarted or failed run resumes exactly once
from the last committed micro-batch.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from duka.session import ensure_checkpoint_dir
from duka.sources.publish import Published
from duka.sources.warehouse import Warehouse


def event_stream(spark: SparkSession, events_dir: str, file_glob: str = "events*.parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Event files arriving under `events_dir` as a stream (schema from the
    files already there, never inferred per batch)."""
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(events_dir).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(events_dir)


def load_fact_marketing(w: Warehouse, events_dir: str, out_dir: str,
                        checkpoint: str | None = None, file_glob: str = "events*.parquet",
                        max_files_per_trigger: int | None = None) -> str:
    """Run the incremental load until all present event files are processed
    (`availableNow`), leaving the whole marketing fact published under
    `out_dir` as `fact_marketing`."""
    spark = w.spark
    published = Published(spark, out_dir)
    if checkpoint is None:
        checkpoint = os.path.join(ensure_checkpoint_dir(spark),
                                  f"fact_marketing_stream-{uuid.uuid4().hex[:8]}")
    counts = w.funnel_counts(event_stream(spark, events_dir, file_glob, max_files_per_trigger))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # `batch` is the complete (day, campaign) state after this trigger
        name = f"{checkpoint}#{batch_id}"
        if published.has(name):
            return
        folder = published.new_folder("fact_marketing")
        w.marketing_from_counts(batch).write.parquet(published.path(folder))
        published.publish({"fact_marketing": folder}, name)

    query = (counts.writeStream.outputMode("complete")
             .option("checkpointLocation", checkpoint)
             .foreachBatch(write_batch)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return out_dir


def fact_marketing_incremental(w: Warehouse) -> DataFrame:
    """The marketing fact as left by the incremental load over the driver's
    event file (same rows as the batch build)."""
    out_dir = os.path.join(ensure_checkpoint_dir(w.spark),
                           f"fact_marketing-{uuid.uuid4().hex[:8]}")
    load_fact_marketing(w, w.sf_dir, out_dir, file_glob="events.parquet")
    return Published(w.spark, out_dir).table("fact_marketing")
