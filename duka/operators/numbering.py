"""Dense row numbering and NTILE without a single-partition window.

`row_number() OVER (ORDER BY ...)` with no PARTITION BY moves every row to
one task. Here the rows are range-partitioned on the order keys instead, each
partition is sorted and numbered locally, and a tiny table of per-partition
counts (one row per partition, so its size is bounded by the partition
count) gives each partition its starting offset through a broadcast join.

The range-partitioned, locally numbered rows are written as a Parquet table
in the cluster's checkpoint folder (`spark.checkpoint.dir`) before the
counts are taken: range bounds come from sampling, and the written table
makes the counts and the local numbers read the very same rows even if an
executor is lost and tasks rerun (a rerun task rewrites identical rows).

The order keys must form a total order (append a unique key) for the result
to be deterministic; rows equal on every key get an arbitrary but dense
numbering among themselves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duka.session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | row in partition


def write_table(df: DataFrame) -> DataFrame:
    """Cut the lineage by writing `df` as Parquet under the checkpoint
    folder and reading it back. `_mid` is a stored column from here on, so
    the counts and the numbers below depend on the data only, not on how the
    files are split when read."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/duka-index-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def dense_index(df: DataFrame, order_cols: list, name: str = "row_index",
                num_partitions: int | None = None, with_total: bool = False,
                keep_partition: bool = False) -> DataFrame:
    """Append `name` = 1..n in the order of `order_cols` (ascending unless
    the Column says otherwise). With `with_total`, also `_total` = n; with
    `keep_partition`, also `_pid`, the range partition of the row."""
    ensure_checkpoint_dir(df.sparkSession)
    # range partitioning samples its input in a separate job first; that job
    # reuses the shuffle output of upstream stages, so only the last stage
    # before the exchange runs twice (cheaper than caching wide rows).
    # Without an explicit count AQE may coalesce neighbouring range
    # partitions to its advisory size: a coalesced partition is a contiguous
    # run of ranges, so partition order is still the global order, and the
    # numbers are fixed in the written table before anything reads them.
    if num_partitions:
        ranged = df.repartitionByRange(num_partitions, *order_cols)
    else:
        ranged = df.repartitionByRange(*order_cols)
    ranged = ranged.sortWithinPartitions(*order_cols)
    mid = F.monotonically_increasing_id()
    tagged = write_table(ranged.withColumn("_mid", mid))
    tagged = tagged.withColumns({
        "_pid": F.shiftright("_mid", _LOCAL_BITS),
        "_local": F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)),
    })
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_offset"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_total"))
    out = (tagged.join(F.broadcast(offsets), "_pid")
           .withColumn(name, F.col("_offset") + F.col("_local") + 1))
    drop = ["_mid", "_local", "_offset"] + ([] if with_total else ["_total"]) \
        + ([] if keep_partition else ["_pid"])
    return out.drop(*drop)


def ntile(df: DataFrame, buckets: int, order_cols: list, name: str,
          num_partitions: int | None = None) -> DataFrame:
    """NTILE(buckets) OVER (ORDER BY order_cols), computed from the global
    row number: the first n % buckets tiles hold one extra row."""
    idx = dense_index(df, order_cols, name="_rn", num_partitions=num_partitions,
                      with_total=True)
    r, total = F.col("_rn"), F.col("_total")
    q = F.floor(total / buckets)
    rem = total - q * buckets
    big = rem * (q + 1)
    tile = (F.when(r <= big, F.floor((r - 1) / (q + 1)) + 1)
            .otherwise(rem + F.floor((r - big - 1) / F.nullif(q, F.lit(0))) + 1))
    return idx.withColumn(name, tile.cast("int")).drop("_rn", "_total")


HOT_GROUP = 1_000_000    # rows of a group that one task numbers at most


def number_within_groups(df: DataFrame, group_cols: list[str], order_cols: list,
                         name: str, num_partitions: int | None = None,
                         sizes: DataFrame | None = None, limit: int = HOT_GROUP) -> DataFrame:
    """ROW_NUMBER() OVER (PARTITION BY group_cols ORDER BY order_cols).

    Groups of at most `limit` rows are numbered by that window: one shuffle
    by group. Larger ones, if there are any, never go to one task: they are
    numbered by `number_over_ranges`. `sizes` (group columns and `n`) spares
    the count of `df` where the groups' sizes are known more cheaply.
    """
    if sizes is None:
        sizes = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > limit).select(*[F.col(c).alias(f"_large_{c}") for c in group_cols])
    window = F.row_number().over(Window.partitionBy(*group_cols).orderBy(*order_cols)).cast("int")
    if large.isEmpty():
        return df.withColumn(name, window)
    # the list is small (rows / limit at most); its groups may hold NULLs
    same = [F.col(c).eqNullSafe(F.col(f"_large_{c}")) for c in group_cols]
    rest = df.join(large, same, "left_anti").withColumn(name, window)
    hot = number_over_ranges(df.join(large, same, "left_semi"), group_cols, order_cols, name, num_partitions)
    return rest.unionByName(hot)


def number_over_ranges(df: DataFrame, group_cols: list[str], order_cols: list,
                       name: str, num_partitions: int | None = None) -> DataFrame:
    """The same numbers for groups of any size: rows are numbered globally by
    (group, order) with `dense_index`, so a large group spreads over several
    range partitions, and `number_from_index` joins on (range partition,
    group), a key no group can dominate.
    """
    keys = [F.col(c) for c in group_cols] + list(order_cols)
    idx = dense_index(df, keys, name="_gi", num_partitions=num_partitions, keep_partition=True)
    return number_from_index(idx, group_cols, "_gi", name, partition_col="_pid") \
        .drop("_gi", "_pid")


def number_from_index(idx: DataFrame, group_cols: list[str], index_col: str,
                      name: str, partition_col: str | None = None) -> DataFrame:
    """Per-group numbers from a global index whose order starts with the
    group columns: index minus the group's first index, plus one.

    With `partition_col` (the range partition of each row, see
    `dense_index(keep_partition=True)`), the group starts are found per
    (partition, group) block first: partial aggregation collapses each block
    to one row inside its task, the blocks of one group (at most one per
    partition it spans) agree on the group start, and the rows are joined
    back on (partition, group). A group holding a third of all rows spans
    many partitions, so no join key and no task carries it whole.
    """
    # a struct compares NULLs as equal, so rows without a group are one
    idx = idx.withColumn("_g", F.struct(*group_cols))
    if partition_col is None:
        starts = idx.groupBy("_g").agg(F.min(index_col).alias("_gs"))
        return (idx.join(starts, "_g")
                .withColumn(name, (F.col(index_col) - F.col("_gs") + 1).cast("int"))
                .drop("_gs", "_g"))
    blocks = idx.groupBy(partition_col, "_g").agg(F.min(index_col).alias("_bs"))
    starts = blocks.groupBy("_g").agg(F.min("_bs").alias("_gs"))
    block_starts = blocks.join(starts, "_g").select(partition_col, "_g", "_gs")
    return (idx.join(block_starts, [partition_col, "_g"])
            .withColumn(name, (F.col(index_col) - F.col("_gs") + 1).cast("int"))
            .drop("_gs", "_g"))


def running_totals(df: DataFrame, order_cols: list, value: str, name: str) -> DataFrame:
    """Append `name`: the sum of `value` over all rows before this one in the
    order of `order_cols`. Like `dense_index`: range partitions, a running sum
    inside each, and the sum of the partitions before as an offset (one row
    per partition)."""
    ranged = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    tagged = write_table(ranged.withColumn("_mid", F.monotonically_increasing_id())) \
        .withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
    sums = tagged.groupBy("_pid").agg(F.sum(value).alias("_sum"))
    offsets = sums.select("_pid", F.coalesce(F.sum("_sum").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    local = F.coalesce(F.sum(value).over(Window.partitionBy("_pid").orderBy("_mid")
                                         .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (tagged.withColumn("_local", local).join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_offset") + F.col("_local")).drop("_mid", "_pid", "_offset", "_local"))
