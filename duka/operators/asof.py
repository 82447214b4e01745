"""As-of merge: each fact row gets the version of its key that was valid on its date.

Facts and versions are united and range-partitioned by (key, date), versions before facts
of the same day; within a range the last version seen is carried forward, and
across range borders one row per range says which version of which key is still open. A key
holding a third of all facts spreads over many ranges, no list of versions is
built and no pair of fact and version is formed.

Facts before the first version of their key, of an unknown key or without key or date get NULLs. Two
versions of a key on one day leave the one that is greater in (order of) `carry`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duka.operators.numbering import write_table

_LOCAL_BITS = 33    # monotonically_increasing_id = partition << 33 | row in partition


def asof_merge(facts: DataFrame, fact_key: str, fact_date: str, versions: DataFrame,
               key: str, valid_from: str, carry: list[str]) -> DataFrame:
    """`facts` with the `carry` columns of the version valid on `fact_date`."""
    version = F.struct(*[F.col(c) for c in carry])
    row = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    v = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("_k"), F.col(valid_from).cast("date").alias("_at"), F.lit(0).alias("_fact"),
        version.alias("_v"))
    f = facts.select(F.col(fact_key).alias("_k"), F.col(fact_date).cast("date").alias("_at"),
                     F.lit(1).alias("_fact"), row.alias("_row"))
    marks = v.unionByName(f, allowMissingColumns=True)
    # rows alike in key and day are spread by a hash of the fact
    order = [F.col("_k"), F.col("_at"), F.col("_fact"), F.col("_v"), F.xxhash64("_row")]
    ranged = marks.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = write_table(ranged.withColumn("_mid", F.monotonically_increasing_id())) \
        .withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
    # what is open at each border: one row per range
    seen = F.col("_v").isNotNull()
    ends = rows.groupBy("_pid").agg(
        F.max_by(F.when(seen, F.struct("_k", "_v")), F.when(seen, F.col("_mid"))).alias("_end"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    opened = ends.select("_pid", F.last("_end", ignorenulls=True).over(before).alias("_open"))
    in_block = Window.partitionBy("_pid", "_k").orderBy("_mid") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = rows.withColumn("_seen", F.last("_v", ignorenulls=True).over(in_block)).where("_fact = 1")
    found = F.coalesce(F.col("_seen"), F.when(F.col("_open._k") == F.col("_k"), F.col("_open._v")))
    out = filled.join(F.broadcast(opened), "_pid").withColumn("_found", F.when(F.col("_at").isNotNull(), found))
    return out.select("_row.*", *[F.col(f"_found.{c}").alias(c) for c in carry])
