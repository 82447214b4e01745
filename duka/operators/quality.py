"""Data-quality checks that stand in for write-time constraints.

Foreign keys become orphan counts (both sides of all checks in one grouped
comparison), primary keys become
duplicate-key counts (partial-then-final aggregation, so a hot key costs one
row per task before the shuffle), NOT NULL becomes a null count per column
computed for all columns in one pass and unpivoted with `stack`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def orphan_counts(checks: list[tuple[str, str, str, str, str]], table: Callable[[str], DataFrame]) -> DataFrame:
    """One row per check (name, child table, child key, parent table, parent
    key): child rows, and those whose key (NULL included) has no parent.

    Every table is scanned once, however many checks it is child or parent
    of: a row becomes one narrow mark (check, key) per role. Marks are counted per key
    before the one shared exchange, so a key held by a third of the child
    rows is one row per task, and a grouped comparison of both sides
    replaces the joins.
    """
    roles: dict[str, list[Column]] = {}
    for i, (_, child, child_key, parent, parent_key) in enumerate(checks):
        for name, key, is_child in ((child, child_key, 1), (parent, parent_key, 0)):
            roles.setdefault(name, []).append((i, key, is_child))
    marks = []
    for name, own in roles.items():
        df = table(name)
        kind = dict(df.dtypes)

        def mark(i: int, key: str, is_child: int) -> Column:
            text = kind[key] == "string"
            return F.struct(F.lit(i).alias("check"), F.lit(is_child).alias("child"),
                            (F.lit(None) if text else F.col(key)).cast("bigint").alias("number"),
                            (F.col(key) if text else F.lit(None)).cast("string").alias("text"))

        marks.append(df.select(F.explode(F.array(*[mark(*r) for r in own])).alias("m")).select("m.*"))
    per_key = union_all(marks).groupBy("check", "number", "text").agg(
        F.sum("child").alias("n"), F.count_if(F.col("child") == 0).alias("parents"))
    known = (F.col("parents") > 0) & (F.col("number").isNotNull() | F.col("text").isNotNull())
    sums = per_key.groupBy("check").agg(F.sum("n").alias("child_rows"), F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("orphan_rows"))
    names = F.element_at(F.array(*[F.lit(c[0]) for c in checks]), F.col("check") + 1)
    every = F.explode(F.sequence(F.lit(0), F.lit(len(checks) - 1))).alias("check")
    listed = sums.sparkSession.range(1).select(every)       # a check of two empty tables is a row of zeros
    return listed.join(sums, "check", "left").select(
        names.alias("check_name"), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("child_rows", "orphan_rows")])


def duplicate_keys(check: str, df: DataFrame, key_cols: list[str]) -> DataFrame:
    """One row: check name, rows, distinct keys, keys held by >1 row and
    the rows holding them."""
    per_key = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.lit(check).alias("check_name"),
        F.sum("_n").alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("rows_in_duplicates"))


def null_counts(table: str, df: DataFrame) -> DataFrame:
    """(table_name, column_name, null_count) for every column, one scan."""
    cols = df.columns
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_c{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _c{i}" for i, c in enumerate(cols))
    return counts.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, null_count)") \
        .select(F.lit(table).alias("table_name"), "column_name", "null_count")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
