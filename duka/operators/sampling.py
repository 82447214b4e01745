"""Deterministic fixed-size sample: the n rows with the smallest seeded hash.

Replaces `TOP n ... ORDER BY NEWID()`. `orderBy(...).limit(n)` plans a
TakeOrderedAndProject: every task keeps only its own n smallest rows, so
the driver merges at most n rows per task, never the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hash_key(seed: str, key_cols: list[str]):
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in key_cols]))


def sample_n(df: DataFrame, n: int, seed: str, key_cols: list[str],
             tie_cols: list[str] | None = None, name: str = "sample_hash") -> DataFrame:
    with_hash = df.withColumn(name, hash_key(seed, key_cols))
    order = [F.col(name)] + [F.col(c) for c in (tie_cols or key_cols)]
    return with_hash.orderBy(*order).limit(n)
