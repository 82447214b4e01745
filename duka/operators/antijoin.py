"""Anti joins: SQL `NOT IN (subquery)` with its NULL rules, and `left_anti`.

Spark plans `x NOT IN (SELECT k ...)` as a null-aware anti join that always
broadcasts the subquery, whatever its size. `not_in` keeps the exact SQL
meaning without that broadcast:

* subquery empty            -> every left row is kept (even a NULL key);
* subquery holds a NULL     -> no row is kept;
* left key NULL             -> row dropped (unless the subquery is empty);
* otherwise                 -> rows whose key is not in the subquery.

The two facts about the subquery (row count, NULL count) come from one
scalar subquery (a global aggregate); the key match is an ordinary shuffled
`left_anti` join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_in(left: DataFrame, left_key: str, sub: DataFrame, sub_key: str) -> DataFrame:
    """Rows of `left` where `left_key NOT IN (SELECT sub_key FROM sub)`."""
    keys = sub.select(F.col(sub_key).alias("_k"))
    # one scalar subquery (a global aggregate) whose two numbers are planted
    # into the filter: no join, nothing broadcast but a struct of two counts
    facts = keys.agg(F.struct(F.count(F.lit(1)).alias("rows"),
                              F.count_if(F.col("_k").isNull()).alias("nulls"))).scalar()
    sub_rows, sub_nulls = facts.getField("rows"), facts.getField("nulls")
    non_null = keys.where(F.col("_k").isNotNull()).distinct()
    # rows whose key matched are dropped by the anti join; a NULL key never
    # matches, so it survives here and is dropped below unless S is empty
    unmatched = left.join(non_null, left[left_key] == non_null["_k"], "left_anti")
    keep = (sub_rows == 0) | ((sub_nulls == 0) & F.col(left_key).isNotNull())
    return unmatched.where(keep)


def anti_join(left: DataFrame, left_key: str, sub: DataFrame, sub_key: str) -> DataFrame:
    """`NOT EXISTS` / `left_anti`: rows whose key has no match (NULL keys kept)."""
    keys = sub.select(F.col(sub_key).alias("_k")).where(F.col("_k").isNotNull())
    return left.join(keys, left[left_key] == keys["_k"], "left_anti")
