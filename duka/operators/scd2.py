"""Slowly changing dimension, type 2: build versions and look them up.

`build_versions` turns dated attribute observations into versions: a new
version starts only when the attribute differs from the previous
observation; `valid_to` is the day before the next version starts (NULL for
the current one). The windows are partitioned by the business key and run
over one row per observation date, so no key holds more rows than it has
observation dates.

`point_in_time` attaches to each fact row the version valid on its date:
an equi-join on the business key with the validity range as residual
condition (sort-merge join; a hot key is split by AQE's skew-join handling).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def build_versions(obs: DataFrame, key: str, date_col: str, attr: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(date_col)
    # NULL is a value of its own here: A -> NULL -> A makes three versions
    changed = (obs.withColumns({"_prev": F.lag(attr).over(w), "_nth": F.row_number().over(w)})
               .where((F.col("_nth") == 1) | ~F.col("_prev").eqNullSafe(F.col(attr)))
               .drop("_prev", "_nth"))
    return (changed
            .withColumn("valid_from", F.col(date_col))
            .withColumn("valid_to", F.date_sub(F.lead(date_col).over(w), 1))
            .withColumn("version", F.row_number().over(w).cast("int"))
            .withColumn("is_current", F.col("valid_to").isNull())
            .drop(date_col))


def version_key(key: str, valid_from: str) -> Column:
    """Surrogate key of a version, made of its natural key and first day (days
    since 1970, below 100,000), so a reload or a later batch never renumbers."""
    return (F.col(key).cast("long") * 100_000 + F.datediff(F.col(valid_from), F.lit("1970-01-01"))).cast("long")


def current_versions(versions: DataFrame) -> DataFrame:
    return versions.where(F.col("is_current"))


def point_in_time(facts: DataFrame, fact_key: str, fact_date: str,
                  versions: DataFrame, key: str) -> DataFrame:
    v = versions.withColumnRenamed(key, "_vkey")
    cond = ((F.col(fact_key) == F.col("_vkey"))
            & (F.col(fact_date) >= F.col("valid_from"))
            & (F.col(fact_date) <= F.coalesce(F.col("valid_to"), F.lit(OPEN_END).cast("date"))))
    return facts.join(v, cond).drop("_vkey")
