"""Inline literal tables as JVM-side `VALUES` relations.

`spark.createDataFrame(list)` from Python plans as a scan of a Python RDD,
which starts Python workers on executors just to read a few constant rows.
A SQL `VALUES` list is a LocalRelation: it is folded into the plan on the
driver and never touches Python.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, Decimal)):
        return str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return "'" + v.isoformat() + "'"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_table(spark: SparkSession, rows, schema: list[tuple[str, str]]) -> DataFrame:
    """Rows of Python values typed by `schema` = [(name, spark sql type)]."""
    names = ", ".join(n for n, _ in schema)
    values = ", ".join("(" + ", ".join(sql_literal(v) for v in r) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in schema])
