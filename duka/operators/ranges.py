"""Range joins and dense grids without cross joins.

`x.d BETWEEN r.start AND r.end` with no equi key plans a cartesian product
or a broadcast nested loop. When the range is a span of days, each range row
is expanded to its days with `explode(sequence(start, end))` and joined on
the day, or cut into power-of-two cells and joined on the cell (`interval_join`):
equi-joins that shuffle or broadcast like any other.
A dense (entity x day) grid is kept as runs of days (`value_runs`): sums over
the grid are sums over runs by their length, and `dense_daily` generates the
days only for those who ask for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duka.functions import calendar as cal


LEVELS = 22      # 2^22 days hold every date Spark knows


def explode_days(df: DataFrame, start: str, end: str, name: str = "full_date") -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.col(start), F.col(end),
                                                    F.expr("INTERVAL 1 DAY"))))


def cover(df: DataFrame, start: str, end: str, name: str = "cell") -> DataFrame:
    """One row per power-of-two cell of days that together make up [start, end]:
    `name` is (level, number), a cell of level j holding 2^j days. A span of n days takes
    at most 2 log2 n cells, whatever its length."""
    a, b = _day_number(F.col(start)), _day_number(F.col(end)) + 1

    def cells(j):
        one = _cell_days(j)
        first, stop = F.floor((a + one - 1) / one).cast("bigint"), F.floor(b / one).cast("bigint")
        inside = first < stop
        left = F.when(inside & (first % 2 == 1), F.struct(j.alias("level"), first.alias("number")))
        right = F.when(inside & (stop % 2 == 1), F.struct(j.alias("level"), (stop - 1).alias("number")))
        return F.array(left, right)

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), cells))
    return df.withColumn(name, F.explode(F.filter(every, lambda c: c.isNotNull())))


def interval_join(points: DataFrame, day: str, spans: DataFrame, start: str, end: str) -> DataFrame:
    """Every row of `points` with every row of `spans` whose [start, end] holds
    its day: spans are cut into power-of-two cells, points carry the cell of each level, and
    the join is on the cell. A long span makes tens of rows, not one per day. Rows
    without a day or border, and spans that end before they start, join nothing."""
    number = _day_number(F.col(day))
    levels = F.transform(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda j: F.struct(
        j.alias("level"), F.floor(number / _cell_days(j)).cast("bigint").alias("number")))
    p = points.where(F.col(day).isNotNull()).withColumn("_cell", F.explode(levels))
    s = cover(spans.where(F.col(start).isNotNull() & F.col(end).isNotNull()), start, end, "_cell").withColumnRenamed("_cell", "_own")
    return p.join(s, F.col("_cell") == F.col("_own")).drop("_cell", "_own")


def _cell_days(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level)


def _day_number(d: Column) -> Column:
    """Days since year 1, never negative."""
    return F.datediff(d, F.lit("0001-01-01").cast("date")).cast("bigint")


def value_runs(entities: DataFrame, key: str, daily: DataFrame, day_col: str, value_col: str,
               start, end) -> DataFrame:
    """(key, first_day, last_day, value): the dense entity x day grid over
    [start, end], run-length encoded. A day with a `daily` row is a run of one
    day, and the idle days up to the next one are a single run with a NULL
    value, so the rows grow with `daily` and the entities, not with the days.

    `daily` holds one row per entity and day inside [start, end]; rows of
    unknown entities are dropped. The window is partitioned by the entity and
    sees at most one row per day of the span.
    """
    start_c, end_c = _day(start), _day(end)
    value = F.col(value_col)
    heads = entities.select(key, F.date_sub(start_c, 1).alias("_day"),
                            F.lit(None).cast(daily.schema[value_col].dataType).alias("_value"),
                            F.lit(True).alias("_head"))
    marks = heads.unionByName(daily.select(key, F.col(day_col).alias("_day"), value.alias("_value"),
                                           F.lit(False).alias("_head")))
    w = Window.partitionBy(key).orderBy("_day")
    following = F.coalesce(F.lead("_day").over(w), F.date_add(end_c, 1))
    marks = marks.withColumns({"_next": following, "_known": F.first("_head").over(w)}).where("_known")
    own = F.struct(F.when(~F.col("_head"), F.col("_day")).alias("first_day"), F.col("_day").alias("last_day"), F.col("_value").alias(value_col))
    idle = F.struct(F.date_add("_day", 1).alias("first_day"), F.date_sub("_next", 1).alias("last_day"),
                    F.lit(None).cast(daily.schema[value_col].dataType).alias(value_col))
    runs = F.filter(F.array(own, idle), lambda r: r["first_day"] <= r["last_day"])
    return marks.select(key, F.explode(runs).alias("_run")).select(key, "_run.*")


def run_months(runs: DataFrame, name: str = "month") -> DataFrame:
    """One row per run and month it touches: `name` (the first of the month)
    and `days`, the run's days in it."""
    months = F.sequence(F.trunc("first_day", "MM"), F.trunc("last_day", "MM"), F.expr("INTERVAL 1 MONTH"))
    return runs.withColumn(name, F.explode(months)).withColumn(
        "days", F.datediff(F.least("last_day", F.last_day(name)), F.greatest("first_day", name)) + 1)


def _day(d) -> Column:
    return d if isinstance(d, Column) else F.lit(d).cast("date")


def dense_daily(entities: DataFrame, key: str, daily: DataFrame, day_col: str, value_col: str,
                start, end, name: str = "full_date") -> DataFrame:
    """(key, full_date, date_key, value) for every entity and every day in
    [start, end]; value is the entity's `daily` value that day, or NULL. The
    days are generated from the runs where they are consumed, so the
    entities x days grid is never shuffled."""
    grid = explode_days(value_runs(entities, key, daily, day_col, value_col, start, end),
                        "first_day", "last_day", name)
    return grid.select(key, name, cal.date_key(name).alias("date_key"), value_col)
