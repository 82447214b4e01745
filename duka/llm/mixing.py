"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected copies (the source's target
over its size). The documents of a source are put in a fixed order, their
expected copies are prefix-summed, one random offset is added, and a document
is emitted once for each integer boundary that its stretch crosses.

The order runs through size classes (steps of 1/8 in the natural logarithm)
and, inside a class, through hash cells, so neighbours have like sizes and the
taken words stay near the target. The rank in that order is the row number in
a (source, class, cell) plus the counts of the cells before it: a hot source
is spread over many cells, and only the table of cell counts (a constant number of
rows per source) is summed in one window.

Defined results: null text has size 0 and takes 0 words; a null source is a
source of its own, after the others; repeated rows are mixed like other rows;
an empty table gives an empty result; `mix` ignores other columns, `mixed` keeps
them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
CELLS = 64          # hash cells per size class
UNIT = 1 << 24      # the sampling step counts in 1/UNIT copies


def _salted(prefix: str, value: Column, digits: int) -> Column:
    text = F.coalesce(F.concat(F.lit(prefix), value.cast("string")), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) -> + target: the sources share 3/2 of all words
    by weight; a target stops at twice the source and the rest is reshared."""
    product = 1
    for w in weights:
        product *= w
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sizes.withColumn("_w", weight.cast("bigint"))
    # filling order: sources whose cap is reached first
    fill = Window.orderBy(F.col("source_size") * (F.lit(product) / F.col("_w")).cast("bigint"),
                          F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(0, Window.unboundedFollowing)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumns({"_left": 3 * F.sum("source_size").over(everything)
                       - 4 * F.coalesce(F.sum("source_size").over(before), F.lit(0)),
                       "_wleft": F.sum("_w").over(after), "_k": F.row_number().over(fill)})
    t = t.withColumn("_capped", F.col("_left") * F.col("_w") >= 4 * F.col("source_size") * F.col("_wleft"))
    level = F.min_by(F.when(~F.col("_capped"), F.col("_left") / (2.0 * F.col("_wleft"))),
                     F.when(~F.col("_capped"), F.col("_k"))).over(everything)
    return t.select("source", "source_size",
                    F.when(F.col("_capped"), 2.0 * F.col("source_size"))
                    .otherwise(level * F.col("_w")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken for every document,
    and a struct `_row` of the columns named in `carry`."""
    name = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))    # a key without nulls
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    kept = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row")] if carry else []
    d = docs.select("doc_id", "source", name.alias("_s"), size.alias("size"), *kept)
    d = d.withColumns({"_class": F.floor(8 * F.log(1.0 + F.col("size"))).cast("int"),
                       "_cell": F.pmod(_salted("", F.col("doc_id"), 6), F.lit(CELLS)).cast("int")})
    cells = d.groupBy("_s", "_class", "_cell").agg(F.count("*").alias("_n"), F.sum("size").alias("_words"))
    sizes = cells.groupBy("_s").agg(F.sum("_words").alias("source_size")).withColumn(
        "source", F.when(F.col("_s") != "n", F.expr("substring(_s, 2)")))
    plan = targets(sizes, weights)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("_rate", rate).select(
        name.alias("_s"), "source_size", "target", F.floor("_rate").cast("bigint").alias("_whole"),
        F.floor((F.col("_rate") - F.floor("_rate")) * UNIT).cast("bigint").alias("_part"),
        _salted(f"{seed}:", F.col("source"), 6).alias("_offset"))
    run = Window.partitionBy("_s").orderBy("_class", "_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_start", F.coalesce(F.sum("_n").over(run), F.lit(0))).drop("_n", "_words").join(plan, "_s")
    in_cell = Window.partitionBy("_s", "_class", "_cell").orderBy("size", "doc_id")
    d = d.withColumn("_r", F.row_number().over(in_cell) - 1).join(cells, ["_s", "_class", "_cell"])
    k = F.col("_start") + F.col("_r")

    def crossed(n: Column) -> Column:
        return F.shiftright(n * F.col("_part") + F.col("_offset"), 24)

    copies = F.col("_whole") + crossed(k + 1) - crossed(k)
    return d.select("doc_id", "size", "source_size", "target", copies.cast("bigint").alias("copies"),
                    *(["_row"] if carry else [])).withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = "mix") -> DataFrame:
    """The documents of the mix: every row as often as it is emitted."""
    rows = mix(docs, weights, seed, tuple(docs.columns)).where("copies > 0")
    return rows.select(F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))), "_row").select(
        *[F.col("_row").getField(c).alias(c) for c in docs.columns])


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of all documents."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")) \
        .select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 6))::BIGINT,
                  ('0x' || substr(md5('null'), 1, 6))::BIGINT) % 64 AS cell
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM s),
f AS (SELECT *, row_number() OVER o AS k,
             3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wrest
      FROM w WINDOW o AS (ORDER BY source_size * (6 // w), source NULLS LAST)),
c AS (SELECT *, rest * w >= 4 * source_size * wrest AS capped FROM f),
lv AS (SELECT arg_min(rest::DOUBLE / (2.0::DOUBLE * wrest::DOUBLE), k) AS level FROM c WHERE NOT capped),
t AS (SELECT source, source_size,
             CASE WHEN capped THEN 2.0::DOUBLE * source_size::DOUBLE ELSE level * w END AS target
      FROM c, lv),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0 END AS rate,
             coalesce(('0x' || substr(md5('mix:' || source), 1, 6))::BIGINT,
                      ('0x' || substr(md5('null'), 1, 6))::BIGINT) AS shift
      FROM t),
r AS (SELECT doc_id, source, size,
             row_number() OVER (PARTITION BY source ORDER BY floor(8 * ln(1 + size)), cell, size, doc_id) - 1 AS k
      FROM d),
x AS (SELECT doc_id, size, source_size, target, floor(rate)::BIGINT AS whole,
             floor((rate - floor(rate)) * 16777216)::BIGINT AS part, shift, k
      FROM r JOIN p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (whole + (((k + 1) * part + shift) // 16777216) - ((k * part + shift) // 16777216)) * size AS taken
FROM x
"""
