"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from duka.llm.scratch import Scratch


def _large(e: DataFrame) -> DataFrame:
    both = e.union(e.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return down.join(least, "u").select("v", "m").union(least.select("u", "m")).toDF("a", "b")


def components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(id, root) for every id of the edges (a, b): root is the least id of
    its component. Each round is written to the scratch folder; the number of rounds is
    logarithmic in the size of a component. A node with very many neighbours is
    aggregated before it is joined, so no list of neighbours is ever formed."""
    e = scratch.cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(rounds):
        new = scratch.cut(_small(_large(e)).where("a <> b").distinct())
        scratch.drop(e)
        e = new
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return e.select(F.col("a").alias("id"), F.col("b").alias("root")) \
                .union(e.select("b", "b").distinct())
        seen = now
    raise RuntimeError("components did not settle")
