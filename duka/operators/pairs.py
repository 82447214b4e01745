"""Co-occurrence counting for market baskets.

The line-level self join `a.basket = b.basket AND a.item < b.item` produces
n_a * n_b rows per item pair inside a basket. Lines are first collapsed to
(basket, item, lines) with a partial-then-final aggregate, so the join
emits one row per distinct item pair per basket carrying the weight
n_a * n_b; the result equals the line-pair count.

A basket with k distinct items still yields k(k-1)/2 pairs, all for one
join key. A basket above `items_per_part` distinct items is therefore dealt
over ceil(k / items_per_part) parts: side A carries part = hash(item) mod
parts, side B is repeated once per part of its basket, and the join is on
(basket, part), so each pair is produced exactly once and one join key holds
at most about items_per_part * k pairs. Smaller baskets have one part. The
number of parts is a function of the basket's own rows (no sample, no cap on
the number of split baskets), so every branch and every rerun of a task sees
the same split. The list of split baskets carries no broadcast hint: Spark
broadcasts it if its measured size allows, else joins it by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ITEMS_PER_PART = 2048    # distinct items of a basket that one part holds


def basket_items(lines: DataFrame, basket: str, item: str) -> DataFrame:
    """One row per (basket, item) with its lines; a NULL on either side pairs with nothing."""
    known = lines.where(F.col(basket).isNotNull() & F.col(item).isNotNull())
    return known.groupBy(basket, item).agg(F.count(F.lit(1)).alias("_n"))


def hot_baskets(per: DataFrame, basket: str, items_per_part: int = ITEMS_PER_PART) -> DataFrame:
    """Baskets above `items_per_part` distinct items and their number of parts."""
    # counting through _n keeps that column in the aggregate below, so this
    # branch can reuse the exchange of the join sides
    sizes = per.groupBy(basket).agg(F.count_if(F.col("_n") > 0).alias("_k"))
    hot = sizes.where(F.col("_k") > items_per_part).select(
        basket, F.ceil(F.col("_k") / items_per_part).cast("bigint").alias("_parts"))
    # exchanges of its own (by more than the aggregate's key, which would be
    # planned away): their measured size is the list's, not that of all
    # baskets, so AQE may broadcast it, and may split the join if not
    return hot.repartition(basket, "_parts")


def item_pair_weights(lines: DataFrame, basket: str, item: str,
                      items_per_part: int = ITEMS_PER_PART) -> DataFrame:
    """(basket, item_a, item_b, weight) for item_a < item_b in one basket."""
    per = basket_items(lines, basket, item).withColumnRenamed(item, "_item")
    dealt = (per.join(hot_baskets(per, basket, items_per_part), basket, "left")
             .withColumn("_parts", F.coalesce("_parts", F.lit(1).cast("bigint"))))
    a = dealt.select(F.col(basket).alias("_b"), F.col("_item").alias("item_a"), F.col("_n").alias("_na"),
                     F.pmod(F.xxhash64("_item"), F.col("_parts")).alias("_part"))
    b = dealt.select(F.col(basket).alias("_b2"), F.col("_item").alias("item_b"), F.col("_n").alias("_nb"),
                     F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("_part2"))
    joined = a.join(b, (F.col("_b") == F.col("_b2")) & (F.col("_part") == F.col("_part2"))
                    & (F.col("item_a") < F.col("item_b")))
    return joined.select(F.col("_b").alias(basket), "item_a", "item_b",
                         (F.col("_na") * F.col("_nb")).alias("weight"))


def pair_counts(lines: DataFrame, basket: str, item: str, **kw) -> DataFrame:
    """(item_a, item_b, times) = number of line pairs with item_a < item_b."""
    return (item_pair_weights(lines, basket, item, **kw)
            .groupBy("item_a", "item_b").agg(F.sum("weight").alias("times")))


def pairs_per_basket(lines: DataFrame, basket: str, item: str, name: str) -> DataFrame:
    """Number of line pairs with item_a < item_b of each basket that has any:
    all ordered pairs of lines, less those of equal items, halved. No pair is made."""
    n = F.col("_n").cast("decimal(38,0)")
    count = ((F.sum(n) * F.sum(n) - F.sum(n * n)) / 2).cast("bigint")
    return basket_items(lines, basket, item).groupBy(basket).agg(count.alias(name)).where(F.col(name) > 0)
