"""Exact dedup through an extendible-hash index on shared files.

DataFrame functions only. Texts are equal when they are identical after all white space
`[\\x20\\x09-\\x0D]` is deleted; of equal texts the row with the most code points in the
original stays, then the smallest doc_id.

1. Every row's 64-bit key (a hash of the normalised text), length and digest are written to
   shared files, without the text.
2. The directory doubles while a bucket is overfull: a bucket is a prefix of the key, and one
   of more than BUCKET_KEYS keys or BUCKET_BYTES of text is replaced by its two halves, so
   local depths differ where long texts lie.
3. Owners are runs of neighbouring buckets of about equal weight. Each text goes to the task of
   its key's owner, which compares the bytes of texts of one key and chains those that
   differ; a key that outweighs a task's fair share is dealt over several owners of its own.
   The owners write the index: a row per key, chain link and original length.
4. Links of dealt keys are merged by their bytes, and the narrow rows look their link up.

What is broadcast is bounded by construction: at most 2^MAP_BITS directory slots, and at most
MAX_SHARES dealt keys (only so many can outweigh 1/MAX_SHARES of all).

Defined results: null counts as the empty text, and all empty texts are equal; a null
doc_id comes after all others, and keep_id is null only where a group has no other; of
repeated rows (same doc_id, same text) one is kept; an empty table gives an empty result;
other columns are ignored by `groups` and kept by `deduplicated`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from duka.llm.scratch import Scratch

SPACE = r"[\x20\x09-\x0D]+"
BUCKET_KEYS = 256
BUCKET_BYTES = 1 << 20
OWNER_BYTES = 64 << 20
MAP_BITS = 18
MAX_SHARES = 1000
ROW_BYTES = 64          # what a row weighs besides its text


def _normal() -> Column:
    return F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, "")


def _key(bits: int) -> Column:
    """The key: the leading `bits` bits of a 64-bit hash of the normalised text."""
    return F.shiftrightunsigned(F.xxhash64("norm"), 64 - bits).cast("bigint")


def _prefix(bits: int, depth: int) -> Column:
    return F.shiftrightunsigned("h", bits - depth)


def directory(keys: DataFrame, bits: int, bucket_keys: int = BUCKET_KEYS, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, int]:
    """Buckets (depth, prefix, keys, bytes, weight) of keys (h, n, bytes, weight), and the
    depth of the directory. Level d of the doubling has a row for each prefix of d bits; a
    prefix is a bucket if it fits and the one it was split from does not."""
    size = keys.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    need = max(size[0] // bucket_keys, size[1] // bucket_bytes) + 1
    deepest = min(bits, need.bit_length() + 4)
    cells = keys.groupBy(_prefix(bits, deepest).alias("cell")).agg(
        F.count("*").alias("keys"), F.sum("bytes").alias("bytes"), F.sum("weight").alias("weight"))
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(deepest)))) \
        .groupBy("depth", F.expr(f"shiftrightunsigned(cell, {deepest} - depth)").alias("prefix")) \
        .agg(F.sum("keys").alias("keys"), F.sum("bytes").alias("bytes"), F.sum("weight").alias("weight"))
    over = (F.col("keys") > bucket_keys) | ((F.col("bytes") > bucket_bytes) & (F.col("keys") > 1))
    split = levels.where(over & (F.col("depth") < deepest)).select(F.col("depth").alias("d0"), F.col("prefix").alias("p0"))
    fits = levels.where(~over | (F.col("depth") == deepest))
    return fits.join(split, (F.col("depth") - 1 == F.col("d0")) & (F.shiftrightunsigned("prefix", 1) == F.col("p0")), "left") \
        .where((F.col("depth") == 0) | F.col("d0").isNotNull()).drop("d0", "p0"), deepest


def owners(buckets: DataFrame, bits: int, owner_count: int, total: int) -> DataFrame:
    """(slot, owner) for each of the 2^bits slots: buckets in the order of their keys, cut
    into `owner_count` runs of about equal weight. Buckets deeper than the slots share one."""
    first = F.expr(f"CASE WHEN depth <= {bits} THEN shiftleft(prefix, {bits} - depth) ELSE shiftrightunsigned(prefix, depth - {bits}) END")
    wide = F.expr(f"CASE WHEN depth <= {bits} THEN shiftleft(1L, {bits} - depth) ELSE 1L END")
    runs = buckets.groupBy(first.alias("first"), wide.alias("wide")).agg(F.sum("weight").alias("weight"))
    owner = F.expr(f"least({owner_count - 1}, floor((sum(weight) OVER (ORDER BY first) - weight / 2) * {owner_count} / {max(total, 1)}))")
    return runs.select("first", "wide", owner.cast("int").alias("owner")) \
        .select(F.explode(F.expr("sequence(first, first + wide - 1)")).alias("slot"), "owner")


def groups(docs: DataFrame, scratch: Scratch, bits: int = 64, bucket_keys: int = BUCKET_KEYS,
           bucket_bytes: int = BUCKET_BYTES, owner_bytes: int = OWNER_BYTES) -> DataFrame:
    """doc_id, n_chars, keep_id, group_size, kept, text_sha256 for every row."""
    spark = scratch.spark
    texts = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"), _normal().alias("norm")) \
        .withColumn("h", _key(bits))
    # 1. narrow rows
    rows = scratch.cut(texts.select("doc_id", "n_chars", "h", F.octet_length("norm").cast("bigint").alias("bytes"),
                                    F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha")))
    keys = scratch.cut(rows.groupBy("h").agg(F.count("*").alias("n"), F.max("bytes").alias("bytes"),
                                             F.sum(F.col("bytes") + ROW_BYTES).alias("weight")))
    # 2. directory, and the owners of its key ranges
    total = keys.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // owner_bytes + 1)
    shares = min(parts, MAX_SHARES)
    dealt = (F.col("n") > 1) & (F.col("weight").cast("double") * shares > total)
    buckets, deepest = directory(keys.withColumn("weight", F.when(dealt, 0).otherwise(F.col("weight"))), bits, bucket_keys, bucket_bytes)
    map_bits = min(deepest, MAP_BITS)
    slots = scratch.cut(owners(scratch.cut(buckets), map_bits, parts, total))
    hot = keys.where(dealt).select("h", F.least("n", F.ceil(F.col("weight") * F.lit(float(shares)) / max(total, 1))).cast("int").alias("own"))
    hot = scratch.cut(hot.withColumn("from", F.expr(f"cast({parts} + sum(own) OVER (ORDER BY h) - own AS int)")))
    extra = hot.agg(F.coalesce(F.sum("own"), F.lit(0))).first()[0]
    # 3. owners compare bytes and write the index
    share = F.col("from") + F.pmod(F.xxhash64("doc_id", "n_chars"), F.col("own")).cast("int")
    placed = texts.withColumn("slot", _prefix(bits, map_bits)).join(F.broadcast(hot), "h", "left") \
        .join(F.broadcast(slots), "slot", "left") \
        .select("doc_id", "n_chars", "norm", "h", F.coalesce(share, "owner").alias("owner"), F.col("own").isNotNull().alias("hot"))
    chains = placed.repartitionById(int(parts + extra), F.col("owner")) \
        .groupBy("owner", "hot", "h", "norm", "n_chars").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    index = scratch.cut(chains.select("h", "hot", "n_chars", "first", "n", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"),
                                      F.when(F.col("hot"), F.col("norm")).alias("norm")))
    # 4. one row a link; a digest that names two texts would end the job instead of merging them
    lengths = index.groupBy("h", "hot", "sha", "norm", "n_chars").agg(
        F.min("first").alias("first"), F.sum("n").alias("n"), F.count("*").alias("links"))
    lengths = lengths.withColumn("n", F.when(F.col("hot") | (F.col("links") == 1), F.col("n")).otherwise(
        F.raise_error(F.lit("two texts of one SHA-256")).cast("bigint")))
    links = lengths.groupBy("h", "sha").agg(F.max_by("first", "n_chars").alias("keep_id"), F.max("n_chars").alias("keep_chars"),
                                            F.sum("n").alias("group_size"))
    same = rows.groupBy("doc_id", "n_chars", "h", "sha").agg(F.count("*").alias("same"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars")) & (F.col("copy") == 1)
    return same.join(links, ["h", "sha"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("same").cast("int")))) \
        .select("doc_id", "n_chars", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def deduplicated(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of `docs` that stay, all columns."""
    stay = groups(docs, scratch).where("kept").select(
        F.struct("doc_id", "n_chars", "text_sha256").alias("_stay"))
    own = F.struct("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"),
                   F.sha2(_normal().cast("binary"), 256).alias("text_sha256"))
    return docs.withColumn("_own", own).join(stay, F.col("_own").eqNullSafe(F.col("_stay")), "left_semi") \
        .dropDuplicates(["_own"]).drop("_own")


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of all documents."""
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "exact")).drop("n_chars")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
g AS (SELECT norm, count(*) AS group_size, max(n_chars) AS longest FROM d GROUP BY norm),
k AS (SELECT d.norm, min(doc_id) AS keep_id FROM d JOIN g ON d.norm = g.norm AND d.n_chars = g.longest GROUP BY d.norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm JOIN k ON d.norm = k.norm
"""
