"""Importance resampling towards a target distribution of hashed n-grams.

A 256-byte table lower-cases A-Z and blanks every ASCII byte that is no letter or digit, so
`bytes.translate` and `bytes.split` give the words of a UTF-8 text. The CRC-32 of a run of
words is chained from that of the run without its last word, Counters reduce the features of
a slice of texts, and a task sends one row per bucket it has seen.

A bucket's gain is the smoothed log ratio of its share in the target to its share in the
corpus (thousandths, rounded down). A document's weight is the sum of its features' gains,
and Gumbel noise from the hash of its id makes the highest scores a draw without replacement in
proportion to exp(weight). All documents are counted and scored; the bucket table
(BUCKETS numbers) is all that reaches the driver. Ranks come from range-partitioned rows.

Defined results: a null or empty text has no words, no features and weight 0; ranks go by
descending score, then doc_id with null last (its noise is that of the text `null`), and
repeated rows take a rank each; without eligible documents nothing is drawn; an empty target
makes gains from the smoothing alone; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from duka.llm.scratch import Scratch
from duka.llm.words import byte_slices
from duka.operators.numbering import dense_index

BUCKETS = 10_000
LONGEST = 1         # words in the longest feature
MIN_WORDS = 20      # a document with fewer is never drawn
PERCENT = 10        # of the eligible documents that are drawn
SEED = "2024"
KNOWN = 1 << 18     # words whose CRC a task remembers; the memory is emptied beyond

_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD else 0x20 for c in range(256))


class _Crc(dict):
    """CRC-32 of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN:
            self.clear()
        self[word] = value = crc32(word)
        return value


def split(text: bytes | None) -> list[bytes]:
    """The words of a UTF-8 text."""
    return text.translate(TABLE).split() if text else []


def feature_crcs(words: list[bytes], longest: int, known: _Crc) -> Iterator[list[int]]:
    """The CRC-32 of all runs of one word, of two words, and so on."""
    seeds = [known[w] for w in words]
    yield seeds
    for n in range(1, longest):
        seeds = [crc32(w, crc32(b" ", s)) for s, w in zip(seeds, words[n:])]
        yield seeds


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows of (text) by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = _Crc(), np.zeros(buckets, np.int64)
        for piece in byte_slices(batches, "text"):
            counts: Counter = Counter()
            for text in piece.column("text").cast(pa.binary()).to_pylist():
                for seeds in feature_crcs(split(text), longest, known):
                    counts.update(seeds)
            crcs = np.fromiter(counts.keys(), np.int64, len(counts))
            np.add.at(seen, crcs % buckets, np.fromiter(counts.values(), np.int64, len(counts)))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket bigint, n bigint") \
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln) of the smoothed ratio of target to source, for each bucket."""
    n = len(source)
    up, down = float(int(source.sum()) + n), float(int(target.sum()) + n)
    return [math.floor(1000 * math.log(((t + 1) * up) / ((s + 1) * down))) for s, t in zip(source.tolist(), target.tolist())]


def noise(doc_id: int | None, seed: str = SEED) -> int:
    """Gumbel noise in thousandths, from the hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: list[int], longest: int = LONGEST, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score for every row."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Crc()
        for piece in byte_slices(batches, "text"):
            rows = []
            for doc_id, text in zip(piece.column("doc_id").to_pylist(), piece.column("text").cast(pa.binary()).to_pylist()):
                words = split(text)
                n = weight = 0
                for seeds in feature_crcs(words, longest, known):
                    n += len(seeds)
                    weight += sum([gain[c % buckets] for c in seeds])
                rows.append((doc_id, len(words), n, weight, weight + noise(doc_id, seed)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                             ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def resample(docs: DataFrame, target: DataFrame, scratch: Scratch, longest: int = LONGEST, buckets: int = BUCKETS,
             min_words: int = MIN_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of `docs`; rank is null for those not drawn."""
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    scored = scratch.cut(scores(docs, gain, longest, seed))
    able = F.col("n_words") >= min_words
    drawn = scored.where(able).count() * percent // 100
    ranked = dense_index(scored.where(able), [F.desc("score"), F.asc_nulls_last("doc_id")], name="rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("bigint"))
    return ranked.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("bigint"))) \
        .select("doc_id", "n_features", "weight", "score", "rank")


def resampled(docs: DataFrame, target: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The rows of `docs` that are drawn, all columns."""
    drawn = resample(docs, target, scratch, **options).where("rank IS NOT NULL").select(F.col("doc_id").alias("_drawn"))
    return docs.join(drawn.distinct(), F.col("doc_id").eqNullSafe(F.col("_drawn")), "left_semi")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank of all documents, with `benchmark` as the target."""
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
                    Scratch(spark, "importance"))


# the CRC-32 of a word: a byte table made by eight halvings, then one look-up a byte
ORACLE = r"""
WITH RECURSIVE step(i, v, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END, k + 1 FROM step WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM step WHERE k = 8),
words AS (
  SELECT 'd' AS part, doc_id AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL
  SELECT 'b', 0, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
counted AS (SELECT part, id, w, count(*) AS n FROM words GROUP BY part, id, w),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode(w))),
             lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT)),
           lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])), 4294967295::BIGINT) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM counted), tab),
sums AS (SELECT bucket, coalesce(sum(n) FILTER (WHERE part = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE part = 'b'), 0)::DOUBLE AS t
         FROM counted JOIN hashed USING (w) GROUP BY bucket),
alls AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM sums),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000))))::BIGINT AS g FROM sums, alls),
weighed AS (SELECT id, sum(n)::BIGINT AS n, sum(n * g)::BIGINT AS weight
            FROM counted JOIN hashed USING (w) JOIN gain USING (bucket) WHERE part = 'd' GROUP BY id),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN weighed ON doc_id = id),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, 10 * count(*) OVER () // 100 AS k
           FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN r <= k THEN r END AS rank
FROM scored s LEFT JOIN ranked r ON s.doc_id = r.doc_id
"""
