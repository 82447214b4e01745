"""Prefix trie of conversations by range minima over sorted LCPs.

Rebuilt conversations become strings of turn digests and are range-partitioned in that
order, so every prefix owns one interval of rows. A task goes through its range in blocks: a
sparse table over the LCPs of neighbouring rows lets each candidate prefix (a row and a depth
that its predecessor does not share) binary-search its left and right extent independently of all
others, and prefix sums over the rows give what a node needs of its interval.

Everything a node reports is a sum or a minimum over its rows: members; tokens of members from
the node's depth on; and, for each row, what it is the first (new prefixes, their tokens) or
the last to hold (a leaf). So a node over several blocks is the sum of its parts, one part a
block, however many rows share it. What a range's first and last row add depends on the
neighbouring ranges and is worked out on one row per range.

A node's ends come as joined strings, one a block, and are hashed in order as a stream.

Defined results: rows without conv_id take no part; null role or text is empty; turns are
ordered by turn (null first), equal turn numbers by the turn's digest, so repeated rows are turns of
their own; `c - c % 20` truncates towards zero for negative ids; a conversation without turns of
its own left is a member of the root and ends there; an empty table has no nodes; other columns are
ignored. A conversation's digests (32 bytes a turn) are handled as one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from duka.llm.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
SHARED = 4          # a conversation takes fewer than this many turns of its base
FAMILY = 20         # conversations that share a base
BLOCK = 1 << 16     # turns in a block
DIGEST = 32         # hex digits of a turn's digest
ROOT = hashlib.sha256(b"").hexdigest()[:DIGEST]
EMPTY = hashlib.sha256(b"").hexdigest()

PART = ("id string, parent string, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "held bigint, own bigint")
NAMES = [c.split()[0] for c in PART.split(", ")]
RANGE = "pid int, first string, first_words array<bigint>, last string, seq bigint, ends string"


def rebuilt(conversations: DataFrame, shared: int = SHARED, family: int = FAMILY) -> DataFrame:
    """(conv_id, key, words): the digests of the rebuilt conversation's turns, and their words."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.struct(
            F.col("turn"), F.substring(F.sha2(F.concat_ws(":", F.octet_length(role), role, text), 256), 1, DIGEST).alias("digest"),
            F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words")).alias("t"))
    convs = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("own")) \
        .withColumns({"base": F.col("conv_id") - F.col("conv_id") % family,
                      "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")})
    starts = convs.where("conv_id = base").select("base", F.slice("own", 1, shared).alias("start"))
    both = F.concat(F.expr("coalesce(slice(start, 1, h), slice(own, 1, 0))"), F.expr("slice(own, h + 1, greatest(size(own) - h, 0))"))
    return convs.join(starts, "base", "left").withColumn("turns", both) \
        .select("conv_id", F.array_join("turns.digest", "").alias("key"), F.col("turns.words").alias("words"))


def common(a: str | None, b: str | None) -> int:
    """Turns that two keys share from the start; -1 beside nothing."""
    if a is None or b is None:
        return -1
    lo, hi = 0, min(len(a), len(b)) // DIGEST
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid * DIGEST] == b[:mid * DIGEST] else (lo, mid - 1)
    return lo


def path_ids(key: str, known: list[str] = (), upto: int = 0) -> list[str]:
    """Node ids along a key from the root; the first `upto` turns are those of `known`."""
    ids = [*known[:upto + 1]] or [ROOT]
    for k in range(len(ids) - 1, len(key) // DIGEST):
        ids.append(hashlib.sha256((ids[-1] + key[k * DIGEST:(k + 1) * DIGEST]).encode()).hexdigest()[:DIGEST])
    return ids


def sparse_minima(x: np.ndarray) -> list[np.ndarray]:
    """Level k holds the minima of all runs of 2^k."""
    levels = [x]
    while len(levels[-1]) > 1 << (len(levels) - 1):
        last, step = levels[-1], 1 << (len(levels) - 1)
        levels.append(np.minimum(last[:-step], last[step:]))
    return levels


def extents(lcp: np.ndarray, rows: np.ndarray, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of the interval around each row whose rows share `depth` turns;
    lcp[i] is what rows i and i + 1 share."""
    left, right = rows.copy(), rows.copy()
    levels = sparse_minima(lcp) if len(lcp) else []
    for k in range(len(levels) - 1, -1, -1):
        step, low = 1 << k, levels[k]
        at = np.minimum(right, len(low) - 1)
        right += step * ((right < len(low)) & (low[at] >= depths))
        at = np.maximum(left - step, 0)
        left -= step * ((left >= step) & (low[np.minimum(at, len(low) - 1)] >= depths))
    return left, right


def minima(x: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least of x[left..right], for each pair."""
    levels = sparse_minima(x)
    k = np.frexp((right - left + 1).astype(float))[1] - 1
    out = np.empty(len(left), x.dtype)
    for level in np.unique(k):
        m = k == level
        out[m] = np.minimum(levels[level][left[m]], levels[level][right[m] - (1 << level) + 1])
    return out


def first_row(key: str, words: list[int], shared: int) -> list[tuple]:
    """What a row whose predecessor shares `shared` turns adds to its prefixes as the first to hold the rest."""
    ids, n = path_ids(key), len(words)
    rest = np.cumsum([0, *words[::-1]])[::-1]       # rest[d]: words from turn d on
    return [(ids[d], ids[d - 1] if d else None, d, None, 0, int(shared <= d < n), 0, 0, int(rest[max(d - 1, shared, 0)]))
            for d in range(n + 1)]


def last_row(key: str, shared: int) -> list[tuple]:
    """What a row whose successor shares `shared` turns adds to its prefixes if a leaf ends with it."""
    ids = path_ids(key)
    return [(i, ids[d - 1] if d else None, d, None, 0, 0, 1, 0, 0) for d, i in enumerate(ids)] if shared < len(ids) - 1 or shared < 0 else []


def block_nodes(convs: list[int], keys: list[str], words: list[list[int]]) -> tuple[pa.RecordBatch, list[str]]:
    """The parts of all nodes within a block of sorted rows, without what its first row is the
    first and its last row the last to hold; and the id of each row's end."""
    m = len(keys)
    lens = np.array([len(w) for w in words], np.int64)
    lcp = np.array([common(a, b) for a, b in zip(keys, keys[1:])], np.int64)
    ids, parents, ends, at = [], [], [], []
    path: list[str] = []
    before = np.r_[-1, lcp]
    for key, shared in zip(keys, before.tolist()):
        path = path_ids(key, path, shared) if shared >= 0 else path_ids(key)
        ids += path[shared + 1:]
        parents += [None, *path][shared + 1:-1]
        ends.append(path[-1])
    counts = lens - before
    row = np.repeat(np.arange(m), counts)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(before, counts) + 1
    left, right = extents(lcp, row, depth)
    n = right - left + 1
    # running words along each row, and over the rows
    flat = np.array([w for x in words for w in x], np.int64)
    start, run = np.cumsum(lens) - lens, np.r_[0, np.cumsum(flat)]
    total = run[start + lens] - run[start]
    above = run[start[left] + np.maximum(depth - 1, 0)] - run[start[left]]
    held = np.r_[0, np.cumsum(total)][right + 1] - np.r_[0, np.cumsum(total)][left] - n * above
    inner = left > 0        # the block's first row is left to `first_row`
    new = total - (run[start + np.maximum(before, 0)] - run[start])
    new[0] = 0
    sums = np.cumsum(new)
    own = sums[right] - sums[left] + np.where(inner, total[left] - above, 0)
    opens = np.flatnonzero((lens > before) & (np.arange(m) > 0))
    codes = np.sort(before[opens] * (m + 1) + opens)
    children = np.searchsorted(codes, depth * (m + 1) + right, "right") - np.searchsorted(codes, depth * (m + 1) + left, "right")
    children = children + (inner & (lens[left] > depth))
    leaf = np.r_[0, np.cumsum(np.r_[lcp < lens[:-1], False])]
    leaves = leaf[right + 1] - leaf[left]
    first = minima(np.array(convs, np.int64), left, right)
    columns = [pa.array(ids, pa.string()), pa.array(parents, pa.string()), *[pa.array(c.astype(np.int64)) for c in (
        depth, first, n, children, leaves, held, own)]]
    return pa.RecordBatch.from_arrays(columns, NAMES), ends


def _blocks(batches: Iterator[pa.RecordBatch], turns: int) -> Iterator[tuple[list, list, list]]:
    convs, keys, words, size = [], [], [], 0
    for batch in batches:
        for c, k, w in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "key", "words")]):
            if size >= turns:
                yield convs, keys, words
                convs, keys, words, size = [], [], [], 0
            convs.append(c)
            keys.append(k)
            words.append(w)
            size += len(w) + 1
    if convs:
        yield convs, keys, words


def _parts(turns: int):
    """One pass over a sorted range: node parts, end strings, and one row on the range's borders."""
    schema = pa.schema([*[(n, pa.string() if n in ("id", "parent") else pa.int64()) for n in NAMES], ("pid", pa.int32()),
                        ("first", pa.string()), ("first_words", pa.list_(pa.int64())), ("last", pa.string()),
                        ("seq", pa.int64()), ("ends", pa.string())])

    def rows(values: list[tuple], names: list[str]) -> pa.RecordBatch:
        given = dict(zip(names, zip(*values)))
        return pa.RecordBatch.from_arrays([pa.array(given[f.name], f.type) if f.name in given else pa.nulls(len(values), f.type)
                                           for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opening, last = None, None
        for convs, keys, words in _blocks(batches, turns):
            nodes, ends = block_nodes(convs, keys, words)
            yield pa.RecordBatch.from_arrays([nodes.column(f.name) if f.name in NAMES else pa.nulls(nodes.num_rows, f.type)
                                              for f in schema], schema=schema)
            if last is None:
                opening = keys[0], words[0]
            else:
                between = common(last, keys[0])
                yield rows(first_row(keys[0], words[0], between) + last_row(last, between), NAMES)
            starts = [0, *[k for k in range(1, len(ends)) if ends[k] != ends[k - 1]], len(ends)]
            yield rows([(ends[a], convs[a], ",".join(map(str, convs[a:b]))) for a, b in zip(starts, starts[1:])], ["id", "seq", "ends"])
            last = keys[-1]
        if last is not None:
            yield rows([(TaskContext.get().partitionId(), *opening, last)], ["pid", "first", "first_words", "last"])

    return run


def _border_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for before, first, words, last, after in zip(*[batch.column(c).to_pylist() for c in (
                "before", "first", "first_words", "last", "after")]):
            got = first_row(first, words, common(before, first)) + last_row(last, common(last, after))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n in ("id", "parent") else pa.int64())
                                              for n, c in zip(NAMES, zip(*got))], NAMES)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined strings of each id; rows come by id and in order."""
    current, digest = None, None
    for batch in batches:
        done = []
        for i, text in zip(batch.column("id").to_pylist(), batch.column("ends").to_pylist()):
            if i != current:
                if digest is not None:
                    done.append((current, digest.hexdigest()))
                current, digest = i, hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], ["id", "ends_sha256"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current]), pa.array([digest.hexdigest()])], ["id", "ends_sha256"])


def trie(conversations: DataFrame, scratch: Scratch, turns: int = BLOCK) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    convs = scratch.cut(rebuilt(conversations))
    parts = scratch.cut(convs.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
                        .mapInArrow(_parts(turns), f"{PART}, {RANGE}"))
    in_order = Window.orderBy("pid")        # one row per range
    borders = parts.where("pid IS NOT NULL").select(
        F.lag("last").over(in_order).alias("before"), "first", "first_words", "last", F.lead("first").over(in_order).alias("after"))
    every = parts.where("depth IS NOT NULL").select(*NAMES).union(borders.mapInArrow(_border_parts, PART))
    nodes = scratch.cut(every.groupBy("id", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in NAMES[4:]]))
    ends = parts.where("ends IS NOT NULL").select("id", "seq", "ends").repartition("id") \
        .sortWithinPartitions("id", "seq").select("id", "ends").mapInArrow(_hash_ends, "id string, ends_sha256 string")
    up = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(up, "parent", "left").join(ends, "id", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("held") - F.col("own")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


def op13_prefixtrie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie over `conversations`."""
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), Scratch(spark, "prefixtrie"))


# h by the CRC-32 of the decimal id: a byte table made by eight halvings, then one look-up a byte
ORACLE = r"""
WITH RECURSIVE step(i, v, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END, k + 1 FROM step WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS t FROM step WHERE k = 8),
t AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST,
                       sha256(concat(octet_length(encode(role)), ':', role, ':', text))) AS own
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
  WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (
  SELECT conv_id, own, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(conv_id::VARCHAR)),
               lambda i: ascii(substr(conv_id::VARCHAR, (i + 1)::BIGINT, 1))::BIGINT)),
             lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])), 4294967295::BIGINT) % 4 AS h
  FROM t, tab),
r AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.own, 1, c.h), []), coalesce(list_slice(c.own, c.h + 1, len(c.own)), [])) AS turns
  FROM h c LEFT JOIN t b ON b.conv_id = c.base),
p AS (SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM r),
q AS (SELECT conv_id, n, depth, list_slice(turns, 1, depth) AS path, list_slice(turns, 1, depth - 1) AS up FROM p),
nodes AS (
  SELECT path, depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256,
         (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS spared
  FROM q GROUP BY path, depth),
kids AS (SELECT up, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY up),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.up = n.path),
above AS (SELECT list_slice(path, 1, d) AS top, n_children, spared
          FROM (SELECT path, n_children, spared, unnest(range(0, depth + 1)) AS d FROM full_nodes)),
sub AS (SELECT top, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(spared)::BIGINT AS saved_tokens FROM above GROUP BY top)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sub s ON s.top = n.path LEFT JOIN nodes u ON n.depth > 0 AND u.path = n.up
"""
