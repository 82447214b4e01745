"""Near-duplicate documents by MinHash sketches, banding and exact checks.

Sketching places the shingles of a document into `T` bins in rounds: in round
i < T a shingle falls into a bin chosen by the i-th hash, and a bin keeps the
least (round, hash) it meets; in round T + i all shingles fall into bin i. Once
every bin is filled the rest of the rounds is void, so a long document needs
about one round, and every coordinate is filled for certain. Two
sketches agree in a coordinate with probability J, concentrated like T
independent draws.

1. Documents with equal shingle sets form one class (least doc_id).
2. Classes are banded (`ROWS` coordinates a band). In each bucket every class is
   linked with the least class and with a class drawn by hash: a star each, not all pairs.
3. The links are confirmed on the full shingle sets; components are formed.
4. In buckets that still span several components, classes of different
   components are compared by their sketches, in tiles of `TILE` classes. A
   class that agrees in `CLOSE` of T coordinates or more with one of another
   component is checked on the full sets against all classes of that component,
   TILE to a task, so no pairs are listed. So every bucket's links are found or
   already implied. The chance that a pair at J = 0.75 shares
   no band is (1 - 0.75^4)^32 = 5e-6, that its sketches agree in fewer than
   CLOSE coordinates 1e-4.

Defined results: null texts and texts without words have an empty set and are
linked with nothing; fewer than five words form one shingle; repeated rows are
members of one class; an empty table gives an empty result; a null doc_id is
never the least; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from duka.llm.components import components
from duka.llm.scratch import Scratch
from duka.llm.words import byte_slices, mix64, ragged, word_codes

SHINGLE = 5
T = 128
ROWS = 4
CLOSE = 78      # 0.75 T less 3.7 standard deviations
TILE = 1024
SLICE = 1 << 20         # bytes of text that a task turns into shingles at once
TILE_BYTES = 4 << 20    # bytes of text in a tile of a component
HITS = 1 << 20          # (shingle, class) matches counted at once


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes): the sorted distinct 64-bit shingle hashes per text."""
    offsets, codes, words = word_codes(texts)
    table = np.array([xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()], np.uint64)
    h = mix64(table)[codes] if len(codes) else np.zeros(0, np.uint64)
    n = np.diff(offsets)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    at = ragged(offsets[:-1], count)
    owner = np.repeat(np.arange(len(n)), count)
    value = np.zeros(len(at), np.uint64)
    for k in range(width):
        inside = at + k < offsets[owner + 1]
        step = np.where(inside, h[np.minimum(at + k, max(0, len(h) - 1))] if len(h) else 0, np.uint64(k + 1))
        with np.errstate(over="ignore"):
            value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + step)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    first = np.r_[True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])][:len(value)]
    value, owner = value[first], owner[first]
    return np.r_[0, np.cumsum(np.bincount(owner, minlength=len(n)))].astype(np.int64), value


def sketches(offsets: np.ndarray, values: np.ndarray, t: int = T) -> np.ndarray:
    """(sets, t) coordinates by rounds of bin placement; empty sets: zeros."""
    n = len(offsets) - 1
    out = np.zeros((n, t), np.uint64)
    filled = np.zeros((n, t), bool)
    todo = np.flatnonzero(np.diff(offsets) > 0)
    for i in range(2 * t):
        if not len(todo):
            break
        sizes = offsets[todo + 1] - offsets[todo]
        x = values[ragged(offsets[todo], sizes)]
        h = mix64(x, i + 1)
        own = np.repeat(todo, sizes)
        cell = own * t + ((h >> np.uint64(40)) % np.uint64(t)).astype(np.int64) if i < t else own * t + (i - t)
        free = ~filled.reshape(-1)[cell]
        cell, h = cell[free], h[free]
        flat = out.reshape(-1)
        fresh = np.unique(cell)
        flat[fresh] = np.iinfo(np.uint64).max
        np.minimum.at(flat, cell, mix64(h, 7))
        filled.reshape(-1)[fresh] = True
        todo = todo[~filled[todo].all(1)]
    return out


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key, bands, sketch (one byte a coordinate)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", SLICE):
            offsets, values = shingle_sets(batch.column("text"))
            s = sketches(offsets, values)
            bands = np.full((len(s), T // ROWS), np.uint64(0))
            for r in range(ROWS):
                with np.errstate(over="ignore"):
                    bands = mix64(bands * np.uint64(0x9E3779B97F4A7C15) + s[:, r::ROWS])
            bands = mix64(bands + np.arange(T // ROWS, dtype=np.uint64)[None])
            low = (s & np.uint64(255)).astype(np.uint8)
            raw = values.tobytes()
            keys = [xxhash.xxh3_128_digest(raw[8 * a:8 * b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(keys, pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(s) + 1) * (T // ROWS), pa.int32()),
                                         pa.array(bands.reshape(-1).view(np.int64))),
                pa.array([r.tobytes() for r in low], pa.binary())],
                ["doc_id", "n_shingles", "set_key", "bands", "sketch"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, sketch binary")


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * common >= 75 * union."""
    joined = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(byte_slices(batches, "ta", SLICE // 2), "tb", SLICE // 2):
            n = batch.num_rows
            offsets, v = shingle_sets(pa.concat_arrays([batch.column("ta"), batch.column("tb")]))
            size = np.diff(offsets)
            pair = np.repeat(np.arange(2 * n) % n, size)
            order = np.lexsort((v, pair))
            v, pair = v[order], pair[order]
            same = (v[1:] == v[:-1]) & (pair[1:] == pair[:-1])
            common = np.bincount(pair[1:][same], minlength=n)
            good = 100 * common >= 75 * (size[:n] + size[n:] - common)
            keep = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([keep.column("a"), keep.column("b")], ["a", "b"])

    return joined.mapInArrow(run, "a bigint, b bigint")


def _runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) pieces of sorted batches; a key may come in several pieces."""
    for batch in batches:
        if batch.num_rows:
            t = pa.Table.from_batches([batch])
            key = np.stack([t.column(c).to_numpy().astype(np.int64) for c in names])
            cuts = np.r_[0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, t.num_rows]
            for x, y in zip(cuts[:-1], cuts[1:]):
                yield tuple(key[:, x]), t.slice(x, y - x)


def close_groups(open_: DataFrame) -> DataFrame:
    """(id, other): a class that is close, by sketches, to a class of the
    component `other` in some bucket. `open_`: bucket, id, root, size (of the component),
    sketch, major (a component of the bucket). Tiles: TILE classes outside
    `major` against TILE classes; the smaller component's class asks."""
    side = open_.withColumn("minor", F.col("root") != F.col("major"))
    counts = side.groupBy("bucket").agg(F.count("*").alias("n_all"), F.count_if("minor").alias("n_minor"))
    side = side.join(counts, "bucket")
    rows = F.ceil(F.col("n_all") / TILE).cast("int")
    cols = F.ceil(F.col("n_minor") / TILE).cast("int")
    kept = ["bucket", "id", "root", "size", "sketch", "minor"]

    def dealt(n, salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), n).cast("int")

    right = side.select(*kept, F.lit(False).alias("left"), dealt(rows, 1).alias("i"),
                        F.explode(F.sequence(F.lit(0), cols - 1)).alias("j"))
    left = side.where("minor").select(*kept, F.lit(True).alias("left"),
                                      F.explode(F.sequence(F.lit(0), rows - 1)).alias("i"), dealt(cols, 2).alias("j"))
    tiles = left.unionByName(right).repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "left")

    def groups_of(t: pa.Table) -> np.ndarray:
        mark = t.column("left").to_numpy(zero_copy_only=False)
        ids, roots, size = (t.column(c).to_numpy() for c in ("id", "root", "size"))
        s = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, T)
        a, b = np.flatnonzero(mark), np.flatnonzero(~mark)
        out = [np.zeros((2, 0), np.int64)]
        for k in range(0, len(a), 16):
            part = a[k:k + 16]
            agree = ((s[part][:, None] == s[b][None]).sum(2) >= CLOSE) & (roots[part][:, None] != roots[b][None])
            x, y = np.nonzero(agree)
            x, y = part[x], b[y]
            asks = (size[x] < size[y]) | (size[x] == size[y]) & (roots[x] > roots[y])
            out.append(np.unique(np.where(asks, np.stack([ids[x], roots[y]]), np.stack([ids[y], roots[x]])), axis=1))
        return np.unique(np.hstack(out), axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for key, t in _runs(batches, ("bucket", "i", "j")):
            if held and key != last:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in groups_of(pa.concat_tables(held))], ["id", "other"])
                held = []
            held.append(t)
            last = key
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in groups_of(pa.concat_tables(held))], ["id", "other"])

    return tiles.mapInArrow(run, "id bigint, other bigint").distinct()


def common_counts(v: np.ndarray, asker: np.ndarray, n: int, value: np.ndarray, owner: np.ndarray, classes: int) -> np.ndarray:
    """(n, classes): shingles that each asker has in common with each class. v, asker: the
    askers' shingles in their order; value, owner: the classes' shingles, sorted. At most HITS
    matches (or those of one shingle) are laid out at a time."""
    out = np.zeros((n, classes), np.int32)
    lo, hi = np.searchsorted(value, v), np.searchsorted(value, v, side="right")
    cut = np.cumsum(hi - lo) // HITS
    starts = np.r_[0, np.flatnonzero(np.diff(cut)) + 1, len(v)] if len(v) else np.zeros(1, int)
    for x, y in zip(starts[:-1], starts[1:]):
        first, last = asker[x], asker[y - 1]
        at = np.repeat(asker[x:y] - first, hi[x:y] - lo[x:y]) * classes + owner[ragged(lo[x:y], hi[x:y] - lo[x:y])]
        out[first:last + 1] += np.bincount(at, minlength=(last - first + 1) * classes).reshape(-1, classes).astype(np.int32)
    return out


def confirm_groups(groups: DataFrame, placed: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between class a and class b of the component it asks
    for: all its classes are checked on full sets, a tile of at most about TILE classes and
    TILE_BYTES of text to a task; one link for a class and tile is enough to join the
    components. `placed`: id, root, size, bytes (of the component)."""
    chunk_of = F.greatest(F.ceil(F.col("size") / TILE), F.ceil(F.col("bytes") / TILE_BYTES), F.lit(1)).cast("int")
    sizes = placed.groupBy("root").agg(F.max("size").alias("size"), F.max("bytes").alias("bytes"))
    asked = groups.select(F.col("other").alias("root")).distinct()
    right = placed.join(asked, "root", "left_semi").select(
        "root", F.pmod(F.xxhash64("id"), chunk_of).cast("int").alias("chunk"), F.lit(1).alias("asks"), "id")
    left = groups.select("id", F.col("other").alias("root")).join(sizes, "root").select(
        "root", F.explode(F.sequence(F.lit(0), chunk_of - 1)).alias("chunk"), F.lit(2).alias("asks"), "id")
    tiles = right.unionByName(left).join(texts, "id").repartition("root", "chunk").sortWithinPartitions("root", "chunk", "asks")

    def index_of(held: list[pa.Table]) -> tuple:
        """Ids, set sizes and the sorted shingles of a tile's classes."""
        ids, counts, values, owners = [], [], [], []
        for members in held:
            for part in byte_slices(iter(members.combine_chunks().to_batches()), "text", SLICE):
                offsets, v = shingle_sets(part.column("text"))
                counts.append(np.diff(offsets))
                owners.append(np.repeat(np.arange(len(counts[-1]), dtype=np.int32), counts[-1]) + np.int32(sum(map(len, ids))))
                ids.append(part.column("id").to_numpy())
                values.append(v)
        value, owner = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(value, kind="stable")
        return np.concatenate(ids), np.concatenate(counts), value[order], owner[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, index = None, [], None
        for key, t in _runs(batches, ("root", "chunk", "asks")):
            if key[2] == 1:     # classes of the component come first
                held = [*held, t] if key == last else [t]
                last, index = key, None
                continue
            if index is None:
                index, held = index_of(held), []
            ids, sizes_, value, owner = index
            for part in byte_slices(iter(t.combine_chunks().to_batches()), "text", SLICE // 4):
                offsets, v = shingle_sets(part.column("text"))
                n = np.diff(offsets)
                common = common_counts(v, np.repeat(np.arange(len(n)), n), len(n), value, owner, len(ids))
                good = 100 * common >= 75 * (n[:, None] + sizes_[None] - common)
                found = np.flatnonzero(good.any(1))
                a, b = part.column("id").to_numpy()[found], ids[good[found].argmax(1)]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return tiles.select("root", "chunk", "asks", "id", "text").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    every = scratch.cut(describe(docs))
    classes = scratch.cut(every.where("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    banded = classes.select("id", F.explode("bands").alias("bucket"))
    drawn = F.min(F.struct(F.xxhash64("id", "bucket").alias("h"), F.col("id"))).alias("drawn")
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("least"), drawn).where("n > 1")
    members = scratch.cut(banded.join(shared, "bucket").select("bucket", "id", "least", F.col("drawn.id").alias("drawn")))
    star = members.select("id", F.explode(F.array("least", "drawn")).alias("other")).where("id <> other")
    tried = scratch.cut(star.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct())
    # texts of classes with a partner; every later pair is made of these
    partners = members.select("id").distinct()
    texts = scratch.cut(docs.selectExpr("cast(doc_id as bigint) id", "cast(text as string) text").where(
        "id is not null and text is not null").join(partners, "id", "left_semi").groupBy("id").agg(F.min("text").alias("text")))
    linked = scratch.cut(confirm(tried, texts))
    roots = scratch.cut(components(linked, scratch))

    rooted = scratch.cut(texts.select("id", F.octet_length("text").cast("bigint").alias("own")).join(roots, "id", "left").select(
        "id", "own", F.coalesce("root", "id").alias("root")))
    sizes = rooted.groupBy("root").agg(F.count("*").alias("size"), F.sum("own").alias("bytes"))
    placed = scratch.cut(rooted.drop("own").join(sizes, "root"))
    in_bucket = members.select("bucket", "id").join(placed, "id")
    # buckets of two were settled by their star
    spread = in_bucket.groupBy("bucket").agg(
        F.max_by("root", F.struct("size", -F.col("root"))).alias("major"), F.min("root").alias("lo"),
        F.max("root").alias("hi"), F.count("*").alias("n")).where("lo < hi and n > 2")
    open_ = in_bucket.join(spread.select("bucket", "major"), "bucket").join(classes.select("id", "sketch"), "id")
    groups = scratch.cut(close_groups(open_))
    second = scratch.cut(confirm_groups(groups, placed, texts))
    # the second links join whole components, so only roots are contracted again
    root_of = placed.select("id", "root")
    between = second.join(root_of.toDF("a", "ra"), "a").join(root_of.toDF("b", "rb"), "b").select(
        F.col("ra").alias("a"), F.col("rb").alias("b"))
    joined = components(between, scratch).toDF("root", "top")
    final = scratch.cut(root_of.join(joined, "root", "left").select("id", F.coalesce("top", "root").alias("root")))

    classes = classes.select("set_key", "id").join(final, "id", "left").select(
        "set_key", F.coalesce("root", "id").alias("root"))
    own = every.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("root", "doc_id")).otherwise(F.col("doc_id"))
    return own.select("doc_id", "n_shingles", component.alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def deduplicated(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of `docs` less all but one document of each component. Rows
    without doc_id stay; rows that repeat a doc_id leave one."""
    kept = near_duplicates(docs, scratch).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    named = docs.where("doc_id is not null").join(kept, F.col("doc_id") == F.col("_kept"), "left_semi")
    return named.dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id is null"))


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "neardup"))
