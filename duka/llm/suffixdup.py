"""Removal of repeated byte strings with suffix arrays.

A byte is removed if a string of LENGTH bytes that covers it also starts
earlier (smaller doc_id, or the same document and an earlier start).

1. Every window of LENGTH bytes has an anchor: its GRAM-byte substring of least
   hash (leftmost). Equal windows have equal anchors at equal offsets, so
   equal windows meet among the occurrences of one anchor. Neighbouring windows
   share an anchor; their bytes are the anchor's context. One narrow row per
   anchor (about one in 40 bytes) is shuffled by the anchor's hash.
2. Sorted by (anchor, context hash, document, place), equal contexts follow
   each other: all but the first are repeats of it. This is done in each slice of texts
   before the shuffle, so a hot anchor is a few rows a slice, and once more behind it.
   The first ones are kept for step 3 if their anchor has several contexts;
   nothing is held in memory.
3. Two windows at offset o agree in the SIDE bytes left of the anchor (o >= SIDE)
   or in the SIDE bytes right of it. So a context goes to the groups (anchor,
   left bytes) and (anchor, right bytes); groups of one are done. The
   contexts of a group are fetched from the texts, cut to the windows whose hash
   occurs twice in the group (candidates only), and blocks of whole
   groups get a suffix array by linear grouping (`lyndon.py`). Windows that
   are neighbours in it and agree in LENGTH bytes form a run; all but the
   earliest of a run are repeats. A group of more than HOT contexts, which may
   exceed a block, is split by window: one narrow row (anchor, hash of the
   window, document, start) each; the earliest of equal ones is found by
   partial aggregation and joined back, so no task holds the group.
4. The repeated stretches of a document are united and cut out.

Contexts are compared by two 64-bit hashes in step 2, as are the windows of
split groups, and the others byte by byte in step 3. Memory: a batch in step 1,
2 and 4, a block (about `BLOCK` bytes) in step 3.

Defined results: null text has no bytes; rows that repeat a doc_id are one
document (neither is earlier); a row without doc_id keeps all and removes
nothing elsewhere; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from duka.llm.lyndon import suffix_array
from duka.llm.scratch import Scratch
from duka.llm.words import byte_slices, mix64, ragged

LENGTH = 100
GRAM = 24
SIDE = (LENGTH - GRAM) // 2
WIDE = LENGTH - GRAM + 1    # grams in a window
BLOCK = 1 << 17
HOT = BLOCK // (LENGTH + SIDE)      # contexts of a group in a block
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out)


class Hashes:
    """Hashes of substrings of one byte array, from prefix sums modulo 2^64."""

    def __init__(self, data: np.ndarray):
        with np.errstate(over="ignore"):
            self.sums = np.r_[np.uint64(0), np.cumsum((data + np.uint64(1)) * _powers(len(data), _INVERSE))]
            self.powers = _powers(len(data) + 1, _BASE)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.sums[stop] - self.sums[start]) * self.powers[start] + (stop - start).astype(np.uint64), 3)

    def grams(self, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.sums[n:] - self.sums[:-n]) * self.powers[:len(self.sums) - n], 1)


def anchors(data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Anchors of texts laid end to end: doc (number of the text), lo and hi
    (first and last window, in the text), at (the anchor), hash, context, left, right."""
    starts = np.r_[0, ends[:-1]].astype(np.int64)
    long_ = np.flatnonzero(ends - starts >= LENGTH)
    if not len(long_):
        return {c: np.zeros(0, np.int64) for c in ("doc", "lo", "hi", "at", "hash", "context", "left", "right")}
    h = Hashes(data)
    g = h.grams(GRAM)
    least, span = g, 1
    while span * 2 <= WIDE:
        least = np.minimum(least[:len(least) - span], least[span:])
        span *= 2
    least = np.minimum(least[:len(g) - WIDE + 1], least[WIDE - span:])     # least[p]: over the window at p
    step = np.zeros(len(least) + 1, np.int8)
    step[starts[long_]] += 1
    step[ends[long_] - LENGTH + 1] -= 1
    valid = np.cumsum(step[:-1], dtype=np.int8) > 0
    edge = np.r_[True, least[1:] != least[:-1]]
    edge[starts[long_]] = True
    edge[np.minimum(ends[long_] - LENGTH + 1, len(edge) - 1)] = True
    lo = np.flatnonzero(edge)
    hi = np.r_[lo[1:], len(least)] - 1
    lo, hi = lo[valid[lo]], hi[valid[lo]]
    done = []
    while len(lo):
        at = lo.copy()
        for k in range(0, len(lo), 1 << 14):    # the first gram of least hash in the run's first window
            s = lo[k:k + (1 << 14)]
            at[k:k + (1 << 14)] += (g[s[:, None] + np.arange(WIDE)[None]] == least[s][:, None]).argmax(1)
        done.append(np.stack([lo, np.minimum(hi, at), at]))
        more = hi > at      # windows behind it have their own least gram of the same hash
        lo, hi = at[more] + 1, hi[more]
    lo, hi, at = np.hstack(done)
    doc = np.searchsorted(ends, lo, side="right")
    first, stop = starts[doc], ends[doc]
    lost = mix64(lo.astype(np.uint64) + np.uint64(len(data)))     # a key that nothing shares
    left = np.where(at - lo >= SIDE, h.of(np.maximum(at - SIDE, first), at), lost)
    right = np.where(at - hi < SIDE, h.of(at + GRAM, np.minimum(at + GRAM + SIDE, stop)), lost)
    return {"doc": doc, "lo": lo - first, "hi": hi - first, "at": at - first, "hash": g[at].view(np.int64),
            "context": h.of(lo, hi + LENGTH).view(np.int64), "left": (left >> np.uint64(32)).astype(np.int64),
            "right": (right >> np.uint64(32)).astype(np.int64)}


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, ends, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, ends[1:] - ends[0]


def anchor_rows(docs: DataFrame) -> DataFrame:
    """kind, hash, context, sides (left and right, 32 bits each), doc_id, place
    (lo * 2^16 + (hi - lo) * 2^8 + (at - lo)). Of equal contexts in one slice of texts only
    the first goes on to meet those of other slices (kind 1); the others are repeats already (kind 0, with a
    hash of their own place), so a very common context is a row per slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            a = anchors(*_bytes(batch.column("text")))
            doc = batch.column("doc_id").to_numpy()[a["doc"]]
            place = (a["lo"] << 16) | (a["hi"] - a["lo"] << 8) | (a["at"] - a["lo"])
            order = np.lexsort((place, doc, a["context"], a["hash"]))
            hash_, context, sides, doc, place = (c[order] for c in (
                a["hash"], a["context"], (a["left"] << 32) | a["right"], doc, place))
            first = np.r_[True, (hash_[1:] != hash_[:-1]) | (context[1:] != context[:-1])][:len(doc)]
            owner = np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))
            kept = first | (doc != doc[owner]) | (place != place[owner])
            own = mix64(doc.view(np.uint64) ^ mix64(place.view(np.uint64))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (
                first.astype(np.int8), np.where(first, hash_, own), context, sides, doc, place)],
                ["kind", "hash", "context", "sides", "doc_id", "place"])

    return docs.where("doc_id is not null").mapInArrow(
        run, "kind tinyint, hash bigint, context bigint, sides bigint, doc_id bigint, place bigint")


def repeats(rows: DataFrame) -> DataFrame:
    """Sorted anchor rows -> kind 0: a repeated stretch (doc_id, place = start,
    extra = end); kind 1: a first context of an anchor with several."""
    ordered = rows.repartition("hash").sortWithinPartitions("kind", "hash", "context", "doc_id", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of the last row so far: its hash, context; the first of its context; the first of its anchor, if unsent
        names = ("hash", "context", "sides", "doc_id", "place")
        sent_on = ["kind", "hash", "sides", "doc_id", "place", "extra"]
        held = None
        for batch in batches:
            known = batch.column("kind").to_numpy() == 0
            if known.any():
                doc, place = (batch.column(n).to_numpy()[known] for n in ("doc_id", "place"))
                none, lo = np.zeros(len(doc), np.int64), place >> 16
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                    none, none, none, doc, lo, lo + (place >> 8 & 255) + LENGTH)], sent_on)
                batch = batch.filter(pa.array(~known))
            if not batch.num_rows:
                continue
            c = [batch.column(n).to_numpy() for n in names]
            if held is not None:
                c = [np.r_[x, y] for x, y in zip(held[0], c)]
            hash_, context, sides, doc, place = c
            anchor = np.r_[True, hash_[1:] != hash_[:-1]]
            new = anchor | np.r_[True, context[1:] != context[:-1]]
            owner = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            copy = ~new & ((doc != doc[owner]) | (place != place[owner]))
            if held is not None:
                copy[:len(held[0][0])] = False
            lo = place[copy] >> 16
            n_anchor = np.cumsum(anchor) - 1
            several = np.bincount(n_anchor, new) > 1
            first = new & several[n_anchor]
            if held is not None:        # rows carried over: the anchor's first context, then the last context's first
                first[:len(held[0][0])] &= ~np.array(held[1])
            out = [np.r_[np.zeros(copy.sum(), np.int64), np.ones(first.sum(), np.int64)],
                   *[np.r_[np.zeros(copy.sum(), np.int64), x[first]] for x in (hash_, sides)],
                   np.r_[doc[copy], doc[first]], np.r_[lo, place[first]],
                   np.r_[lo + (place[copy] >> 8 & 255) + LENGTH, np.zeros(first.sum(), np.int64)]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], sent_on)
            # carry the open anchor: its first context (sent or not) and the open context's first row
            a, b = np.flatnonzero(anchor)[-1], owner[-1]
            keep = [a, b] if a != b else [a]
            sent = [bool(first[k]) or (held is not None and k < len(held[0][0]) and held[1][k]) for k in keep]
            held = ([x[keep] for x in c], sent)

    return ordered.mapInArrow(run, "kind bigint, hash bigint, sides bigint, doc_id bigint, place bigint, extra bigint")


def contexts(firsts: DataFrame, docs: DataFrame) -> DataFrame:
    """The contexts of groups with several members: hash, side, key, doc_id,
    start, bytes. Of groups of more than HOT members: their windows, with the
    window's hash as key and without bytes."""
    side = F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.shiftrightunsigned("sides", 32).alias("key")),
        F.struct(F.lit(1).alias("side"), F.col("sides").bitwiseAND(0xFFFFFFFF).alias("key")))).alias("s")
    start, span, off = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255), F.col("place").bitwiseAND(255)
    n = firsts.select("hash", "doc_id", start.alias("lo"), (start + span).alias("hi"), (start + off).alias("at"), side) \
        .select("hash", "s.side", "s.key", "doc_id",
                F.when(F.col("s.side") == 0, F.col("lo")).otherwise(F.greatest(F.col("lo"), F.col("at") - SIDE + 1)).alias("a"),
                F.when(F.col("s.side") == 0, F.least(F.col("hi"), F.col("at") - SIDE)).otherwise(F.col("hi")).alias("b")) \
        .where("a <= b")
    shared = n.groupBy("hash", "side", "key").agg(F.count("*").alias("n")).where("n > 1") \
        .select("hash", "side", "key", (F.col("n") > HOT).alias("split"))
    wanted = n.join(shared, ["hash", "side", "key"]).groupBy("doc_id").agg(
        F.collect_list(F.struct("hash", "side", "key", "a", "b", "split")).alias("need"))
    held = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min("text").alias("text")).join(wanted, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text", 1 << 20):
            data, ends = _bytes(batch.column("text"))
            begin = np.r_[0, ends[:-1]]
            need = batch.column("need")
            owner = np.repeat(np.arange(len(need)), need.value_lengths().to_numpy())
            flat = need.flatten()
            col = {c: flat.field(c).to_numpy(zero_copy_only=False) for c in ("hash", "side", "key", "a", "b", "split")}
            col["doc_id"] = batch.column("doc_id").to_numpy()[owner]
            raw = data.tobytes()
            base, stop = begin[owner], ends[owner]
            whole = np.flatnonzero(~col["split"])
            cut = [raw[x:y] for x, y in zip((base + col["a"])[whole].tolist(), (base + col["b"] + LENGTH)[whole].tolist())]
            names = ["hash", "side", "key", "doc_id", "start", "bytes"]
            yield pa.RecordBatch.from_arrays([*[pa.array(col[c][whole]) for c in ("hash", "side", "key", "doc_id", "a")],
                                              pa.array(cut, pa.binary())], names)
            if not col["split"].any():
                continue
            h, split = Hashes(data), np.flatnonzero(col["split"])
            for k in range(0, len(split), 1 << 14):
                s = split[k:k + (1 << 14)]
                last = np.minimum(col["b"][s], stop[s] - base[s] - LENGTH)
                n = np.maximum(0, last - col["a"][s] + 1)
                start, s = ragged(col["a"][s], n), np.repeat(s, n)
                key = h.of(base[s] + start, base[s] + start + LENGTH).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                    col["hash"][s], col["side"][s], key, col["doc_id"][s], start)] + [pa.nulls(len(s), pa.binary())], names)

    return held.select("doc_id", "text", "need").mapInArrow(
        run, "hash bigint, side int, key bigint, doc_id bigint, start bigint, bytes binary")


def repeated_windows(parts: list[bytes], doc: np.ndarray, start: np.ndarray) -> list[tuple[int, int, int]]:
    """(doc, start, end) of stretches whose every window of LENGTH bytes
    also starts earlier in another of the parts, by the parts' suffix array."""
    size = np.array([len(p) for p in parts])
    data = np.frombuffer(b"\0".join(parts), np.uint8)      # ends of parts only part equal windows, as tests below
    first = np.cumsum(np.r_[0, size[:-1] + 1])
    owner = np.repeat(np.arange(len(parts)), size + 1)[:len(data)]
    room = first[owner] + size[owner] - np.arange(len(data))
    order = suffix_array(data)
    order = order[room[order] >= LENGTH]
    same = np.zeros(len(order), bool)
    reach = np.arange(LENGTH)[None]
    for k in range(1, len(order), 4096):
        x, y = order[k - 1:k + 4095], order[k:k + 4096]
        x = x[:len(y)]
        same[k:k + len(y)] = (data[x[:, None] + reach] == data[y[:, None] + reach]).all(1)
    run = np.cumsum(~same) - 1
    d, s = doc[owner[order]], start[owner[order]] + order - first[owner[order]]
    rank = np.lexsort((s, d, run))
    lead = np.r_[True, run[rank][1:] != run[rank][:-1]]
    head = rank[np.maximum.accumulate(np.where(lead, np.arange(len(rank)), 0))]
    later = (d[rank] != d[head]) | (s[rank] != s[head])
    d, s = d[rank][later], s[rank][later]
    rank = np.lexsort((s, d))
    d, s = d[rank], s[rank]
    edge = np.r_[True, (d[1:] != d[:-1]) | (s[1:] > s[:-1] + LENGTH)]
    at = np.flatnonzero(edge)
    end = np.r_[at[1:], len(s)] - 1
    return list(zip(d[at].tolist(), s[at].tolist(), (s[end] + LENGTH).tolist())) if len(s) else []


def trimmed(parts: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lo, hi): the first and last window of each part (of LENGTH bytes or more) that by its
    hash may occur elsewhere in the part's group; hi is -1 where there is none."""
    size = np.array([len(p) for p in parts])
    first, count = np.cumsum(np.r_[0, size[:-1]]), size - LENGTH + 1
    at, own = ragged(first, count), np.repeat(np.arange(len(parts)), count)
    with np.errstate(over="ignore"):
        h = Hashes(np.frombuffer(b"".join(parts), np.uint8)).of(at, at + LENGTH) + mix64(group[own].astype(np.uint64), 5)
    _, same, times = np.unique(h, return_inverse=True, return_counts=True)
    shared = times[same] > 1
    own, place = own[shared], (at - first[own])[shared]
    lo, hi = np.zeros(len(parts), np.int64), np.full(len(parts), -1)
    if len(own):
        ends = np.r_[np.flatnonzero(own[1:] != own[:-1]), len(own) - 1]
        starts = np.r_[0, ends[:-1] + 1]
        lo[own[starts]], hi[own[ends]] = place[starts], place[ends]
    return lo, hi


def compared(rows: DataFrame) -> DataFrame:
    """doc_id, place, extra: repeated stretches of the contexts of every group."""
    ordered = rows.where("bytes is not null").repartition("hash", "side", "key").sortWithinPartitions("hash", "side", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[pa.RecordBatch] = []
        size, last = 0, None

        def emit() -> pa.RecordBatch:
            t = pa.Table.from_batches(block)
            parts, doc, start = t.column("bytes").to_pylist(), t.column("doc_id").to_numpy(), t.column("start").to_numpy()
            key = np.stack([t.column(c).to_numpy().astype(np.int64) for c in ("hash", "side", "key")])
            lo, hi = trimmed(parts, np.cumsum(np.r_[True, (key[:, 1:] != key[:, :-1]).any(0)]))
            some = np.flatnonzero(hi >= 0)
            parts = [parts[k][a:b + LENGTH] for k, a, b in zip(some.tolist(), lo[some].tolist(), hi[some].tolist())]
            found = repeated_windows(parts, doc[some], (start + lo)[some]) if parts else []
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(3)],
                                              ["doc_id", "place", "extra"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("hash", "side", "key")])
            cuts = np.r_[0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, batch.num_rows]
            length = np.cumsum(np.r_[0, pc.binary_length(batch.column("bytes")).to_numpy()])
            begin = 0
            for x, y in zip(cuts[:-1], cuts[1:]):
                now = tuple(key[:, x])
                if now != last and size + length[x] - length[begin] > BLOCK:
                    if x > begin:
                        block.append(batch.slice(begin, x - begin))
                    yield emit()
                    block, size, begin = [], 0, x
                last = now
            block.append(batch.slice(begin))
            size += length[-1] - length[begin]
        if block:
            yield emit()

    return ordered.mapInArrow(run, "doc_id bigint, place bigint, extra bigint")


def later_windows(rows: DataFrame) -> DataFrame:
    """doc_id, place, extra: the windows of split groups that start earlier too."""
    w = rows.where("bytes is null").select("hash", "key", F.struct("doc_id", "start").alias("at"))
    first = w.groupBy("hash", "key").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first < last").drop("last")
    return w.join(first, ["hash", "key"]).where("at > first").select(
        "at.doc_id", F.col("at.start").alias("place"), (F.col("at.start") + LENGTH).alias("extra"))


def united(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches united where they overlap or touch, ascending."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    edge = np.r_[True, begin[1:] > end[:-1]]
    return begin[edge], end[np.r_[np.flatnonzero(edge)[1:], len(end)] - 1]


def cut_out(docs: DataFrame, stretches: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept of every row."""
    listed = stretches.groupBy("doc_id").agg(F.collect_list(F.struct("place", "extra")).alias("cut"))
    joined = docs.join(listed, "doc_id", "left").select("doc_id", "text", "cut")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            rows = []
            for text, cut in zip(batch.column("text"), batch.column("cut")):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                begin, end = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if cut.is_valid:
                    begin, end = united(*[cut.values.field(c).to_numpy() for c in ("place", "extra")])
                kept = b"".join([raw[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(raw)])])
                rows.append((len(raw), len(raw) - len(kept), len(begin), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.string()))]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The result of cutting every repeated string out of every document."""
    d = docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text")
    found = scratch.cut(repeats(anchor_rows(d)))
    scratch.settle()
    parts = scratch.cut(contexts(found.where("kind = 1").drop("kind", "extra"), d))
    scratch.settle()
    more = scratch.cut(compared(parts).unionByName(later_windows(parts)))
    scratch.drop(parts)
    scratch.settle()
    return cut_out(d, found.where("kind = 0").select("doc_id", "place", "extra").unionByName(more))


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes cut out of all documents."""
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "suffix"))
