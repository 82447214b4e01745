"""Document fingerprints: a Merkle tree over paragraphs and sections.

A paragraph is a line; its leaves are stretches of about 32 characters that
end at a word or sentence end. A section is a run of paragraphs that ends at a
paragraph whose hash says so, so an edit moves no later section border. A
paragraph's hash is over its leaves, a section's over its paragraphs, the
root over the sections.

The fingerprint is text: the root, then per section `|`, its hash, and per
paragraph `/` and its leaves' hashes. Equal roots mean equal texts; else equal
sections are skipped and only the leaves of differing ones are compared.
`differences` gives the places of differing sections and paragraphs; the query
returns those of the edited text.

Defined results: null text is the empty text (root only); an empty text is
like nothing but an empty text; repeated rows follow each other; the last
document is followed by the first (a lone one by itself); a null doc_id sorts
last; rows of one doc_id are ordered by a hash of their text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

_LEAF = re.compile(r"[^.!?\s]\S{0,15}(?:[^\S.!?][^\s.!?]*|\S){0,6}[.!?\s]*|[.!?\s]+")
LEAF_HEX = 12      # hex digits that the fingerprint keeps of a leaf's hash
ROWS_PER_RANGE = 4096
MAX_RANGES = 20_000     # a number of partitions; every row has its range


def leaves(paragraph: str) -> list[str]:
    """Stretches that concatenate to the paragraph."""
    return _LEAF.findall(paragraph)


def fingerprint(text: str | None) -> str:
    """Root and branch hashes of a text."""
    sections, paragraphs, digests, total = [], [], hashlib.sha256(), hashlib.sha256()

    def close() -> None:
        d = digests.digest()
        total.update(d)
        sections.append("|" + d[:4].hex() + "".join(paragraphs))

    for line in text.split("\n") if text else ():
        parts = [xxhash.xxh3_64_digest(leaf) for leaf in leaves(line)]
        own = hashlib.sha256(b"".join(parts)).digest()
        digests.update(own)
        paragraphs.append("/" + "".join([p[:LEAF_HEX // 2].hex() for p in parts]))
        if own[0] % 4 == 0:
            close()
            paragraphs, digests = [], hashlib.sha256()
    if paragraphs:
        close()
    return total.hexdigest()[:32] + "".join(sections)


def _sections(print_: str) -> Counter:
    return Counter(print_.split("|")[1:])


def _leaf_counts(sections: Counter) -> Counter:
    out: Counter = Counter()
    for section, n in sections.items():
        for paragraph in section.split("/")[1:]:
            for k in range(0, len(paragraph), LEAF_HEX):
                out[paragraph[k:k + LEAF_HEX]] += n
    return out


def likeness(a: str, b: str) -> float:
    """Share of leaves that two fingerprints have in common (0 to 1)."""
    if a[:32] == b[:32]:
        return 1.0
    left, right = _sections(a), _sections(b)
    same = _leaf_counts(left & right).total()
    x, y = _leaf_counts(left - right), _leaf_counts(right - left)
    n = 2 * same + x.total() + y.total()
    return 2.0 * (same + (x & y).total()) / n if n else 0.0


def _runs_apart(x: list[str], y: list[str]) -> list[tuple[int, int, int, int]]:
    """Runs (i, j, k, l) with x[i:j] and y[k:l] between equal runs of both: equal ends are
    cut off, what occurs once on both sides and in the same order are fixed points, and equal
    neighbours of fixed points join them. Time n log n."""
    points = [(-1, -1)]
    once = {h: k for k, h in enumerate(y)} if len(x) and len(y) else {}
    seen_x, seen_y = Counter(x), Counter(y)
    tails, chain = [], []       # longest increasing run of places in y
    for i, h in enumerate(x):
        if seen_x[h] == 1 == seen_y[h]:
            at = bisect_left(tails, once[h])
            tails[at:at + 1] = [once[h]]
            chain.append((i, once[h], at))
    picked, want = [], len(tails) - 1
    for i, k, at in reversed(chain):
        if at == want and (not picked or k < picked[-1][1]):
            picked.append((i, k))
            want -= 1
    points += picked[::-1] + [(len(x), len(y))]
    out = []
    for (i, k), (j, l) in zip(points, points[1:]):
        i, k = i + 1, k + 1
        while i < j and k < l and x[i] == y[k]:
            i, k = i + 1, k + 1
        while i < j and k < l and x[j - 1] == y[l - 1]:
            j, l = j - 1, l - 1
        if i < j or k < l:
            out.append((i, j, k, l))
    return out


def differences(a: str, b: str) -> list[tuple[str, int, int, int, int]]:
    """Where the texts of two fingerprints differ: (kind, from, to) in the first and (from, to) in the second,
    for sections (kind `section`) and, within each differing run of sections, paragraphs (kind `paragraph`,
    counted from the text's start). Ends are exclusive; an empty range is a place of insertion or removal.
    What lies outside the ranges is equal on both sides, in order; equal branches are never opened."""
    if a[:32] == b[:32]:
        return []
    left, right = a.split("|")[1:], b.split("|")[1:]
    before = [np.cumsum([0, *[s.count("/") for s in x]]).tolist() for x in (left, right)]
    out = []
    for i, j, k, l in _runs_apart(left, right):
        out.append(("section", i, j, k, l))
        x, y = ([p for s in side for p in s.split("/")[1:]] for side in (left[i:j], right[k:l]))
        out += [("paragraph", before[0][i] + e, before[0][i] + f, before[1][k] + g, before[1][k] + h)
                for e, f, g, h in _runs_apart(x, y)]
    return out


def places(a: str, b: str, kind: str) -> str:
    """The differing ranges of one kind as `from-to:from-to`, comma-joined."""
    return ",".join(f"{i}-{j}:{k}-{l}" for what, i, j, k, l in differences(a, b) if what == kind)


def in_order(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(r, extra, doc_id, text) by ranges of (doc_id, hash of the text): partitions hold one
    range each, sorted downwards, and a range ends with a copy of the row that follows
    it (`extra`). Only ids and hashes are shuffled to find the ranges (one row for each comes to
    the driver, MAX_RANGES at most); the texts move once, and rows that
    share a doc_id or have none are dealt over ranges by their texts."""
    d = docs.selectExpr("coalesce(cast(doc_id as bigint), -9223372036854775808) k", "cast(doc_id as bigint) doc_id",
                        "coalesce(cast(text as string), '') text").withColumn("h", F.xxhash64("text"))
    ids = d.select("k", "h")
    ranges = int(min(MAX_RANGES, ids.count() // rows_per_range + 1))
    tops = sorted({tuple(r.top) for r in ids.repartitionByRange(ranges, "k", "h").groupBy(
        F.spark_partition_id().alias("p")).agg(F.max(F.struct("k", "h")).alias("top")).collect()})
    top_k = np.array([k for k, _ in tops], np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, h = batch.column("k").to_numpy(), batch.column("h").to_numpy()
            r = np.searchsorted(top_k, k)
            shared = np.flatnonzero((r < len(tops)) & (top_k[np.minimum(r, len(tops) - 1)] == k)) if len(k) else r
            is_top = np.zeros(len(k), bool)
            for i in shared.tolist():       # a doc_id that ends a range: the text's hash decides
                at = (int(k[i]), int(h[i]))
                r[i] = bisect_left(tops, at)
                is_top[i] = r[i] < len(tops) and tops[r[i]] == at
            rows, top = np.arange(len(k)), np.flatnonzero(is_top)
            extra = np.r_[np.zeros(len(k), bool), np.ones(len(top), bool)]
            own = np.r_[r, (r[top] + 1) % max(1, len(tops))]
            out = batch.take(pa.array(np.r_[rows, top]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.astype(np.int32)), pa.array(extra), *[out.column(c) for c in ("k", "h", "doc_id", "text")]],
                ["r", "extra", "k", "h", "doc_id", "text"])

    return d.mapInArrow(deal, "r int, extra boolean, k bigint, h bigint, doc_id bigint, text string") \
        .repartitionById(max(1, len(tops)), F.col("r")).sortWithinPartitions("r", "extra", F.desc("k"), F.desc("h"), "text")


SCHEMA = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, edited_sections string, edited_paragraphs string")


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness."""

    def row(doc_id, text: str, mark: str, following: str, next_mark: str) -> tuple:
        m = len(text) // 3
        edited = text[:len(text) - m] + following[:m]
        other = mark if edited == text else fingerprint(edited)
        return (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), mark, other,
                likeness(mark, other), likeness(mark, next_mark), places(mark, other, "section"),
                places(mark, other, "paragraph"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(),
                 pa.string(), pa.string()]
        held, done = None, []
        for batch in batches:
            for r, extra, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("r", "extra", "doc_id", "text")]):
                if extra and (held is None or held[0] != r):
                    continue    # a second copy of the document that follows
                mark = fingerprint(text)
                if held is not None and held[0] == r:
                    done.append(row(*held[1:], text, mark))
                held = None if extra else (r, doc_id, text, mark)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
                done = []

    return in_order(docs).drop("k", "h").mapInArrow(run, SCHEMA)


def op8_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return compare_neighbours(spark.read.parquet(f"{sf_dir}/documents.parquet"))
