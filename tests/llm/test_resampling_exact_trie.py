"""Importance resampling, exact dedup and the conversation trie against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

from duka.llm import exact, importance, prefixtrie, registry
from duka.llm.scratch import Scratch
from tests.llm.test_llm import ROWS, _workers, empty, odd  # noqa: F401  fixtures

SF = "/root/testdata/sf0.001"
CONV = "conv_id bigint, turn bigint, role string, text string, depth int, key string, pid string"


@pytest.mark.parametrize("name", ["op11_importance", "op12_exact", "op13_prefixtrie"])
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, name, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '/root/testdata/{sf}/{t}.parquet'")
    want = con.sql(registry.oracle_sql()[name])
    columns = sorted(want.columns)
    got = registry.queries()[name](spark, f"/root/testdata/{sf}")
    assert sorted(got.columns) == columns
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == Counter(want.select(", ".join(columns)).fetchall())


# importance resampling

def _words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _brute_importance(docs, target, longest, buckets, min_words, percent):
    def features(text):
        w = _words(text)
        return Counter(zlib.crc32(" ".join(w[k:k + n]).encode()) % buckets
                       for n in range(1, longest + 1) for k in range(len(w) - n + 1))

    source, wanted = Counter(), Counter()
    for _, text in docs:
        source.update(features(text))
    for text in target:
        wanted.update(features(text))
    up, down = source.total() + buckets, wanted.total() + buckets
    rows = []
    for i, text in docs:
        f = features(text)
        weight = sum(n * math.floor(1000 * math.log((wanted[b] + 1) * up / ((source[b] + 1) * down))) for b, n in f.items())
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, f.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    able = sorted((r for r, (_, t) in zip(rows, docs) if len(_words(t)) >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [r for r in able[:len(able) * percent // 100]]
    return Counter((*r, k + 1) for k, r in enumerate(drawn)) + Counter((*r, None) for r in rows) - Counter((*r, None) for r in drawn)


def test_split_is_the_pattern():
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(chr(rng.choice([*range(0, 300), 0x85, 0xA0, 0x3000, 0x130, 0x1F600])) for _ in range(rng.randint(0, 30)))
        assert importance.split(text.encode()) == [w.encode() for w in _words(text)]


@pytest.mark.parametrize("longest,percent", [(1, 10), (2, 50), (3, 100)])
def test_importance(spark, odd, longest, percent):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    target = pd.read_parquet(f"{SF}/benchmark.parquet").text.tolist() + [None, ""]
    got = importance.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), Scratch(spark, "test"),
                              longest=longest, buckets=100, min_words=2, percent=percent)
    assert Counter(tuple(r) for r in got.collect()) == _brute_importance([tuple(r) for r in docs.collect()], target, longest, 100, 2, percent)


def test_importance_edges(spark, odd, empty):  # noqa: F811
    none = empty.select("text")
    assert importance.resample(empty, none, Scratch(spark, "test")).count() == 0
    got = importance.resample(odd, none, Scratch(spark, "test")).toPandas()
    assert len(got) == len(ROWS) and got["rank"].notna().sum() == 0     # a tenth of two documents
    drawn = importance.resampled(odd, none, Scratch(spark, "test"), min_words=2, percent=100)
    assert drawn.columns == odd.columns and {r.doc_id for r in drawn.collect()} == {4, 5, 6, 7, 8, None}


def test_gains_draw_what_is_like_the_target(spark):
    near, far = "alpha beta gamma delta " * 6, "one two three four " * 6
    docs = spark.createDataFrame([(k, near if k % 10 == 0 else far) for k in range(300)], "doc_id bigint, text string")
    got = importance.resample(docs, spark.createDataFrame([(near,)], "text string"), Scratch(spark, "test")).where("rank IS NOT NULL")
    assert {r.doc_id for r in got.collect()} == set(range(0, 300, 10))


# exact dedup

def _brute_exact(rows):
    by = defaultdict(list)
    for i, text in rows:
        by[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((i, text or ""))
    out = []
    for norm, group in by.items():
        stay = min(group, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        sha, seen = hashlib.sha256(norm.encode()).hexdigest(), False
        for i, text in group:
            kept = not seen and i == stay[0] and len(text) == len(stay[1])
            seen |= kept
            out.append((i, stay[0], len(group), kept, sha))
    return Counter(out)


def _few(rng, n):
    """Texts of a few letters and white space: many equal, some only after normalisation."""
    return [(None if rng.random() < 0.05 else rng.randint(0, n), rng.choice([
        None, "", "a" * 40, *("".join(rng.choice("ab \t\n é") for _ in range(rng.randint(0, 5))) for _ in range(6))])) for _ in range(n)]


@pytest.mark.parametrize("bits", [1, 3, 64])
def test_exact_chains(spark, bits):
    rows = _few(random.Random(bits), 400) + [(r[0], r[1]) for r in ROWS]
    docs = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id bigint, text string, norm string, kept boolean").repartition(5)
    got = exact.groups(docs, Scratch(spark, "test"), bits=bits, bucket_keys=2, bucket_bytes=100, owner_bytes=1000).drop("n_chars")
    assert Counter(tuple(r) for r in got.collect()) == _brute_exact(rows)


def test_exact_edges(spark, odd, empty):  # noqa: F811
    assert exact.groups(empty, Scratch(spark, "test")).count() == 0
    kept = exact.deduplicated(odd, Scratch(spark, "test"))
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 6, 7, 8]


def test_directory_splits_only_what_is_overfull(spark):
    keys = spark.createDataFrame([(k << 56, 1, 5000 if k < 4 else 10, 1) for k in range(64)], "h bigint, n bigint, bytes bigint, weight bigint")
    buckets, deepest = exact.directory(keys, 64, bucket_keys=32, bucket_bytes=6000)
    got = {(r.depth, r.prefix): (r["keys"], r.bytes) for r in buckets.collect()}
    assert sum(k for k, _ in got.values()) == 64
    assert all(k == 1 or (k <= 32 and b <= 6000) or d == deepest for (d, _), (k, b) in got.items())
    assert len({d for d, _ in got}) > 1        # long texts lie deeper
    slots = exact.owners(buckets, deepest, 4, 64).collect()
    assert len({r.slot for r in slots}) == len(slots) and {r.owner for r in slots} <= set(range(4))


def test_a_hot_key_is_dealt_over_owners(spark):
    rows = [(k, "hot text" if k % 2 else f"text {k}") for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    seen = []

    class Spy(Scratch):
        def cut(self, df):
            out = super().cut(df)
            if {"hot", "norm"} <= set(df.columns):
                seen.append(out.groupBy("hot").count().collect())
            return out

    got = exact.groups(docs, Spy(spark, "test"))
    assert Counter(tuple(r) for r in got.drop("n_chars").collect()) == _brute_exact(rows)
    assert {r.hot: r["count"] for r in seen[0]}[True] > 1       # several owners met it


# conversation trie

def _brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    for c in own:
        own[c].sort()
    members, ends, children = defaultdict(list), defaultdict(list), Counter()
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        turns = [t[2:] for t in own.get(c - c % 20, [])[:h]] + [t[2:] for t in own[c][h:]]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children.update(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        tokens = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += tokens
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def _conversations(rng, n):
    rows = []
    for c in rng.sample(range(n * 2), n):
        first = [("user", "common first words")] if rng.random() < 0.4 else []
        turns = first + [(rng.choice(["user", None, "a"]), rng.choice(["x", "x y", None, "", "z  w\tv"])) for _ in range(rng.choice([0, 1, 2, 3, 6]))]
        order = [None, *range(len(turns) - 1)]
        rows += [(c, order[k], *t) for k, t in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("turns", [1, 7, 1 << 16])
def test_trie(spark, turns):
    rows = _conversations(random.Random(turns), 200) + [(None, 0, "user", "no id")]
    conv = spark.createDataFrame([(*r, 1, "k", "p") for r in rows], CONV).repartition(6)
    got = prefixtrie.trie(conv, Scratch(spark, "test"), turns=turns)
    assert Counter(tuple(r) for r in got.collect()) == _brute_trie(rows)


def test_trie_edges(spark):
    nothing = spark.createDataFrame([], CONV)
    assert prefixtrie.trie(nothing, Scratch(spark, "test")).count() == 0
    # one conversation of its own base; one whose base is absent and whose turns all go; a long one
    for rows in ([(0, 1, "u", "a"), (0, None, "u", "b")], [(23, 0, "u", "x")], [(4, k, "u", f"{k % 3}") for k in range(200)]):
        conv = spark.createDataFrame([(*r, 1, "k", "p") for r in rows], CONV)
        got = prefixtrie.trie(conv, Scratch(spark, "test"), turns=50)
        assert Counter(tuple(r) for r in got.collect()) == _brute_trie(rows)


def test_a_very_long_conversation(spark):
    n = 20_000
    conv = spark.range(n).selectExpr("20L AS conv_id", "id AS turn", "'u' AS role", "concat('turn ', id % 7) AS text")
    got = prefixtrie.trie(conv, Scratch(spark, "test"), turns=1000).toPandas().sort_values("depth")
    assert got.depth.tolist() == list(range(n + 1)) and (got.n_convs == 1).all() and (got.n_leaves == 1).all()
    assert got.n_children.tolist() == [1] * n + [0] and (got.saved_tokens == 0).all()
    assert got.ends_sha256.tolist()[-1] == hashlib.sha256(b"20").hexdigest()


def test_repeated_turns_are_turns(spark):
    conv = spark.createDataFrame([(0, 1, "u", "same text", 1, "k", "p")] * 5, CONV)
    got = prefixtrie.trie(conv, Scratch(spark, "test")).orderBy("depth").collect()
    assert [r.depth for r in got] == [0, 1, 2, 3, 4, 5] and got[0].n_leaves == 1


def test_extents_and_minima_are_the_scan():
    rng = np.random.default_rng(3)
    for m in (1, 2, 3, 17, 64, 200):
        lcp, conv = rng.integers(0, 5, m - 1), rng.integers(0, 1000, m)
        rows, depths = rng.integers(0, m, 300), rng.integers(0, 6, 300)
        left, right = prefixtrie.extents(lcp, rows, depths)
        for i, d, a, b in zip(rows, depths, left, right):
            x = y = i
            while x > 0 and lcp[x - 1] >= d:
                x -= 1
            while y < m - 1 and lcp[y] >= d:
                y += 1
            assert (a, b) == (x, y)
        assert prefixtrie.minima(conv, left, right).tolist() == [conv[a:b + 1].min() for a, b in zip(left, right)]
