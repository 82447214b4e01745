"""Operators of duka.llm against brute force, round trips and held-out rows."""

from __future__ import annotations

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from duka.llm import htmltext, langid, lm, merkle, mixing, neardup, pieces, pii, registry, suffixdup, topk
from duka.llm.lyndon import suffix_array
from duka.llm.scratch import Scratch
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, bucket string"
LONG = "the of and in to that 4539578763621486 mail ann@example.com " * 2000
ROWS = [(1, None, "en", "a", 0, 1, "x"), (2, "", "en", None, 0, 1, "x"), (3, " \t\n", None, "a", 3, 1, "x"),
        (4, "one two", "en", "b", 7, 1, "x"), (4, "one two", "en", "b", 7, 1, "x"), (5, "one two", "en", "b", 7, 1, "x"),
        (6, LONG, "en", "c", len(LONG), 1, "x"), (7, LONG + "end", "en", "c", len(LONG) + 3, 1, "x"),
        (None, "one two", "en", "b", 7, 1, "x"), (8, "12 ++ ▁  ▁ é\u0000", "de", "", 9, 1, "x")]


@pytest.fixture(autouse=True)
def _workers(spark):
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents() -> pd.DataFrame:
    return pd.read_parquet(f"{SF}/documents.parquet")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def oracle(name: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con.sql(registry.oracle_sql()[name]).df()


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    got, want = registry.queries()[name](spark, SF).toPandas(), oracle(name)
    keys = sorted(got.columns)
    pd.testing.assert_frame_equal(*[x[keys].sort_values(keys).reset_index(drop=True) for x in (got, want)], check_dtype=False)


def test_mix_edges(spark, odd, empty):
    got = mixing.mix(odd).toPandas()
    assert len(got) == len(ROWS) and (got.taken <= 2 * got["size"]).all() and (got.target <= 2 * got.source_size).all()
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    mixed = mixing.mixed(odd)
    assert mixed.columns == odd.columns and mixed.count() == got.copies.sum()


def test_mix_is_near_its_targets(spark):
    got = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), carry=("source",)).toPandas()
    got["s"] = [r.source if hasattr(r, "source") else r["source"] for r in got._row]
    for _, g in got.groupby("s"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max()


def test_pieces(spark, odd, empty):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(odd.select("doc_id", "text"))
    texts = sorted([*documents().text, *(r[1] or "" for r in ROWS)])
    got = pieces.encode(docs, keep_text=True).toPandas()
    want = Counter((len(i := sp.encode(t)), ",".join(map(str, i)), hashlib.sha256(sp.decode(i).encode()).hexdigest()) for t in texts)
    assert Counter(zip(got.n_tokens, got.ids, got.decoded_sha256)) == want
    assert pieces.encode(empty).count() == 0


def brute_pii(text: str) -> list:
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern, lo, hi in ((2, r"[0-9]([\x20-]?[0-9])+", 14, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 10, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if lo <= len(digits) <= hi and (kind == 3 or pii.luhn(digits)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_pii(spark, odd, empty):
    rng = np.random.default_rng(0)
    for _ in range(3000):
        text = "".join(rng.choice(list("0123456789..  -+@ab()é\n"), rng.integers(0, 50)))
        assert pii.base_spans(text) == brute_pii(text)
    field = pii.Field(pii.train())
    for line, tags in pii._labelled():
        assert list(field.decode([line])[0]) == tags
    got = {r.doc_id: r for r in pii.find(odd.where("doc_id is not null")).collect()}
    assert got[1].spans == got[2].spans == "" and got[6].n_email == 2000 and got[6].n_card == 2000
    assert pii.find(empty).count() == 0 and pii.redact(odd).columns == odd.columns
    clean = {r.doc_id: r.text for r in pii.redact(odd).collect()}
    assert clean[1] is None and clean[4] == "one two" and "@" not in clean[6] and "[CARD]" in clean[6]
    (_, spans), = pii.find_slice(pa.array(["call (212) 555-0187 or 9311664600839015 x"]), field)
    assert [(pii.KINDS[k], a, b) for a, k, b in spans] == [("phone", 5, 19)]


def test_viterbi_is_the_best_path():
    field = pii.Field(pii.train())
    line = "call +1 (415) 555-0134 or 10.0.0.1 now 4111 1111 1111 1111".split()
    e = np.array([[sum(field.w.get(f, np.zeros(5))[y] for f in fs) for y in range(5)] for fs in pii._observed(line)])
    best = {(): 0.0}
    for k in range(len(line)):
        best = {(*p, y): s + e[k, y] + (field.t[p[-1], y] if p else 0) for p, s in best.items() for y in range(5)}
        best = dict(sorted(best.items(), key=lambda x: -x[1])[:2000])
    assert tuple(field.decode([line])[0]) == max(best, key=best.get)


def test_top_k_edges(spark):
    rows = [(0, [1.0, float("nan")]), (50, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [0.5, -0.25]), (2, [0.5, -0.25]),
            (3, None), (4, [None, 1.0]), (5, [0.1]), (None, [9.0, 9.0]), (6, [float("inf"), 0.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id bigint, embedding array<float>, score int")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [
        (50, 1, 1, 128 * 128 + 64 * 64), (50, 2, 2, 128 * 128 + 64 * 64), (50, 3, 5, 128 * 25)]
    assert topk.top_k(df.where("vec_id > 99"), F.col("vec_id") % 50 == 0).count() == 0


def test_block_pruning_is_exact_and_prunes():
    rng = np.random.default_rng(1)
    d = np.sort(rng.integers(-300, 300, (3000, 8)), axis=0)
    ids, best, scored = topk.search(np.arange(20), d[:20], np.arange(3000), d, block=64)
    s = d[:20] @ d.T
    s[np.arange(20), np.arange(20)] = np.iinfo(np.int64).min
    want = np.array([np.lexsort((np.arange(3000), -r.astype(float)))[:5] for r in s])
    assert (ids == want).all() and scored < 0.5
    # unsorted rows around centres: blocks are ranges of like rows, so most are never scored
    centres = rng.integers(-2000, 2000, (40, 16))
    d = centres[rng.integers(0, 40, 4000)] + rng.integers(-40, 40, (4000, 16))
    name = np.arange(4000) * 3 + 1
    ids, best, scored = topk.search(name[:50], d[:50], name, d)
    s = d[:50] @ d.T
    s[np.arange(50), np.arange(50)] = np.iinfo(np.int64).min
    want = np.array([name[np.lexsort((name, -r.astype(float)))[:5]] for r in s])
    assert (ids == want).all() and scored < 0.2
    order, starts = topk.ranges(name, d)
    assert sorted(order) == list(range(4000)) and np.diff(np.r_[starts, 4000]).max() <= topk.BLOCK


def components(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if (w := words(t)) else set() for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates(spark, odd, empty):
    d = documents()
    base = words(d.text.iloc[7])[:120]
    rng = np.random.default_rng(3)
    chain = [(10_000 + k, " ".join(w if rng.random() > 0.012 * (k % 9) else f"w{k}{j}" for j, w in enumerate(base))) for k in range(60)]
    rows = [*zip(d.doc_id.tolist(), d.text.tolist()), *chain]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), Scratch(spark, "t")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components(rows)
    got = neardup.near_duplicates(odd, Scratch(spark, "t")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got if r.doc_id != 6 and r.doc_id != 7) == [
        (0, 4, False), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (4, 4, True), (5, 4, False), (8, 8, True)]
    assert neardup.near_duplicates(empty, Scratch(spark, "t")).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**63, 400).astype(np.uint64)
    for n, want in ((300, 300 / 500), (1, 1.0)):
        a, b = (np.unique(x[:400]), np.unique(np.r_[x[:300], rng.integers(0, 2**63, 100).astype(np.uint64)])) if n > 1 else (x[:1], x[:1])
        s = neardup.sketches(np.cumsum([0, len(a), len(b)]), np.r_[a, b], 512)
        assert (s > 0).all() and abs((s[0] == s[1]).mean() - want) < 0.1


def test_html(spark):
    page = ('<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="x">Menu</a></li></ul>'
            '</nav><div class="ad">Buy</div><article><h1>Head &amp; line</h1><p>One\n  two<b>!</b><br>three<p>Short.</p>'
            '<div class="comments"><p>Me too</p></div><form>Name</form></article><footer>&copy; end</footer>')
    assert htmltext.main_text(page) == "Head & line\nOne two! three\nShort."
    plain = "<body><div><a href=1>a</a></div>" + "<p>" + "word " * 40 + "</p><p>" + "more " * 30 + "</p><div><a href=2>b</a></div>"
    assert htmltext.main_text(plain) == ("word " * 40).strip() + "\n" + ("more " * 30).strip()
    assert [htmltext.main_text(x) for x in (None, "", "<br>", "<nav>x")] == [""] * 4
    df = spark.createDataFrame([(1, "u", page, 5), (None, None, None, 5)], "page_id bigint, url string, html string, text int")
    assert sorted(r.n_chars for r in htmltext.extract(df).collect()) == [0, 33]
    assert htmltext.extract(df.limit(0)).count() == 0


def test_html_text_outside_the_named_elements():
    body = "".join(f"<p>{w * 50}</p>" for w in ("word ", "more ", "text ", "last "))
    want = "\n".join((w * 50).strip() for w in ("word ", "more ", "text ", "last "))
    for notes in ('<article class="comment"><p>Me too</p></article>' * 3,
                  '<div id="comments"><article><p>Me too</p></article><article><p>No</p></article></div>',
                  '<article class="teaser"><h3>Next</h3><p>Read on</p></article>'):
        assert htmltext.main_text(f"<body><div>{body}</div>{notes}</body>") == want
    assert want in htmltext.main_text(f"<body><div>{body}</div><article><p>Me too</p></article></body>")
    page = f"<body><div><p>Home</p></div><article><h1>Head</h1><p>By A</p><p>1 May</p>{body}<p>.</p></article><div>All rights</div>"
    assert htmltext.main_text(page) == f"Head\nBy A\n1 May\n{want}\n."


def test_html_keeps_blocks_that_only_look_like_furniture():
    def text(inner: str) -> str:
        return htmltext.main_text(f"<body><nav>Menu</nav><article><p>First line of it</p>{inner}<p>Last line of it</p></article></body>")
    for block in ('<div style="overflow:hidden">X y z</div>', '<div class="overflow-hidden">X y z</div>',
                  '<p title="the hidden side">X y z</p>', '<p><a href="/hidden/">X</a> y z</p>', '<h2 id="related-work">X y z</h2>',
                  '<h2 class="header">X y z</h2>', '<div class="post-header"><h1>X y z</h1></div>',
                  '<header><h1>X y z</h1></header>', '<section id="social-notices"><p>X y z</section>',
                  '<p>X <span class="share">y</span> z</p>', '<p hidden="until-found">X y z</p>'):
        assert text(block) == "First line of it\nX y z\nLast line of it", block
    for block in ("<div hidden>X</div>", '<p style="color:red; display: none">X</p>', '<p style="visibility:hidden">X</p>',
                  '<div aria-hidden="true">X</div>', '<div class="ad">X</div>', '<div id="comments">X</div>', '<p class="ad">X',
                  '<ul><li class="ad">X</ul>', '<div><p class="ad">X</div>', "<p hidden>X",
                  '<ul><li class="ad"><div>X</div> X<ul><li>X<li>X</ul>X</ul>', '<ul><li class="ad"><p>X</p>X</p>X</li></ul>'):
        assert text(block) == "First line of it\nLast line of it", block
    assert text('<ul><li class="ad">X<li>Y</ul>') == "First line of it\nY\nLast line of it"


def test_merkle(spark, odd, empty):
    d = documents().sort_values("doc_id", ascending=False).reset_index(drop=True)
    following = [*d.text[1:], d.text[0]]
    got = merkle.compare_neighbours(spark.read.parquet(f"{SF}/documents.parquet").repartition(5)).toPandas().set_index("doc_id")
    for i, t, n in zip(d.doc_id, d.text, following):
        m = len(t) // 3
        edited = t[:len(t) - m] + n[:m]
        row = got.loc[i]
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and row.n_chars == len(t)
        assert row.fingerprint == merkle.fingerprint(t) and row.edited_fingerprint == merkle.fingerprint(edited)
        assert 0 <= row.near_next <= 1 and row.near_edited == merkle.likeness(row.fingerprint, row.edited_fingerprint)
    assert (got.near_edited > got.near_next).mean() > 0.9
    assert merkle.compare_neighbours(odd).count() == len(ROWS) and merkle.compare_neighbours(empty).count() == 0
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint(None)) == 1.0
    assert merkle.likeness(merkle.fingerprint("a b"), merkle.fingerprint("")) == 0.0
    assert all("".join(merkle.leaves(line)) == line for t in d.text for line in t.split("\n"))


def test_merkle_locates_edits():
    lines = [f"paragraph {k} of the text, with words {k * k}." for k in range(60)]
    mark = merkle.fingerprint("\n".join(lines))
    assert merkle.differences(mark, mark) == []

    def found(new: list[str]) -> list[tuple]:
        got = merkle.differences(mark, merkle.fingerprint("\n".join(new)))
        assert any(g[0] == "section" for g in got)
        return [g[1:] for g in got if g[0] == "paragraph"]

    assert found([*lines[:20], "another one", *lines[21:]]) == [(20, 21, 20, 21)]
    assert found([*lines[:20], "a new one", *lines[20:]]) == [(20, 20, 20, 21)]
    assert found(lines[:20] + lines[21:]) == [(20, 21, 20, 20)]
    many = merkle.fingerprint("\n".join(f"leaf {k}" for k in range(20_000)))
    assert len(set(re.split("[|/]", many)[1:])) > 20_000     # no two leaves share a hash by chance


def test_language(spark, odd, empty):
    got = langid_rows = registry.queries()["op9_language"](spark, "/root/testdata/sf0.01").toPandas()
    d = pd.read_parquet("/root/testdata/sf0.01/documents.parquet").merge(got, on="doc_id")
    assert (d.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in d.doc_id]).all()
    assert (d.lang == d.lang_pred)[d.held_out].mean() > 0.97 and langid_rows.score.between(0, 1).all()
    model = langid.train(odd)
    rows = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert [rows[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and all(rows[k].rejected for k in (1, 2, 3))
    assert langid.train(empty) == {} and langid.identify(odd, {}).where("lang_pred != 'und'").count() == 0
    assert langid.identified(odd, model).columns == odd.columns


def repeated(rows: list[tuple[int, str | None]]) -> dict[int, tuple]:
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, np.int64)
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p] += 1
                gone[p + 100] -= 1
            seen.add(b[p:p + 100])
        gone = np.cumsum(gone)[:len(b)] > 0
        out[i] = (len(b), int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]][:len(b)]).sum()),
                  hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


def test_suffix_array():
    rng = np.random.default_rng(2)
    for _ in range(1500):
        s = rng.integers(0, rng.integers(1, 5), rng.integers(0, 40)).tolist()
        if rng.random() < 0.3:
            s = (s[:4] * 12)[:len(s)]
        assert suffix_array(np.array(s, int)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_repeats(spark, odd, empty):
    rng = np.random.default_rng(4)
    stock = ["ab" * 80, "x" * 150, "The quick brown fox jumps over the lazy dog, and then some more words follow. " * 3,
             "".join(rng.choice(list("abcd é"), 400))]
    made = [(1000 + k, "".join(stock[rng.integers(4)][rng.integers(20):rng.integers(30, 400)] if rng.random() < 0.6 else
                               "".join(rng.choice(list("abcdefgh é"), rng.integers(60))) for _ in range(rng.integers(6))))
            for k in range(150)]
    rows = [*zip(documents().doc_id.tolist(), documents().text.tolist()), *made, (9999, None), (9998, "a" * 5000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = suffixdup.without_repeats(df, Scratch(spark, "t")).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == repeated(rows)
    assert len(suffixdup.without_repeats(odd, Scratch(spark, "t")).collect()) == len(ROWS)
    assert suffixdup.without_repeats(empty, Scratch(spark, "t")).count() == 0


def test_repeats_split_hot_groups(spark, monkeypatch):
    rng = np.random.default_rng(6)
    line = "This very line of seventy bytes stands in every text, with others around."
    ends = ["".join(rng.choice(list("abcdefgh é"), 60)) for _ in range(30)]
    rows = [(k, "".join(rng.choice(list("abcdefgh é"), 80)) + ends[rng.integers(30)] + line + ends[rng.integers(30)])
            for k in range(200)]
    df = spark.createDataFrame([*rows, (None, rows[0][1]), (300, None)], "doc_id bigint, text string").repartition(4)
    sizes = []
    for hot in (3, suffixdup.HOT):
        monkeypatch.setattr(suffixdup, "HOT", hot)
        got = suffixdup.without_repeats(df, Scratch(spark, "t")).where("doc_id is not null").collect()
        assert {r.doc_id: tuple(r)[1:] for r in got} == repeated([*rows, (300, None)])
        d = df.selectExpr("doc_id", "text")
        parts = suffixdup.contexts(suffixdup.repeats(suffixdup.anchor_rows(d)).where("kind = 1").drop("kind", "extra"), d)
        sizes.append(max(r["count"] for r in parts.where("bytes is not null").groupBy("hash", "side", "key").count().collect()))
    assert sizes[0] <= 3 < sizes[1]


def test_lm(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(lm.attention.train, "__defaults__", (250, *lm.attention.train.__defaults__[1:]))
    got = registry.queries()["op2_lm"](spark, SF).toPandas().set_index("doc_id")
    tokens = {i: [*words(t), None] for i, t in zip(documents().doc_id, documents().text)}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    c = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = c.total(), len(c)
    for i, t in tokens.items():
        r = got.loc[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(w in c for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), rel_tol=1e-9)
    assert (got.score < 0).all()
    # on held-out texts the trained weights beat the subword frequencies that they start from
    fold = documents().assign(h=[held[i] for i in documents().doc_id])
    model = lm.default_model()
    flat, ends = {}, {}
    for h in (False, True):
        o, codes, table = lm.word_codes(pa.array(fold.text[fold.h == h]))
        flat[h], ends[h] = lm.streams(o, codes, *lm.subwords(table.to_pylist(), model), end_id=2)
    vocabulary = lm.attention.Vocabulary(np.bincount(flat[False], minlength=32000))
    trained = lm.attention.train(vocabulary.prior, lm.inputs(flat[False], ends[False], vocabulary),
                                 vocabulary.output[flat[False]], ends[False])
    start = lm.attention.initial(vocabulary.prior) | {k: 0 * trained[k] for k in ("U", "M")}
    new, old = (lm.score_texts(p, vocabulary, flat[True], ends[True]).sum() for p in (trained, start))
    assert new > 0.85 * old
    out = lm.score(odd, F.lit(False), Scratch(spark, "t")).toPandas()
    assert len(out) == len(ROWS) and sorted(out.n_tokens)[:3] == [1, 1, 1]
    assert lm.score(empty, F.lit(False), Scratch(spark, "t")).count() == 0


def test_lm_learns_whole_training_texts(spark, monkeypatch):
    monkeypatch.setattr(lm, "STEPS", 200)
    middle = "some other words stand here in between " * 60
    scores = []
    for edge in ("red fox " * 400, "red red fox fox " * 200):       # same words and counts, another order
        rows = [(k, edge + middle + edge) for k in range(8)] + [(99, "red fox " * 50)]
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        out = lm.score(df, F.col("doc_id") == 99, Scratch(spark, "t"))
        scores.append(out.where("doc_id = 99").first().score)
    assert scores[0] > 0.8 * scores[1]      # both negative


def test_lm_learns_each_training_window_once(spark, monkeypatch):
    rows = [(k if k % 3 else None, f"w{k} " * (k % 70)) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "doc_id", "text", "coalesce(doc_id % 5 = 1, false) held").repartition(4)
    coded, model = Scratch(spark, "t").cut(lm.chunks(df)), lm.default_model()
    taught = [t for i, t in rows if i is None or i % 5 != 1]
    o, codes, table = lm.word_codes(pa.array(taught))
    flat, ends = lm.streams(o, codes, *lm.subwords(table.to_pylist(), model), end_id=2)
    vocabulary = lm.attention.Vocabulary(np.bincount(flat, minlength=32000))
    weights = lm.attention.initial(vocabulary.prior)
    monkeypatch.setattr(lm, "LEARNER", 1000)
    n = [r.n for k in range(lm.ROUNDS) for r in lm.lesson(coded, weights, vocabulary, k, len(codes), model).collect()]
    assert len(n) > lm.ROUNDS and sum(n) == len(lm.attention.windows(ends)[0])


def test_windows_score_each_token_once():
    at, inside, live = lm.attention.windows(np.array([5, 5 + 16, 5 + 16 + 40]))
    scored = at[:, lm.attention.CONTEXT:][live]
    assert sorted(scored.tolist()) == list(range(61))


def test_pipeline(spark, odd, empty):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and {r.doc_id for r in out} <= set(documents().doc_id)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "pii", "mixing", "pieces"]
    for rows in (odd, empty):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = Scratch(spark, "t").cut(stage(spark, docs, SF))
            assert docs.columns == rows.columns
