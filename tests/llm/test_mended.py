"""Cases that earlier versions of the text operators got wrong."""

from __future__ import annotations

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from duka.llm import attention, htmltext, lm, merkle, neardup, pieces, pii
from duka.llm.scratch import Scratch
from tests.llm.test_llm import _workers  # noqa: F401  fixture


def test_pii_long_digit_runs():
    assert pii.base_spans("0" * 5000 + "1.2.3.4 x") == [(0, 1, 5007)]
    assert pii.base_spans("9" * 5000 + ".2.3.4") == [] and pii.base_spans("1.2.3.256") == []
    assert pii.base_spans("1.2.3.0000255") == [(0, 1, 13)]
    field = pii.Field(pii.train())
    assert pii.find_slice(pa.array(["7" * 6000 + ".1.1.1"]), field)[0][0] == []


LONG = "".join(f"<p>Paragraph {k} of the long article goes on for quite a while, word by word.</p>" for k in range(10))


def test_html_short_article_beside_a_long_one():
    for page in (f"<article><p>Short.</p></article><div>sep</div><article>{LONG}</article>",
                 f"<article>{LONG}</article><div>sep</div><article><p>Short.</p></article>"):
        lines = htmltext.main_text(f"<body>{page}</body>").split("\n")
        assert "Short." in lines and len(lines) == 11 and "sep" not in lines


def test_html_linked_heading_inside_the_text():
    page = f"<body><nav><a href=/>Home</a></nav><div>{LONG}<h2><a href=#x>A linked heading</a></h2>{LONG}</div>" \
           "<div><a href=1>one</a></div><div><a href=2>two</a></div></body>"
    lines = htmltext.main_text(page).split("\n")
    assert lines[10] == "A linked heading" and len(lines) == 21


@pytest.mark.parametrize("unit", ["<!x ", "<div class=ad>", "<aside><li>", "<nav><ul><li><p>", "<a href='", '<p title="', "<b", "&#", "</p"])
def test_html_time_is_linear(unit):
    def seconds(n):
        page = unit * n
        best = 9.0
        for _ in range(3):
            start = time.perf_counter()
            htmltext.main_text(page)
            best = min(best, time.perf_counter() - start)
        return best

    small = seconds(4000)
    assert seconds(16000) < 9 * small + 0.05     # four times the page; a square would be 16 times


def _apply(x, y, ranges):
    """What lies outside the ranges is equal on both sides, in order."""
    at = [0, 0]
    for i, j, k, l in ranges:
        assert at[0] <= i <= j and at[1] <= k <= l and x[at[0]:i] == y[at[1]:k]
        at = [j, l]
    assert x[at[0]:] == y[at[1]:]


def test_runs_apart_hold_every_difference():
    rng = random.Random(7)
    for _ in range(3000):
        x = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))]
        y = x[:] if rng.random() < 0.3 else [rng.choice("abcdefghij") for _ in range(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 2)):
            y.insert(rng.randint(0, len(y)), "new")
        got = merkle._runs_apart(x, y)
        _apply(x, y, got)
        assert (got == []) == (x == y)
    lines = [str(k) for k in range(1000)]
    assert merkle._runs_apart(lines, lines[:500] + ["x"] + lines[501:]) == [(500, 501, 500, 501)]
    assert merkle._runs_apart(lines, lines[:100] + lines[110:]) == [(100, 110, 100, 100)]
    assert merkle._runs_apart(["a"] * 100_000, ["a"] * 99_999 + ["b"]) == [(99_999, 100_000, 99_999, 100_000)]


def test_merkle_query_locates_the_edit(spark):
    rng = random.Random(9)
    rows = [(k, "\n".join(" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randint(0, 99)) for _ in range(9))
                          for _ in range(rng.choice([0, 1, 30])))) for k in range(80)]
    got = {r.doc_id: r for r in merkle.compare_neighbours(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, (k, text) in enumerate(rows):
        other = rows[i - 1][1]      # descending doc_id, the first after the last
        m = len(text) // 3
        edited = text[:len(text) - m] + other[:m]
        x, y = (t.split("\n") if t else [] for t in (text, edited))
        ranges = [tuple(map(int, re.split("[-:]", p))) for p in got[k].edited_paragraphs.split(",") if p]
        _apply(x, y, ranges)
        assert bool(ranges) == (text != edited)
        if m and text != edited:
            same = len(text[:len(text) - m].split("\n")) - 1
            assert ranges[0][0] >= same      # nothing before the edit is named


def test_merkle_one_doc_id_for_a_third_of_all_rows(spark):
    rows = [(5 if k % 3 == 0 else k, f"text {k}") for k in range(900)] + [(None, f"none {k}") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    dealt = merkle.in_order(df, rows_per_range=100)
    sizes = {r.r: r["count"] for r in dealt.groupBy("r").count().collect()}
    assert len(sizes) >= 10 and max(sizes.values()) < 300
    got = merkle.compare_neighbours(df).collect()
    assert len(got) == len(rows)


def test_common_counts_in_bounded_slices(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.uint64)) for _ in range(30)]
    askers = [np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.uint64)) for _ in range(20)]
    value, owner = np.concatenate(sets), np.repeat(np.arange(30), [len(s) for s in sets]).astype(np.int32)
    order = np.argsort(value, kind="stable")
    v, asker = np.concatenate(askers), np.repeat(np.arange(20), [len(a) for a in askers])
    want = [[len(np.intersect1d(a, s)) for s in sets] for a in askers]
    for hits in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(neardup, "HITS", hits)
        assert neardup.common_counts(v, asker, 20, value[order], owner[order], 30).tolist() == want


def test_a_large_group_of_near_copies(spark):
    words = [f"w{k}" for k in range(200)]
    rng = random.Random(3)
    rows = []
    for k in range(400):        # each differs from the base text in one to three words
        own = words[:]
        for _ in range(rng.randint(1, 3)):
            own[rng.randrange(200)] = f"x{k}"
        rows.append((k, " ".join(own)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), Scratch(spark, "test")).collect()
    sets = {k: {tuple(t.split()[i:i + 5]) for i in range(196)} for k, t in rows}
    root = list(range(400))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(400):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {r.doc_id: r.component_id for r in got} == {k: find(k) for k in range(400)}


def test_pieces_in_small_portions(monkeypatch):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    monkeypatch.setattr(pieces, "PORTION", 3)
    texts = ["one two  three ▁ four ", "", " lead", "a b c d e f g", "é\u0000 12 ++"]
    table = pieces.ChunkTable(pieces.default_model(), 4)
    for _ in range(2):
        ids, back, n = pieces.encode_slice(pa.array(texts), table)
        want = [sp.encode(t) for t in texts]
        assert ids.to_pylist() == [",".join(map(str, i)) for i in want] and back.to_pylist() == [sp.decode(i) for i in want]
        assert n.tolist() == [len(i) for i in want]


HELD = {    # spellings that the labelled table does not hold
    "phone": ["+0 000 000 0000", "000 000 0000", "+00-00-0000-0000", "00 00 00 00 00", "+0.000.000.0000", "(0000) 000000",
              "000-0000", "+000 00 000 0000", "1-(000)-000-0000", "00000 000000"],
    "email": ["a.b.c@sub.dom.example.org", "USER_0@example.net", "'kim@example.com'", "x@y.example", "first-last+tag@example.museum"],
    "ip": ["8.8.4.4", "[198.51.100.77]:443", "192.0.2.1/32", "ip:203.0.113.9", "10.255.255.1,"],
    "card": ["6011 1111 1111 1117", "371449635398431", "4000.0000.0000.0002"],
}
LINES = ["reach me on {} tomorrow", "the number {} was given", "{}", "Ile de {} et la", "name | {} | 12", "(see {})"]
NONE = ["sizes 10-20 and 30-40 of 55", "born 12.04.1987 in Rome", "price 12 500.00 EUR", "ref 2023/11/000045", "time 10:22:33.456",
        "ratio 3:2 or 16-9", "2 + 2 = 4", "build 10.15.7 (19H2)", "seq 1234 5678", "year 2020-2021", "room 12-3456", "42% of 1,000"]


def test_pii_held_out_spellings():
    field, rng = pii.Field(pii.train()), random.Random(5)
    hits = misses = wrong = 0
    for kind, values in HELD.items():
        for value in values:
            for line in LINES:
                own = "".join(str(rng.randint(1, 9)) if c == "0" and kind == "phone" else c for c in value)
                text = line.replace("{}", own)
                a = text.index(own)
                got = pii.find_slice(pa.array([text]), field)[0][1]
                found = [s for s in got if pii.KINDS[s[1]] == kind and s[0] < a + len(own) and s[2] > a]
                hits, misses, wrong = hits + bool(found), misses + (not found), wrong + len(got) - len(found)
    wrong += sum(len(pii.find_slice(pa.array([t]), field)[0][1]) for t in NONE)
    assert hits / (hits + wrong) > 0.95 and hits / (hits + misses) > 0.8


def test_pii_added_cards_have_the_digits_of_cards():
    field = pii.Field(pii.train())
    two = "pay 4539578763621486 4111111111111111 now"       # the base pattern sees one number of 32 digits
    (base, every), = pii.find_slice(pa.array([two]), field)
    assert base == [] and [(pii.KINDS[k], two[a:b]) for a, k, b in every] == [("card", "4539578763621486"), ("card", "4111111111111111")]
    for text in ("card 14155550134 x", "visa 4539578763621487 of", "1-415-555-0134"):
        assert not [s for s in pii.find_slice(pa.array([text]), field)[0][1] if s[1] == 2]


def test_lm_segments_each_chunk_word_once(spark, monkeypatch):
    texts = ["one two two three", "", None, "Zwei Wörter und\tmehr two"]
    df = spark.createDataFrame([(k, t, k == 0) for k, t in enumerate(texts)], "doc_id int, text string, held boolean")
    coded, model = lm.chunks(df.coalesce(1)).toArrow(), lm.default_model()
    codes = lm.word_codes(pa.array(texts[1:]))
    flat, ends = lm.streams(*codes[:2], *lm.subwords(codes[2], model), end_id=2)
    monkeypatch.setattr(lm, "subwords", None)       # the rounds of the training read the ids
    (got, got_ends), = lm.training_streams(iter(coded.to_batches()), model)
    assert got.tolist() == flat.tolist() and got_ends.tolist() == ends.tolist()
    counts = {r.id: r.n for r in lm.subword_counts(spark.createDataFrame(coded), 32000).collect()}
    assert counts == {i: n for i, n in enumerate(np.bincount(flat[flat != 2])) if n}


def test_attention_step_follows_the_slope():
    r = np.random.default_rng(3)
    weights = {n: (w + 0.2 * r.standard_normal(w.shape)).astype(np.float32)
               for n, w in attention.initial(attention.Vocabulary(r.integers(0, 50, 3000)).prior).items()}
    x, ok = r.integers(0, attention.BEGIN, (3, attention.SPAN)), np.ones((3, attention.SPAN), bool)
    ok[1, :5] = ok[2, -4:] = False
    t = r.integers(0, attention.CLASSES * attention.MEMBERS, (3, attention.STRIDE))
    on = ok[:, attention.CONTEXT:]
    learner = attention.Learner(weights)
    learner.step(x, ok, on, t, 0.0)

    def loss(p):
        return -attention.log_scores(p, x, ok, t)[on].mean(dtype=np.float64)

    for name, m in learner.m.items():       # the slope's tenth after one step
        way = np.sign(m)
        up, down = (loss(weights | {name: weights[name] + s * np.float32(1e-3) * way}) for s in (1, -1))
        assert np.isclose((up - down) / 2e-3, 10 * np.abs(m).sum(dtype=np.float64), rtol=0.05, atol=2e-3), name


def test_attention_scores_by_hand():
    r = np.random.default_rng(5)
    p = {n: (w + 0.2 * r.standard_normal(w.shape)).astype(np.float32)
         for n, w in attention.initial(attention.Vocabulary(r.integers(0, 50, 3000)).prior).items()}
    n, span = 150, attention.SPAN               # more windows than are computed at once
    x, inside = r.integers(0, attention.BEGIN + 1, (n, span)), r.random((n, 1)) * 20 <= np.arange(span)
    inside[::3, 25:] = False
    t = r.integers(0, attention.CLASSES * attention.MEMBERS, (n, attention.STRIDE))
    got = attention.log_scores(p, x, inside, t)
    w = {name: a.astype(np.float64) for name, a in p.items()}
    for i in (0, 1, 63, 64, 128, 149):
        for j in np.flatnonzero(inside[i, attention.CONTEXT:]):
            at = attention.CONTEXT + j
            seen = [k for k in range(at + 1) if inside[i, k]]
            e = w["E"][x[i, seen]]
            logits = e @ w["K"] @ (w["E"][x[i, at]] @ w["Q"]) / attention.WIDTH ** 0.5 + w["R"][[at - k for k in seen]]
            a = np.exp(logits - logits.max())
            h = w["E"][x[i, at]] + a / a.sum() @ e @ w["V"] @ w["O"]
            g = h + np.maximum(h @ w["W1"] + w["b1"], 0) @ w["W2"]
            c, m = t[i, j] % attention.CLASSES, t[i, j] // attention.CLASSES
            of, member = g @ w["U"] + w["c"], g @ w["M"][c] + w["m"][c]
            want = of[c] - np.log(np.exp(of).sum()) + member[m] - np.log(np.exp(member).sum())
            assert np.isclose(got[i, j], want, rtol=1e-4, atol=1e-4)


def test_a_round_lays_out_its_own_windows_only(monkeypatch):
    r, laid, whole = np.random.default_rng(6), [], attention.windows
    ends = np.cumsum(r.integers(1, 90, 50))
    vocabulary = attention.Vocabulary(r.integers(0, 50, 3000))
    flat = r.integers(0, 3000, ends[-1])
    monkeypatch.setattr(attention, "windows", lambda *a: laid.append(out := whole(*a)) or out)
    learner = attention.Learner(attention.initial(vocabulary.prior))
    n = sum(learner.learn(lm.inputs(flat, ends, vocabulary), vocabulary.output[flat], ends, (k, 4)) for k in range(4))
    assert n == sum(len(at) for at, _, _ in laid) == len(whole(ends)[0])
    scored = np.concatenate([at[:, attention.CONTEXT:][live] for at, _, live in laid])
    assert sorted(scored.tolist()) == list(range(ends[-1]))
