"""Personal data: base patterns, and a linear-chain conditional random field.

The base patterns find e-mail addresses, IP addresses, card and phone numbers.
The field labels the words of a line (outside, or one of the four kinds) from
word shapes of the word and its neighbours; it is trained by gradient ascent
on the small labelled table below and decoded by Viterbi, many lines of like
length at once in numpy. Runs of one kind that touch no base span are added
(say a phone number without a plus, or a bracketed IP:port); base spans stay.

Only lines with a digit or an @ are decoded: `Field` proves at load that the
field labels every word of any other line as outside, by bounding the gain of
every other label over all features that such words can have.

One pass without a shuffle over whole texts; the trained weights (a few
hundred numbers) travel with the function.

Defined results: null and empty texts have no spans; repeated rows give repeated results;
an empty table gives an empty one; other columns are ignored by `find` and
kept by `redact`.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from duka.llm.words import byte_slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)

# --- labelled table: {kind: values}, lines with a slot {kind}, lines without personal data; in
# a value every 0 stands for a digit
VALUES = {
    "email": ["ann.lee@mail.example.com", "bo_00@corp.example.org", "x+list@example.net,", "<kim@uni.example.edu>",
              "was.00@mail0.example.com", "mailto:ray@example.com", "(jo-ann@example.co.uk)", "T.Roe@EXAMPLE.COM;",
              "j.doe%lab@example.info", "email=sam@example.io"],
    "ip": ["10.0.12.254", "192.168.1.7", "203.0.113.45,", "(198.51.100.9)", "172.16.4.30:8080", "[10.20.30.40]",
           "ip=192.0.2.61", "127.0.0.1;", "198.18.7.7/24", "http://10.1.2.3/"],
    "card": ["4539578763621486", "4111 1111 1111 1111", "5500-0055-5555-5559", "6011000990139424,", "378282246310005",
             "3782 822463 10005", "5105.1051.0510.5100", "(4222222222222220)", "4012-8888-8888-1881;", "card:4000056655665556"],
    "phone": ["+0 (000) 000-0000", "+00 00 0000 0000", "(000) 000-0000", "000-000-0000", "+0 (000) 000-0000,",
              "000.000.0000", "+0-000-000-0000", "+000000000000", "0-000-000-0000", "(000)000-0000", "(000) 000 0000;",
              "+00 000 000 000", "tel:+0-000-000-0000", "(00) 0000-0000", "+00 (0)00 0000 0000", "000-000-0000."],
}
SLOTS = ["please write to {} about it", "{} is of the", "the of and {} in to that", "Contact: {}", "ti {}",
         "son {} del en", "WITH {} AND", "a.%%% {} re$$$ on*** de###", "one | {} | two", "call {} or come",
         "- {}", "from 9 to 5: {} (office)"]
OUTSIDE = [
    "the of and in to that with 7 of them", "Licensed under CC BY-NC 4.0.", "Apache License, Version 2.0.",
    "General Public License, version 3.", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "in 1999 and 2004",
    "order 4785380592391138 of 9000426309966108 items", "on 2021-03-04 at 10:45:30 it was 3.14159 or 12,500",
    "page 12 of 340, see 4.2.1 and 5.10", "sum 1,234,567.89 USD 20% of 300", "8316107434564122 the", "a 12345678 b 123 c",
    "version 1.2.3 build 20240101", "THE!! OF!! 4225039295678254!! AND!!", "9311664600839015&&& of%%% the$$$",
    "code 999.888.777.666 fails", "1. first 2. second 3) third", "10 20 30 40 50", "a1 b22 c333 x-15 covid-19",
    "@home @all at 5 @ 7", "The and attion to thanedble the, anea.", "### --- *** || . !", "WORD WORDS AND MORE",
    "Éreç chpa aiémentou le de", "for (x) and 3-4 or 5-6-7", "12/31/1999 31.12.2024 2024-12-31T00:00:00",
    "ISBN 978-0-306-40615-7 of the", "lat 51.5074 lon -0.1278", "invoice 2024-000123 of 2024-05-06", "receipt 2023-004512 and 2022-118", "2021-000077 paid",
    "scores 21-19, 21-17 and 3:0", "room (415) and floor (2)", "rows 100-200 of 1000-2000", "1.2.3.4.5.6 of the list",
    "case no. 12-345-678", "IBAN DE89 3704 0044 0532 0130 00", "width 1920x1080, ratio 16:9", "id 550e8400-e29b-41d4-a716-446655440000",
    "temperature -12.5 to +3.4", "5 (five) + 3 (three) = 8", "years 1914-1918 and 1939-1945", "0.001 0.01 0.1 1 10",
    "at 08:15 and 23:59:59", "tracking 1Z999AA10123456784", "sum of +1 +2 +3", "phone 415 is a model", "@ann @bob_7 said 10",
]

_WORD = re.compile(r"[^\s|]+")
_DIGITS = re.compile(r"[0-9]")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, each kind leftmost and
    non-overlapping; matches that fail their check are dropped, not retried.
    Every scan is linear in the text."""
    out, floor = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, floor := m.end()))
        at = text.find("@", max(at + 1, floor))
    for m in _IP.finditer(text):
        parts, start = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            end = start + sum(map(len, parts[k:k + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts[k:k + 4]):
                out.append((start, 1, end))
            start = end + 1
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.findall(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def features(word: str) -> list[str]:
    """Word-shape features; a word without digit and @ has `plain` alone."""
    core = word.strip("$%&*#!,;:<>\"'|=")
    if not _DIGITS.search(core):
        return ["at"] + (["mail"] if _DOMAIN.search(core.rpartition("@")[2]) and core[0] != "@" else []) \
            if "@" in core else ["plain"]
    digits = "".join(_DIGITS.findall(core))
    out = ["digits", f"n{len(digits) if len(digits) < 5 else min(len(digits), 20) if len(digits) > 6 else 5}"]
    shape = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", core))
    out.append("s" + shape if len(shape) < 12 else "long")
    if "@" in core:
        out += ["at"] + (["mail"] if _DOMAIN.search(core.rpartition("@")[2]) and core[0] != "@" else [])
    if len(digits) > 12:
        out.append("luhn" if luhn(digits) else "noluhn")
    parts = [p for p in re.split(r"[^0-9.]", core) if p.count(".") == 3]
    if parts:
        out.append("quad" if all(p and len(p) < 4 and int(p) <= 255 for p in parts[0].split(".")) else "noquad")
    if core[0] in "+(":
        out.append("open" + core[0])
    return out


def _labelled() -> list[tuple[list[str], list[int]]]:
    """Each value in some of the slots, its zeros replaced by digits of a fixed sequence
    (those of the cards and addresses are digits already)."""
    rows, digit = [], 0
    for kind, values in VALUES.items():
        for i, value in enumerate(values):
            for slot in SLOTS[i % 3::3]:
                before, after = slot.split("{}")
                own = []
                for c in value:
                    digit += 1
                    own.append(str(1 + digit * digit % 9) if c == "0" and kind == "phone" else c)
                words, tags = [], []
                for part, tag in ((before, 0), ("".join(own), LABELS.index(kind)), (after, 0)):
                    found = _WORD.findall(part)
                    words, tags = words + found, tags + [tag] * len(found)
                rows.append((words, tags))
    return rows + [(w := _WORD.findall(line), [0] * len(w)) for line in OUTSIDE]


def fits(kind: int, text: str) -> bool:
    """Whether a labelled run can be of its kind: an address with a domain, four parts of at most
    255, 14 to 19 digits that pass Luhn, 7 to 15 digits."""
    digits = "".join(_DIGITS.findall(text))
    if kind == 0:
        return bool(_DOMAIN.search(text.rpartition("@")[2])) and "@" in text.strip("@")
    if kind == 1:
        return any(m[0].count(".") == 3 and all(len(p) < 4 and int(p) <= 255 for p in m[0].split("."))
                   for m in _IP.finditer(text))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def _observed(words: list[str]) -> list[list[str]]:
    """Features of each position: the word's and its neighbours'."""
    own = [features(w) for w in words]
    edge = [["edge"]]
    return [[*(f"0{f}" for f in c), *(f"-{f}" for f in b), *(f"+{f}" for f in a)]
            for b, c, a in zip(edge + own[:-1], own, own[1:] + edge)]


def train(steps: int = 150, rate: float = 0.4, decay: float = 2e-3) -> tuple[dict[str, list[float]], list[list[float]]]:
    """Weights (feature -> label scores, transitions) that maximise the
    penalised log-likelihood of the labelled table."""
    rows, index = _labelled(), {}
    data = []
    for words, tags in rows:
        ids = [[index.setdefault(f, len(index)) for f in fs] for fs in _observed(words)]
        data.append((np.concatenate(ids).astype(int), np.repeat(np.arange(len(ids)), [len(i) for i in ids]), np.array(tags)))
    n = len(LABELS)
    w, t = np.zeros((len(index), n)), np.zeros((n, n))
    mw, mt = np.zeros_like(w), np.zeros_like(t)

    def lse(x, axis):
        m = x.max(axis, keepdims=True)
        return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)

    for _ in range(steps):
        gw, gt = -decay * len(data) * w, -decay * len(data) * t
        for ids, at, tags in data:
            e = np.zeros((len(tags), n))
            np.add.at(e, at, w[ids])
            a, b = e.copy(), np.zeros_like(e)
            for k in range(1, len(e)):
                a[k] += lse(a[k - 1][:, None] + t, 0)
            for k in range(len(e) - 2, -1, -1):
                b[k] = lse(t + (e[k + 1] + b[k + 1])[None], 1)
            z = lse(a[-1], 0)
            p = np.eye(n)[tags] - np.exp(a + b - z)
            np.add.at(gw, ids, p[at])
            for k in range(1, len(e)):
                gt[tags[k - 1], tags[k]] += 1
                gt -= np.exp(a[k - 1][:, None] + t + (e[k] + b[k])[None] - z)
        mw, mt = mw + gw**2, mt + gt**2
        w, t = w + rate * gw / np.sqrt(mw + 1e-8), t + rate * gt / np.sqrt(mt + 1e-8)
    return {f: w[i].tolist() for f, i in index.items()}, t.tolist()


class Field:
    """Decodes lines with trained weights."""

    def __init__(self, weights: tuple[dict[str, list[float]], list[list[float]]], limit: int = 200_000):
        self.w = {f: np.array(v) for f, v in weights[0].items()}
        self.t, self.cache, self.limit = np.array(weights[1]), {}, limit
        zero = np.zeros(len(LABELS))
        gain = lambda v: (v - v[0])[1:].max()
        step = max(0.0, (self.t - self.t[0, 0]).max())
        around = max(gain(self.w.get(f"-{b}", zero) + self.w.get(f"+{a}", zero))
                     for b in ("plain", "edge") for a in ("plain", "edge"))
        if gain(self.w["0plain"]) + around + 2 * step >= 0:
            raise ValueError("the field may label words without digit and @; decode every line")

    def _scores(self, word: str) -> np.ndarray:
        """Label scores that a word gives itself, its next and its previous word."""
        if word not in self.cache:
            if len(self.cache) > self.limit:
                self.cache.clear()
            s = np.zeros((3, len(LABELS)))
            for f in features(word):
                for k, place in enumerate("0-+"):
                    s[k] += self.w.get(place + f, 0.0)
            self.cache[word] = s
        return self.cache[word]

    def decode(self, lines: list[list[str]]) -> list[np.ndarray]:
        """The best labels of each line, lines of like length together."""
        out: list = [None] * len(lines)
        groups = defaultdict(list)
        for i, words in enumerate(lines):
            groups[max(1, len(words)).bit_length()].append(i)
        edge = [self.w.get(f, np.zeros(len(LABELS))) for f in ("-edge", "+edge")]
        for size, members in groups.items():
            per = max(1, (1 << 18) >> size)
            for k in range(0, len(members), per):
                part = members[k:k + per]
                n = max(len(lines[i]) for i in part)
                e = np.zeros((len(part), n, len(LABELS)))
                for row, i in enumerate(part):
                    s = np.array([self._scores(w) for w in lines[i]])
                    if len(s):
                        e[row, :len(s)] = s[:, 0]
                        e[row, 1:len(s)] += s[:-1, 1]
                        e[row, :len(s) - 1] += s[1:, 2]
                        e[row, 0] += edge[0]
                        e[row, len(s) - 1] += edge[1]
                for i, path in zip(part, self._viterbi(e, np.array([len(lines[i]) for i in part]))):
                    out[i] = path[:len(lines[i])]
        return out

    def _viterbi(self, e: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        best, back = e[:, 0].copy(), np.zeros(e.shape, np.int8)
        for k in range(1, e.shape[1]):
            step = best[:, :, None] + self.t[None]
            live = (lengths > k)[:, None]
            back[:, k] = np.where(live, step.argmax(1), np.arange(len(LABELS))[None])
            best = np.where(live, step.max(1) + e[:, k], best)
        path = np.zeros(e.shape[:2], np.int8)
        path[:, -1] = best.argmax(1)
        rows = np.arange(len(e))
        for k in range(e.shape[1] - 1, 0, -1):
            path[:, k - 1] = back[rows, k, path[:, k]]
        return path

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(start, kind, end) of the labelled runs of each text."""
        lines, where = [], []
        for i, text in enumerate(texts):
            at = 0
            while m := _HELD.search(text, at):
                start = text.rfind("\n", 0, m.start()) + 1
                at = text.find("\n", m.end())
                at = len(text) if at < 0 else at
                found = [(w.start(), w[0]) for w in _WORD.finditer(text, start, at)]
                lines.append([w for _, w in found])
                where.append((i, [s for s, _ in found]))
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for (i, starts), words, tags in zip(where, lines, self.decode(lines)):
            for k in np.flatnonzero(tags):
                if k and tags[k - 1] == tags[k]:
                    continue
                last = k
                while last + 1 < len(tags) and tags[last + 1] == tags[k]:
                    last += 1
                for x, y in self._pieces(texts[i], int(tags[k]) - 1, starts, words, k, last):
                    out[i].append((x, int(tags[k]) - 1, y))
        return out


    @staticmethod
    def _pieces(text: str, kind: int, starts: list[int], words: list[str], k: int, last: int) -> list[tuple[int, int]]:
        """The stretches of the run of words k .. last that fit the kind: the whole run, or else, from the left,
        the longest that do."""
        found = []
        while k <= last:
            for end in range(min(last, k + 7), k - 1, -1):
                run = text[starts[k]:starts[end] + len(words[end])]
                left, right = _EDGE.match(run).end(), _TAIL.search(run).start()
                if left < right and fits(kind, run[left:right]):
                    found.append((starts[k] + left, starts[k] + right))
                    break
            else:
                end = k
            k = end + 1
        return found


_HELD = re.compile(r"[0-9@]")
_EDGE = re.compile(r"(?:[^\w+(]*(?:mailto:)?)")
_TAIL = re.compile(r"[^\w)]*\Z")


def find_slice(texts: pa.Array, field: Field) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    texts = pc.fill_null(texts, "")
    held = np.flatnonzero(pc.match_substring_regex(texts, "[0-9@]").to_numpy(zero_copy_only=False))
    out: list[tuple[list, list]] = [([], [])] * len(texts)
    some = texts.take(pa.array(held)).to_pylist()
    for i, text, added in zip(held, some, field.spans(some)):
        base = base_spans(text)
        free = [s for s in added if all(s[2] <= b[0] or s[0] >= b[2] for b in base)] if added else []
        out[i] = (base, sorted(base + free))
    return out


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256, spans, n_added."""
    weights = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(weights)
        for batch in byte_slices(batches, "text"):
            found = find_slice(batch.column("text"), field)
            count = [pa.array([sum(s[1] == k for s in base) for base, _ in found], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *count,
                 pa.array([hashlib.sha256(_said(base).encode()).hexdigest() for base, _ in found], pa.string()),
                 pa.array([_said(every) for _, every in found], pa.string()),
                 pa.array([len(every) - len(base) for base, every in found], pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(
        run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
             "spans string, n_added bigint")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span (or run of overlapping ones) replaced by [KIND]."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """`docs` with every span of `text` masked; a null text stays null."""
    weights = train()
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(weights)
        for batch in byte_slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            found = find_slice(batch.column("text"), field)
            new = [masked(t, every) if every else t for t, (_, every) in zip(texts, found)]
            yield batch.set_column(place, "text", pa.array(new, batch.column("text").type))

    return docs.mapInArrow(run, docs.schema)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
