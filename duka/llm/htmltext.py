"""Main text of web pages by line-block distribution.

Markup is stripped to one line per block. A line weighs its characters
outside links, and nothing if it lies in page furniture (menus, headers,
footers, sidebars, notices, adverts, forms, comments). A line of an <article>
or <main> weighs as much as the page's heaviest line more, so that its short
lines count too. Weights are summed over sliding windows of `WINDOW` lines,
which end where a named element starts or ends. The text surges where the block
sum rises over half the mean block sum (of the page; inside a named element, of that
element) and dives where it falls to zero or a named element starts or ends;
the lines between are kept, without furniture. So text outside the named
elements is kept where it is as dense as theirs.

Each page is one row of one pass without a shuffle; whole pages are read, in time
linear in their length.

Defined results: null, empty or textless html gives an empty text; an element
of furniture that is never closed ends where the article starts or else with
the page; a hidden or furniture <p> or <li> without end tag ends with the next block, list entry or parent;
repeated pages give repeated rows; an empty table an empty result;
other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from duka.llm.words import byte_slices

WINDOW = 3

# Element names of the HTML standard, and usual class words.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead title tr ul".split())
DROPPED = frozenset(
    "script style noscript template svg head title nav header footer aside form button select textarea iframe "
    "object menu dialog canvas".split())
RAW = frozenset("script style textarea title".split())
OPTIONAL = frozenset(("p", "li"))       # their end tags may be missing
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# A block container is furniture if a part of a class word is one of these ...
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|breadcrumbs?|comments?|cookies?|consent|disqus|menu|modal|nav|navbar|navigation|"
    r"newsletter|pagination|popup|promo\w*|replies|respond|sharing|sidebar|sponsor\w*|subscribe|toolbar|widget)"
    r"(?:$|[\s_-])", re.I)
# ... or, outside the article, one of these; in the article a whole class word must be one of WHOLE.
LOOSE = re.compile(r"(?:^|[\s_-])(?:banner|footer|header|notices?|related|share|social)(?:$|[\s_-])", re.I)
WHOLE = re.compile(r"(?:^|\s)(?:banner|footer|related|share|social)(?:$|\s)", re.I)
# An id is one word for the whole element, so it must be a furniture word as it stands.
SLUG = re.compile(rf"(?:{FURNITURE.pattern}|{LOOSE.pattern})", re.I)
ASIDE = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|related|repl(?:y|ies)|respond|teasers?)(?:$|[\s_-])", re.I)

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)/?>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+)))?""")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)


def _attributes(text: str) -> dict[str, str]:
    return {name.lower(): a or b or c for name, a, b, c in _ATTRIBUTE.findall(text)}


def _is_aside(attributes: dict[str, str]) -> bool:
    """Whether a class word or the id is of comments or teasers."""
    slug = attributes.get("id", "")
    return bool(ASIDE.search(attributes.get("class", "")) or "-" not in slug and "_" not in slug and ASIDE.search(slug))


def _is_hidden(attributes: dict[str, str]) -> bool:
    return ("hidden" in attributes and attributes["hidden"].lower() != "until-found"
            or attributes.get("aria-hidden", "").lower() == "true" or bool(_UNSEEN.search(attributes.get("style", ""))))


def _is_furniture(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    if name in DROPPED:
        return not (name == "header" and in_article) or _is_hidden(attributes)
    if not attributes or name in ("html", "body", "main"):
        return False
    if _is_hidden(attributes):
        return True
    if name == "article":
        return _is_aside(attributes)
    if name not in BLOCKS or name in HEADINGS:
        return False
    words, slug = f'{attributes.get("class", "")} {attributes.get("role", "")}', attributes.get("id", "")
    return bool(FURNITURE.search(words) or (WHOLE if in_article else LOOSE).search(words)
                or "-" not in slug and "_" not in slug and not (in_article and LOOSE.search(slug)) and SLUG.search(slug))


class _Open:
    """The open elements of furniture, with the last place of each name."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.places: dict[str, list[int]] = {}

    def __len__(self) -> int:
        return len(self.names)

    def __contains__(self, name: str) -> bool:
        return bool(self.places.get(name))

    def last(self, name: str) -> int:
        """Place of the innermost element of that name, -1 if there is none."""
        found = self.places.get(name)
        return found[-1] if found else -1

    def push(self, name: str) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)

    def cut(self, size: int) -> None:
        """Close all but the outer `size` elements."""
        while len(self.names) > size:
            self.places[self.names.pop()].pop()


def lines_of(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, characters outside links, furniture, in the article) per block."""
    out: list[tuple[str, int, bool, bool]] = []
    text: list[str] = []
    linked, skip, article, in_link = 0, _Open(), 0, 0
    aside = 0       # furniture open when comments or teasers began, these included

    def flush() -> None:
        nonlocal linked
        line = " ".join(entities.unescape("".join(text)).split())
        if line:
            out.append((line, max(0, len(line) - linked), bool(skip), article > 0))
        text.clear()
        linked = 0

    def add(part: str) -> None:
        nonlocal linked
        text.append(part)
        if in_link:
            linked += len(part)

    at = 0
    while True:
        m = _TAG.search(page, at)
        add(page[at:m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name == "a":
                in_link = max(0, in_link - 1)
            if name in BLOCKS or name in DROPPED:
                flush()
                if skip and skip.names[0] in OPTIONAL and name not in skip and name != "p" and name not in HEADINGS:
                    skip.cut(0)     # the end of an element around a <p> or <li> ends it too
                    aside = 0
            if name in skip:
                skip.cut(skip.last(name))
                aside = aside if aside <= len(skip) else 0
            if name in ("article", "main"):
                article = max(0, article - 1)
            continue
        if name in BLOCKS or name in DROPPED:
            flush()
            if skip and skip.names[-1] == "p":  # a <p> ends where the next block starts
                skip.cut(len(skip) - 1)
            if name == "li" and "li" in skip:   # a <li> where the next one of its list starts
                if max(map(skip.last, ("ul", "ol", "menu"))) < skip.last("li"):
                    skip.cut(skip.last("li"))
            aside = aside if aside <= len(skip) else 0
        if name == "br":
            add(" ")
        if name in VOID or m[0].endswith("/>"):
            continue
        attributes = _attributes(m[3]) if m[3] else {}
        if name in ("article", "main"):
            if not (aside or "header" in skip or "footer" in skip or name == "article" and _is_aside(attributes)):
                skip.cut(0)     # furniture left open ends here
            article += 1
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif skip and name == skip.names[-1] or _is_furniture(name, attributes, article > 0):
            skip.push(name)
            if not aside and name not in DROPPED and _is_aside(attributes):
                aside = len(skip)
        elif skip and (name in BLOCKS or name in skip):
            skip.push(name)
        if name == "a":
            in_link += 1
    flush()
    return out


def main_text(page: str | None, window: int = WINDOW) -> str:
    """Text of the article, its blocks joined by line feeds."""
    lines = lines_of(page) if page else []
    if not lines:
        return ""
    own = np.array([0 if off else n for _, n, off, _ in lines], np.int64)
    named = np.array([inside for _, _, _, inside in lines])
    plain = np.array([not off for _, _, off, _ in lines])
    weight = own + max(1, own.max()) * (named & plain)
    if not weight.any():
        return ""
    run = np.cumsum(np.r_[False, named[1:] != named[:-1]])
    sums = weight.copy()        # block i: lines i .. i + window - 1 of its run
    for k in range(1, min(window, len(lines))):
        sums[:-k] += weight[k:] * (run[k:] == run[:-k])
    # a named element is measured by its own blocks, so a short one beside a long one surges too
    level = np.where(named, (np.bincount(run, sums) / np.bincount(run))[run], sums.mean()) / 2
    keep, inside, last = [], False, 0
    for k, (line, _, _, _) in enumerate(lines):
        # surge: the block sum rises over the level and the line has weight; dive: the sum is zero, or another run
        inside = bool(sums[k]) if inside and run[k] == last else bool(weight[k] and sums[k] > level[k])
        last = run[k]
        if inside and plain[k]:     # a line of links alone between lines of text is text
            keep.append(line)
    return "\n".join(keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "html"):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as bigint) page_id", "cast(url as string) url",
                            "cast(html as string) html") \
        .mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
