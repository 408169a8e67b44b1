"""Main text of web pages from flat blocks and a decision tree.

A page is read as a flat row of text blocks. Each block is described by its number of words, the
share of words inside links (link density), the same two figures of both neighbours, and where it
stands: inside an article, inside an element that is never article (menus, headers, footers,
sidebars, forms), below a class, id or role whose name says so, and whether it is a heading. A
decision tree, trained on the small labelled table below, keeps or drops each block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = (
    "words", "links", "before_words", "before_links", "after_words", "after_links",
    "inside", "outside", "named", "heading",
)
#: Labelled blocks: the features in their order, then 1 for article and 0 for anything else.
LABELLED = """
24 0    6 1     80 0    1 0 0 0  1
2  0    60 0    40 0    1 0 0 0  1
7  0    8 0     30 0    1 0 0 1  1
130 0   7 0     90 0    1 0 0 0  1
60 0.1  130 0   2 0     1 0 0 0  1
6  0    90 0    9 0.2   1 0 0 0  1
45 0.4  60 0    70 0    1 0 0 0  1
1  0    30 0    200 0   1 0 0 0  1
12 0.9  60 0    80 0    1 0 0 0  1
5  1    40 0    60 0    1 0 0 0  1
4  0    9 1     70 0    1 0 0 1  1
300 0   1 0     3 0     1 0 0 0  1
9  0    1 1     20 0    1 0 0 0  1
8  1    8 1     9 1     1 1 0 0  0
14 0    40 0    12 0    1 1 0 0  0
30 0    80 0    1 0     1 1 0 0  0
70 0    90 0    20 0    1 1 0 0  0
10 0    60 0    50 0    1 0 1 0  0
45 0    80 0    70 0    1 0 1 0  0
3  0    60 0    30 0    1 0 1 1  0
120 0   70 0    60 0    1 0 1 0  0
1  1    0 0     1 1     0 1 0 0  0
1  1    1 1     1 1     0 1 0 0  0
2  1    1 1     8 0     0 1 0 0  0
12 0.1  90 0    0 0     0 1 0 0  0
60 0    40 0    0 0     0 1 0 0  0
5  0    0 0     3 1     0 1 0 1  0
150 0   80 0    40 0    0 1 0 0  0
8  0    1 1     9 0     0 0 1 0  0
25 0    60 0    12 0    0 0 1 0  0
90 0    30 0    14 0    0 0 1 0  0
4  0    90 0    40 0    0 0 1 1  0
7  0    0 0     70 0    0 0 0 1  1
80 0    7 0     60 0    0 0 0 0  1
55 0.05 80 0    40 0    0 0 0 0  1
9  0    55 0    60 0    0 0 0 0  1
3  0    70 0    45 0    0 0 0 0  1
35 0    9 0     50 0    0 0 0 0  1
28 0    90 0    4 0.5   0 0 0 0  1
20 0    0 0     90 0    0 0 0 0  1
110 0.2 3 1     4 1     0 0 0 0  1
22 0    60 0    0 0     0 0 0 0  1
3  1    2 1     4 1     0 0 0 0  0
6  0.8  90 0    5 1     0 0 0 0  0
20 0.9  3 1     15 1    0 0 0 0  0
30 0.7  60 0    25 0.8  0 0 0 0  0
2  0    3 1     4 1     0 0 0 0  0
4  0    5 0     3 0     0 0 0 0  0
6  0    2 0     0 0     0 0 0 0  0
5  0    0 0     4 0     0 0 0 0  0
7  0.3  6 0.9   3 1     0 0 0 0  0
3  0    4 1     8 0     0 0 0 1  0
8  1    0 0     120 0   0 1 0 0  0
10 0    5 1     90 0    0 1 0 1  0
30 0    200 0   60 0    0 1 0 0  0
6  0    90 0    80 0    1 1 0 0  0
14 0.3  12 0    55 0    0 1 0 0  0
3  1    2 1     60 0    0 1 0 0  0
85 0    60 0    75 0    0 1 0 0  0
40 0    3 1     130 0   1 1 0 0  0
25 0    0 0     100 0   0 1 1 0  0
20 0    70 0    140 0   0 0 1 0  0
9  0.4  0 0     65 0    0 0 1 0  0
3  1    2 1     150 0   0 0 0 0  0
5  1    0 0     60 0    0 0 0 0  0
12 0.8  80 0    70 0    0 0 0 0  0
18 1    20 1    95 0    0 0 0 0  0
9  0    0 0     85 0    1 0 0 1  1
15 0    3 1     160 0   1 0 0 0  1
4  0    2 0     3 0     1 0 0 0  1
3  0    4 0     2 0     1 0 0 0  1
8  0.5  2 1     3 1     1 0 0 0  1
11 0    0 0     0 0     1 0 0 0  1
2  0    1 1     45 0    1 0 0 0  1
65 0    55 0    120 0   0 0 0 0  1
40 0    0 0     0 0     0 0 0 0  1
6  0    60 0    90 0    0 0 0 1  1
12 0    80 0    6 1     0 0 0 0  1
16 0    60 0    120 0   0 0 0 0  1
33 0.1  12 0    9 0     0 0 0 0  1
26 0    26 0    26 0    0 0 0 0  1
48 0    2 1     2 1     0 0 0 0  1
"""
#: Elements whose text is no text of the page.
SKIPPED = frozenset("script style noscript template head title svg math iframe object embed audio video canvas map "
                    "select option datalist textarea button".split())
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
INSIDE = frozenset("article main".split())
OUTSIDE = frozenset("nav header footer aside form menu dialog fieldset label".split())
BLOCKS = HEADINGS | INSIDE | OUTSIDE | frozenset(
    "address blockquote body center dd details div dl dt figcaption figure hr html legend li ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
#: Parts of a class, id or role that mark what is not the article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox alert announcement banner breadcrumb breadcrumbs "
    "comment comments commentlist complementary consent contentinfo cookie cookies copyright discussion disclaimer "
    "disqus dropdown follow foot footer footnav form gdpr head header hidden legal login masthead menu menubar message modal "
    "nav navbar navigation newsletter notice notification overlay pager pagination paywall popup promo promoted "
    "promotion recommended recommendation related replies reply respond responses search share sharing sidebar "
    "signup site-footer skip skyscraper social sponsor sponsored subscribe subscription tags teaser toolbar tooltip topbar "
    "warning widget".split())
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
SPECIAL = re.compile(r"""[>"']""")
ATTRIBUTE = re.compile(r"""(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|$)""", re.I)
WHITE = re.compile(r"\s+")
DECLARED = re.compile(r"""<html\b[^>]*?\slang\s*=\s*["']?\s*([a-z]+)""", re.I)


class Tokens:
    """Comments, tags and declarations of a page in their order, found in time linear in its length.

    A tag ends at the first ``>`` outside quotes. Where that is depends only on the next special character,
    so what was found from one is kept, and a page of tags that never end is not searched again and
    again.
    """

    def __init__(self, page: str):
        self.page = page
        self.ends: dict[int, int] = {}
        self.gap = (0, -1)  # from the first place to the second there is no special character but the last
        self.last = {c: page.rfind(c) for c in "<>\"'"}
        self.barren = 0

    def special(self, at: int) -> int:
        """The next ``>`` or quote from `at` on, or -1."""
        if not self.gap[0] <= at <= self.gap[1]:
            m = SPECIAL.search(self.page, at)
            self.gap = (at, m.start() if m else len(self.page))
        return self.gap[1] if self.gap[1] < len(self.page) else -1

    def tag_end(self, at: int) -> int:
        """Where the ``>`` is that ends a tag of which `at` is a place outside quotes; -1 if none does."""
        passed, found = [], -1
        while at <= self.last[">"]:
            at = self.special(at)
            if at in self.ends:
                found = self.ends[at]
                break
            passed.append(at)
            char = self.page[at]
            if char == ">":
                found = at
                break
            if self.last[char] <= at:
                break
            at = self.page.find(char, at + 1) + 1
        self.ends.update(dict.fromkeys(passed, found))
        return found

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start and end of the next token from `at` on, and of a tag its slash, name and attributes."""
        page = self.page
        while (i := page.find("<", at)) >= 0:
            if page.startswith("<!--", i):
                stop = page.find("-->", i + 4)
                return i, stop + 3 if stop >= 0 else len(page), "", "", ""
            m = NAME.match(page, i) if i >= self.barren and i < self.last[">"] else None
            if m:
                # A quote may belong to the name or open a value: the longest name that gives a tag counts.
                # If none does, none that starts inside this name and ends with it does either.
                self.barren = m.end()
                for cut in (m.end(), *(k for k in range(m.end() - 1, m.start(2), -1) if page[k] in "\"'")):
                    stop = self.tag_end(cut)
                    if stop >= 0:
                        return i, stop + 1, m[1], page[m.start(2):cut], page[cut:stop]
            if page[i + 1:i + 2] in ("!", "?", "/"):
                stop = page.find(">", i + 2) if self.last[">"] > i + 1 else -1
                return i, stop + 1 if stop >= 0 else len(page), "", "", ""
            if self.last["<"] == i and page[i + 1:i + 2].isascii() and page[i + 1:i + 2].isalpha():
                return i, len(page), "", "", ""
            at = i + 1
        return None


@dataclass
class Block:
    text: str
    words: int
    linked: int
    inside: bool
    outside: bool
    named: bool
    heading: bool


def _named(attributes: str, inside: bool) -> bool:
    """Whether attributes say that an element is hidden or no article; the head of an article is part of it."""
    for name, value in ATTRIBUTE.findall(attributes):
        value, name = value.strip("\"'").lower(), name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        elif any(part in NAMES and not (inside and part in ("head", "header")) for part in re.split(r"[\s_-]+", value)):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in their order. Broken markup is read as browsers do: an open
    element ends with the element around it, an unfinished tag at the end is no text."""
    out: list[Block] = []
    stack: list[tuple[str, int, int, int, int, int]] = []  # tag and counts so far: inside, outside, named, heading, skipped
    parts: list[tuple[str, bool]] = []
    links = 0
    state = (0, 0, 0, 0, 0)

    def close() -> None:
        nonlocal parts
        if parts:
            text = WHITE.sub(" ", html.unescape("".join(p for p, _ in parts))).strip()
            if text:
                linked = sum(len(html.unescape(p).split()) for p, in_link in parts if in_link)
                out.append(Block(text, len(text.split()), linked, state[0] > 0, state[1] > 0, state[2] > 0, state[3] > 0))
            parts = []

    at, end, tokens, opened = 0, len(page), Tokens(page), Counter()
    while at < end:
        token = tokens.next(at)
        text = page[at:token[0] if token else end]
        if text and not state[4]:
            parts.append((text, links > 0))
        if not token:
            break
        _, at, slash, name, attributes = token
        tag = name.lower()
        if not tag:
            continue
        if slash:
            if tag == "a":
                links = max(0, links - 1)
            if tag in BLOCKS:
                close()
            while opened[tag]:  # ends the elements inside it as well
                inner, *before = stack.pop()
                opened[inner] -= 1
                if inner == tag:
                    if state != tuple(before):
                        close()
                    state = tuple(before)
                    break
            continue
        if tag in BLOCKS:
            close()
            links = 0
        elif tag == "br":
            if not state[4]:
                parts.append((" ", False))
        if tag == "a":
            links += 1
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS | RAW:
            continue
        named = _named(attributes, state[0] > 0) and tag not in ("html", "body")
        if tag in RAW:  # its content ends only at its own end tag
            stop = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else end
            parts.append((" ", False)) if tag not in ("textarea", "title") and parts else None
            continue
        step = (tag in INSIDE, tag in OUTSIDE and not (tag == "header" and state[0]), named, tag in HEADINGS, tag in SKIPPED)
        if named and tag not in BLOCKS:
            close()
        if tag in BLOCKS or any(step):
            stack.append((tag, *state))
            opened[tag] += 1
            state = tuple(a + b for a, b in zip(state, step))
            if tag == "p" and len(stack) > 1 and stack[-2][0] == "p":  # an open paragraph ends where the next begins
                stack[-2:] = [("p", *stack[-2][1:])]
                opened[tag] -= 1
                state = tuple(a + b for a, b in zip(stack[-1][1:], step))
    close()
    return out


def table(own: list[Block]) -> np.ndarray:
    """Features of the blocks of one page, in the order of `FEATURES`."""
    density = lambda b: b.linked / b.words if b.words else 0.0
    rows = []
    for i, b in enumerate(own):
        before = own[i - 1] if i else None
        after = own[i + 1] if i + 1 < len(own) else None
        near = [x for n in (before, after) for x in ((n.words, density(n)) if n else (0, 0.0))]
        rows.append((b.words, density(b), *near, b.inside, b.outside, b.named, b.heading))
    return np.array(rows, float).reshape(-1, len(FEATURES))


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8):
    """A decision tree as nested (feature, limit, at most, above) or a label: Gini, halfway limits."""
    if depth == 0 or len(set(y.tolist())) < 2:
        return int(y.mean() >= 0.5)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for limit in (values[1:] + values[:-1]) / 2:
            left = x[:, f] <= limit
            impure = sum(s.sum() * (p := y[s].mean()) * (1 - p) for s in (left, ~left))
            if best is None or impure < best[0] - 1e-12:
                best = (impure, f, limit, left)
    if best is None:
        return int(y.mean() >= 0.5)
    _, f, limit, left = best
    return (f, float(limit), grow(x[left], y[left], depth - 1), grow(x[~left], y[~left], depth - 1))


def trained(labelled: str = LABELLED):
    data = np.array([line.split() for line in labelled.strip().splitlines()], float)
    return grow(data[:, :-1], data[:, -1])


def keeps(tree, row: np.ndarray) -> bool:
    while not isinstance(tree, int):
        f, limit, low, high = tree
        tree = low if row[f] <= limit else high
    return tree == 1


def main_text(page: str | None, tree) -> str:
    own = blocks(page or "")
    return "\n\n".join(b.text for b, row in zip(own, table(own)) if keeps(tree, row))


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every row of `pages`: page_id, url, text (empty if none), n_chars (code points),
    and lang, the declared markup language (null if none).

    A null or empty page has an empty text; null ids and urls are kept; repeated rows are returned as
    often as they occur; a page of any length is read whole; no rows give no rows; other columns are
    not looked at.
    """
    tree = trained()
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(t.as_py(), tree) for t in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([m[1].lower() if (m := DECLARED.search(t.as_py())) else None for t in batch.column("html")], pa.string())],
                names=["page_id", "url", "text", "n_chars", "lang"])

    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, lang string")
