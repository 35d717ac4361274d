"""Main text of web pages by minimum-cut labelling of text blocks.

A page is read into blocks of text with what is known of each: the elements
around it, their class and id words, link share, length, punctuation.  A
logistic classifier gives each block log-odds of being content; they become the
capacities of its edges to the two terminals.  Neighbouring blocks are tied by
smoothness edges, the stronger the closer they are in the element tree, and so
are consecutive blocks of one parent.  The minimum cut, found by maximum flow,
is the labelling.

The classifier is trained on a bounded sample of pages: blocks inside
article or main elements against blocks inside navigation, footers, asides
and forms, with and without knowing of these elements, starting from prior
weights and held near them; pages without such elements are judged by what
text and class words were learnt to tell.

Defined results: null or empty html gives empty text; broken markup is read as
browsers do, roughly (unknown end tags are ignored, open elements closed by
their parents, a tag without its ``>`` is text); reading takes time linear in the
page; very long pages are read whole; blocks of one text are separate blocks;
null ids, repeated rows kept; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anthro.llm.common import arrow_schema, column, record_batch

MAX_PAGES = 500
MAX_PAGE_CHARS = 100_000
ADJACENT = 0.8            # smoothness of neighbours at distance 0
SIBLING = 0.5             # of consecutive blocks of one parent
RIDGE = 0.2               # pull to the prior weights

# Element and class words.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea iframe title".split())      # text up to their end tag
UNSEEN = frozenset("template svg select option datalist".split())   # elements whose text is not the page's
BLOCK = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"br", "button", "body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
CLOSED_BY_OWN = {"li": "ul ol menu", "dd": "dl", "dt": "dl", "td": "tr table", "th": "tr table", "tr": "table", "option": "select"}
WALLS = frozenset("article aside div section main td th li body nav footer header form blockquote button template svg select".split())
BOILER_TAGS = frozenset("nav footer aside form menu button fieldset dialog".split())
BOILER_WORDS = frozenset("ad ads advert advertisement adverts adv banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal "
                         "overlay newsletter subscribe subscription signup login register paywall sidebar side widget widgets menu menubar nav navbar navigation "
                         "breadcrumb breadcrumbs share sharing social related recommended recommendations trending popular comment comments commentlist disqus reply "
                         "replies respond footer masthead topbar toolbar copyright pagination pager search form tags tagcloud skip hidden legal disclaimer outbrain taboola".split())
CONTENT_WORDS = frozenset("article articlebody content entry story post text body main maincontent prose".split())

FEATURES = ("bias", "in_content_element", "outside_of_one", "boiler_element", "page_header", "boiler_word", "content_word", "link_share", "length", "sentence",
            "list_item", "hidden", "copyright")
ELEMENT_FEATURES = np.array([f in ("in_content_element", "outside_of_one", "boiler_element", "page_header", "hidden") for f in FEATURES])
PRIOR = np.array([-0.8, 3.0, -3.0, -6.0, -4.0, -5.0, 1.0, -4.0, 2.0, 1.0, -0.3, -6.0, -3.0])

_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_MARK = re.compile(r"""[>"']""")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
_ATTRS = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class _Element:
    __slots__ = ("tag", "parent", "block", "depth", "content", "boiler", "header", "boiler_word", "content_word", "hidden", "link", "item", "unseen")

    def __init__(self, tag: str, attrs: str, parent: _Element | None):
        self.tag, self.parent = tag, parent
        self.block = self if parent is None or tag in BLOCK else parent.block
        if parent is None:
            self.depth = self.content = self.boiler = self.header = self.boiler_word = self.content_word = self.hidden = self.link = self.item = self.unseen = 0
        else:
            self.depth = parent.depth + 1
            self.content, self.boiler, self.header, self.boiler_word = parent.content, parent.boiler, parent.header, parent.boiler_word
            self.content_word, self.hidden, self.link, self.item = parent.content_word, parent.hidden, parent.link, parent.item
            self.unseen = parent.unseen or tag in UNSEEN
        if tag in ("article", "main"):
            self.content = 1
        elif tag in BOILER_TAGS:
            self.boiler = 1
        elif tag == "header" and not self.content:
            self.header = 1
        elif tag == "a":
            self.link = 1
        elif tag == "li":
            self.item = 1
        if attrs:
            for name, value in _ATTRS.findall(attrs):
                name = name.lower()
                value = value.strip("\"'")
                if name in ("class", "id"):
                    words = {w.lower() for w in _WORDS.findall(value)}
                    if tag not in ("body", "html"):
                        self.boiler_word |= not words.isdisjoint(BOILER_WORDS)
                        self.content_word |= not words.isdisjoint(CONTENT_WORDS)
                elif name == "role":
                    self.content |= value == "main"
                    self.boiler |= value in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert")
                elif name == "hidden" and (not value or value.lower() != "until-found") or name == "aria-hidden" and value == "true" \
                        or name == "style" and re.search(r"display\s*:\s*none", value):
                    self.hidden = 1


class Block:
    __slots__ = ("text", "linked", "parent")

    def __init__(self, text: str, linked: int, parent: _Element):
        self.text, self.linked, self.parent = text, linked, parent


class _Scanner:
    """Tags of a page, in one pass whose time is linear whatever the markup."""

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in (">", '"', "'")}
        self.quotes = True

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag, -1 if none does; a ``>`` in quotes does not, unless none stands outside of them."""
        if at > self.last[">"]:
            return -1
        i = at
        while self.quotes:
            m = _MARK.search(self.page, i)
            if not m:
                self.quotes = False  # quotes that never close as they should: from here on they do not count
                break
            c, i = m[0], m.end()
            if c == ">":
                return m.start()
            if i <= self.last[c]:
                i = self.page.find(c, i) + 1
        return self.page.find(">", at)

    def next(self, at: int) -> tuple[int, int, str | None, bool, str] | None:
        """(start, end, name, whether an end tag, attributes) of the next tag; the name is None for comments and the like."""
        page = self.page
        while True:
            start = page.find("<", at)
            if start < 0:
                return None
            m = _NAME.match(page, start)
            if m:
                end = self.tag_end(m.end())
                if end < 0:
                    return None
                return start, end + 1, m[2].lower(), bool(m[1]), page[m.end():end]
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, (end + 3 if end >= 0 else len(page)), None, False, ""
            if page[start + 1:start + 2] in ("!", "?", "/"):
                end = page.find(">", start)
                return start, (end + 1 if end >= 0 else len(page)), None, False, ""
            at = start + 1


def read_blocks(page: str | None) -> list[Block]:
    """Blocks of visible text in page order.

    An element of ``RAW`` without an end tag is empty (a script or style runs to the end of the page), and so is
    one of ``UNSEEN``; with one it ends there or with its parent.
    """
    out: list[Block] = []
    if not page:
        return out
    scanner = _Scanner(page)
    node = _Element("", "", None)
    opened: dict[str, int] = {}  # how many elements of each name are open
    last_end: dict[str, int] = {}
    parts: list[str] = []
    links = at = pos = 0
    home = node

    def flush() -> None:
        nonlocal links
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, min(links, len(text)), home))
            parts.clear()
        links = 0

    def leave(to: _Element) -> None:
        """Close the open elements down to ``to``, which stays open."""
        nonlocal node
        while node is not to:
            opened[node.tag] -= 1
            node = node.parent

    def close(tag: str, walls: str) -> None:
        """End the nearest open ``tag``, unless a container stands between."""
        if not opened.get(tag):
            return
        stop = walls.split() or WALLS
        up = node
        while up is not None and up.tag not in stop:
            if up.tag == tag:
                leave(up.parent)
                return
            up = up.parent

    while True:
        found = scanner.next(pos)
        stop = found[0] if found else len(page)
        if stop > at and not node.unseen:
            if not parts:
                home = node.block
            parts.append(page[at:stop])
            if node.link:
                links += stop - at
        if not found:
            break
        _, pos, tag, ends, attrs = found
        at = pos
        if tag is None:
            continue
        empty = attrs.endswith("/")
        if tag in RAW and not ends:
            if not empty:
                end = _RAW_END[tag].search(page, pos) if last_end.get(tag, pos) >= pos else None
                if end:
                    at = pos = end.end()
                else:
                    last_end[tag] = -1  # searched once
                    if tag in ("script", "style"):
                        at = pos = len(page)
            continue
        if tag in BLOCK:
            flush()
        if ends:
            if opened.get(tag):
                up = node
                while up.tag != tag:
                    up = up.parent
                leave(up.parent)
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_P:
            close("p", "")
        if tag in CLOSED_BY_OWN:
            close(tag, CLOSED_BY_OWN[tag])
        if empty and tag not in BLOCK:
            continue
        if tag in UNSEEN:
            if tag not in last_end:
                last_end[tag] = max(page.rfind(f"</{tag}"), page.rfind(f"</{tag.upper()}"))
            if last_end[tag] < pos:
                continue
        node = _Element(tag, attrs, node)
        opened[tag] = opened.get(tag, 0) + 1
    flush()
    return out


def features(blocks: list[Block]) -> np.ndarray:
    x = np.zeros((len(blocks), len(FEATURES)))
    any_content = any(b.parent.content for b in blocks)
    for i, b in enumerate(blocks):
        e, n = b.parent, len(b.text)
        x[i] = (1, e.content, any_content and not e.content, e.boiler, e.header, e.boiler_word, e.content_word, b.linked / n, math.log1p(n) / 5,
                b.text[-1] in ".!?…\"”»" or n > 200, e.item, e.hidden, "©" in b.text or "all rights reserved" in b.text.lower())
    return x


# ---------------------------------------------------------------- cut

def smoothness(blocks: list[Block], adjacent: float = ADJACENT, sibling: float = SIBLING) -> dict[tuple[int, int], float]:
    """Capacity of each tie between blocks."""
    ties: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for j, b in enumerate(blocks):
        if j:
            p, q, apart = blocks[j - 1].parent, b.parent, 0
            while p is not q:
                if p.depth >= q.depth:
                    p = p.parent
                else:
                    q = q.parent
                apart += 1
            ties[j - 1, j] = adjacent / (1 + apart)
        group = id(b.parent.parent if b.parent.parent is not None else b.parent)
        i = last.get(group)
        if i is not None:
            ties[i, j] = ties.get((i, j), 0.0) + sibling
        last[group] = j
    return ties


def min_cut(odds: list[float], ties: dict[tuple[int, int], float]) -> list[bool]:
    """Labels (true: content) of least cost: odds > 0 is the cost of false, -odds of true, a tie that of differing.

    A block whose odds outweigh all its ties keeps their sign in a cheapest labelling;
    such blocks are settled first, the flow runs over the others.
    """
    n = len(odds)
    odds = list(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (i, j), c in ties.items():
        if c > 0:
            near[i][j] = near[i].get(j, 0.0) + c
            near[j][i] = near[j].get(i, 0.0) + c
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(odds[i]) >= sum(near[i].values()):
            label[i] = odds[i] > 0
            for j, c in near[i].items():
                del near[j][i]
                if label[j] is None:
                    odds[j] += c if label[i] else -c
                    queue.append(j)
            near[i].clear()
    open_ = [i for i in range(n) if label[i] is None]
    if open_:
        for i, x in zip(open_, _flow([odds[i] for i in open_], _renumber(open_, near)), strict=True):
            label[i] = x
    return label


def _renumber(open_: list[int], near: list[dict[int, float]]) -> list[dict[int, float]]:
    place = {i: k for k, i in enumerate(open_)}
    return [{place[j]: c for j, c in near[i].items()} for i in open_]


def _flow(odds: list[float], near: list[dict[int, float]]) -> list[bool]:
    """Dinic's maximum flow; true for what the source still reaches."""
    n = len(odds)
    s, t = n, n + 1
    rest: list[dict[int, float]] = [dict(x) for x in near] + [{}, {}]
    for i, x in enumerate(odds):
        if x > 0:
            rest[s][i], rest[i][s] = x, 0.0
        elif x < 0:
            rest[i][t], rest[t][i] = -x, 0.0
    eps = 1e-12
    while True:
        level = {s: 0}
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for v, c in rest[u].items():
                if c > eps and v not in level:
                    level[v] = level[u] + 1
                    queue.append(v)
        if t not in level:
            return [i in level for i in range(n)]
        todo = {u: list(rest[u]) for u in level}
        path = [s]
        while path:
            u = path[-1]
            if u == t:
                push = min(rest[a][b] for a, b in zip(path, path[1:], strict=False))
                cut = None
                for k, (a, b) in enumerate(zip(path, path[1:], strict=False)):
                    rest[a][b] -= push
                    rest[b][a] = rest[b].get(a, 0.0) + push
                    if cut is None and rest[a][b] <= eps:
                        cut = k
                del path[cut + 1:]
                continue
            while todo[u]:
                v = todo[u][-1]
                if rest[u].get(v, 0.0) > eps and level.get(v) == level[u] + 1:
                    path.append(v)
                    break
                todo[u].pop()
            else:
                path.pop()
                if path:
                    todo[path[-1]].pop()


def label_page(page: str | None, weights: np.ndarray) -> tuple[list[Block], list[bool]]:
    blocks = read_blocks(page)
    if not blocks:
        return [], []
    odds = features(blocks) @ weights
    return blocks, min_cut(odds.tolist(), smoothness(blocks))


def main_text(page: str | None, weights: np.ndarray) -> str:
    blocks, label = label_page(page, weights)
    return " ".join(b.text for b, x in zip(blocks, label, strict=True) if x)


# ---------------------------------------------------------------- operator

def sample_pages(pages: DataFrame, html_col: str = "html", max_pages: int = MAX_PAGES) -> list[str]:
    """At most ``max_pages`` distinct pages of at most ``MAX_PAGE_CHARS`` characters, chosen by hash over the whole table.

    A threshold on the hash leaves about twice as many before they are ordered, so tasks send no more than that.
    """
    html = pages.select(F.col(html_col).cast("string").alias("html")).where(F.length("html") <= MAX_PAGE_CHARS)
    n = html.count()
    share = min(1.0, 2 * max_pages / n) if n else 1.0
    few = html.withColumn("h", F.xxhash64("html")).where(F.col("h") <= F.lit(min(2 ** 63 - 1, int(-2 ** 63 + share * 2 ** 64)))).dropDuplicates(["h", "html"])
    return [r.html for r in few.orderBy("h", "html").limit(max_pages).collect()]


def fit(pages: list[str], steps: int = 200) -> np.ndarray:
    """Weights from the blocks of pages whose elements tell what they are.

    Each block counts twice: as it is, and with the element features blank, so that what is learnt of
    text and class words comes from labels that it did not make, and holds for pages without such elements.
    """
    xs, ys = [], []
    for page in pages:
        blocks = read_blocks(page)
        for b, x in zip(blocks, features(blocks) if blocks else (), strict=True):
            bad = b.parent.boiler or b.parent.header or b.parent.hidden
            if bad or b.parent.content:
                xs += [x, np.where(ELEMENT_FEATURES, 0.0, x)]
                ys += [0.0 if bad else 1.0] * 2
    w = PRIOR.copy()
    if not xs:
        return w
    x, y = np.array(xs), np.array(ys)
    balance = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + 0.5 * (x.T @ (balance * (y - p)) - RIDGE * (w - PRIOR) / len(PRIOR))
    return w


def train(pages: DataFrame, html_col: str = "html", max_pages: int = MAX_PAGES, steps: int = 200) -> np.ndarray:
    """:func:`fit` on a bounded sample of the table."""
    return fit(sample_pages(pages, html_col, max_pages), steps)


def extract(pages: DataFrame, weights: np.ndarray, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every page."""
    out = "page_id bigint, url string, text string"
    arrow = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                c = b.slice(lo, 200)
                texts = [main_text(x.as_py(), weights) for x in column(c, "html")]
                yield pa.RecordBatch.from_arrays([column(c, "id"), column(c, "url"), pa.array(texts, pa.string())], schema=arrow)

    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).mapInArrow(run, out)


def block_labels(pages: DataFrame, weights: np.ndarray, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, block, text, content) of every block of every page."""
    out = "page_id bigint, block int, text string, content boolean"
    arrow = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, x in zip(column(b, "id").to_pylist(), column(b, "html"), strict=True):
                blocks, label = label_page(x.as_py(), weights)
                if blocks:
                    yield record_batch([(i, k, y.text, z) for k, (y, z) in enumerate(zip(blocks, label, strict=True))], arrow)

    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, out)
