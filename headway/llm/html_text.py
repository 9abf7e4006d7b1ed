"""HTML extraction by composite text density.

A page becomes a tree. Elements that are never content (menus, forms, scripts and the like, by tag, or hidden ones) are
taken out. A name of boilerplate (class, id or role) takes an element out as well, unless that would take the text with
it: on a page without an article element outside of such names, a named element stays if it holds the subtree of the
largest density sum and at least half of the characters; one that is named after comments, adverts or related pages also
has to hold a main or h1 element. Headings and article elements go by the latter names only. Every node left has its characters, tags, linked characters and linked tags; its density is characters per
tag, adjusted for links and for the share of links in the whole body. The densities of a node's children are summed; the
lowest density on the path from the node of the largest sum to the body is the threshold, and under each node that
reaches it the subtree of the largest sum is the main text, rounded to the article elements it lies in or holds. Without
such elements the headings, paragraphs, lists and tables beside it join it if they reach the part of the threshold that
their length asks for.

Defined results: null, empty and tagless input give the text itself without markup (empty if there is none). Unclosed
and misnested elements are closed where HTML closes them; a tag cut off at the end of the page is dropped. Equal rows
stay, one text each. Pages of any length are read whole, without recursion. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import small_batches

# The usual tags in one step: few and short quoted values. A tag of the other form may have a > in a value; Page._tag_end looks for its end.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>"']*+(?:(?:"[^"]{0,512}"|'[^']{0,512}')[^>"']*+){0,16}+)>|"""
                   r"""<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/a-zA-Z][^>]*\Z""", re.S)
END_OR_QUOTE = re.compile(r"""[>"']""")
ATTRIBUTE = re.compile(r"""([^\s"'=/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)

# Elements by their part in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
RAW_ENDS = {name: re.compile(f"</{name}", re.I | re.A) for name in RAW}
DROPPED = frozenset("nav header footer aside form script style noscript iframe template button select textarea input label option menu dialog svg "
                    "canvas object embed audio video head title".split())
BLOCKS = frozenset("address article aside blockquote body br center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p ul ol dl dt dd blockquote pre table figure".split())
CLOSES_P = BLOCKS - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}
HIDES_P = frozenset("table td th button".split())
# An element of the first kind ends open elements of the second, up to the third.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
# Names of elements that hold no content, as whole words of class, id or role.
BOILERPLATE = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar sidenav rail widget "
                        "menu nav navbar navigation breadcrumb breadcrumbs pagination header masthead footer cookie cookies consent gdpr notice notices "
                        "alert popup modal overlay newsletter subscribe subscription signup login form search share sharing social related recommended "
                        "comment comments disqus respond replies reply contentinfo complementary toolbar skip".split())
# The same for article elements and headings, whose names often speak of the header or form they have or are.
ASIDE = frozenset("ad ads advert adverts advertisement sponsored promo related recommended comment comments reply replies".split())
OWN_NAMES = frozenset("article main h1 h2 h3 h4 h5 h6".split())
# What a name says of an element: nothing, part of a layout, or beside the article.
PLAIN, LAYOUT, BESIDE = range(3)


def judge(tag: str, attributes: str) -> tuple[bool, int]:
    """Whether the element is hidden, and what its names say."""
    hidden, said = False, PLAIN
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role"):
            words = re.split(r"[^a-z]+", value.lower())
            if not ASIDE.isdisjoint(words):
                said = BESIDE
            elif tag not in OWN_NAMES and not BOILERPLATE.isdisjoint(words):
                said = max(said, LAYOUT)
        elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and NOT_SHOWN.search(value):
            hidden = True
    return hidden, said


class Page:
    """The tree of a page: parent, tag and text pieces of each node, in page order; ``said`` is what names say of it."""

    def __init__(self, source: str):
        self.parent, self.tag, self.dropped, self.said = [-1], ["#page"], [False], [PLAIN]
        self.pieces: list[tuple[int, str | None]] = []  # (node, text) or (node, None) for the border of a block
        stack = [0]
        # For each open element the place in the stack of the p that a block in it ends, or 0.
        self.open_p = [0]
        # The places in the stack of the open elements of each tag.
        self.places: dict[str, list[int]] = {}
        self.endless: set[int] = set()
        at, size = 0, len(source)
        while at < size:
            m = TOKEN.search(source, at)
            self._text(stack[-1], source[at:m.start() if m else size])
            if not m:
                break
            at = m.end()
            attributes = m[3] if m[2] else m[6]
            if m[5]:
                end = self._tag_end(source, m.end(5))
                if end >= 0:
                    attributes, at = source[m.end(5):end], end + 1
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            if m[1] or m[4]:
                self._close(stack, name)
                continue
            self._open(stack, name, attributes or "")
            if name in RAW:
                found = RAW_ENDS[name].search(source, at)
                end = found.start() if found else size
                if name == "textarea":
                    self._text(stack[-1], source[at:end])
                at = end
                if end == size:
                    break

    def _tag_end(self, source: str, at: int) -> int:
        """Place of the > that ends a tag, outside quoted values of any length; -1 if a value or the tag has no end.

        Quotes that led to no end are remembered, so all searches of a page together are linear in its length.
        """
        passed = []
        while (m := END_OR_QUOTE.search(source, at)) and m.start() not in self.endless:
            if m[0] == ">":
                return m.start()
            passed.append(m.start())
            at = source.find(m[0], m.end()) + 1
            if not at:
                break
        self.endless.update(passed)
        return -1

    def _text(self, node: int, text: str) -> None:
        if text and not self.dropped[node]:
            self.pieces.append((node, html.unescape(text) if "&" in text else text))

    def _border(self, node: int, name: str) -> None:
        if name in BLOCKS:
            self.pieces.append((node, None))

    def _open(self, stack: list[int], name: str, attributes: str) -> None:
        if name in CLOSES_P and self.open_p[-1]:
            self._cut(stack, self.open_p[-1])
        if name in SIBLINGS:
            self._pop(stack, *SIBLINGS[name])
        parent, drop, said = stack[-1], name in DROPPED, PLAIN
        if attributes and not drop and name not in ("html", "body"):
            drop, said = judge(name, attributes)
        node = len(self.tag)
        self.parent.append(parent)
        self.tag.append(name)
        self.dropped.append(drop or self.dropped[parent])
        self.said.append(said)
        self._border(parent, name)
        if name not in VOID and not attributes.endswith("/"):
            self.open_p.append(len(stack) if name == "p" else 0 if name in HIDES_P else self.open_p[-1])
            self.places.setdefault(name, []).append(len(stack))
            stack.append(node)

    def _cut(self, stack: list[int], k: int) -> None:
        """Ends the open element at place k, and all in it."""
        self._border(self.parent[stack[k]], self.tag[stack[k]])
        for node in reversed(stack[k:]):
            self.places[self.tag[node]].pop()
        del stack[k:], self.open_p[k:]

    def _last(self, names: set[str]) -> int:
        """Place of the innermost open element of these tags, or 0."""
        return max((self.places[name][-1] for name in names if self.places.get(name)), default=0)

    def _pop(self, stack: list[int], names: set[str], until: set[str]) -> None:
        k = self._last(names)
        if k > self._last(until):
            self._cut(stack, k)

    def _close(self, stack: list[int], name: str) -> None:
        k = self._last({name})
        if k:
            self._cut(stack, k)

    def inside(self, tops: set[int]) -> list[bool]:
        flags = [False] * len(self.tag)
        for i in range(len(flags)):
            flags[i] = i in tops or (i > 0 and flags[self.parent[i]])
        return flags


def densities(page: Page) -> tuple[list[float], list[float], list[int]]:
    """Composite text density, sum over children, and characters of each node; dropped nodes have none."""
    n = len(page.tag)
    chars, tags, link_chars, link_tags, linked = [0] * n, [0] * n, [0] * n, [0] * n, [False] * n
    for i in range(1, n):
        linked[i] = page.tag[i] == "a" or linked[page.parent[i]]
    for node, text in page.pieces:
        if text is not None and not page.dropped[node]:
            size = len("".join(text.split()))
            chars[node] += size
            if linked[node]:
                link_chars[node] += size
    for i in range(n - 1, 0, -1):
        if not page.dropped[i]:
            p = page.parent[i]
            chars[p] += chars[i]
            link_chars[p] += link_chars[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i] + (page.tag[i] == "a")
    body_ratio = link_chars[0] / max(chars[0], 1)
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if page.dropped[i] or not chars[i]:
            continue
        c, t, lc, lt = chars[i], max(tags[i], 1), max(link_chars[i], 1), max(link_tags[i], 1)
        base = math.log(c / max(c - link_chars[i], 1) * link_chars[i] + body_ratio * c + math.e)
        value = c / lc * t / lt
        density[i] = c / t * (math.log(value) / math.log(base) if base > 1 + 1e-9 else max(math.log(value), 0.0) + 1.0)
        density[i] = max(density[i], 0.0)
    for i in range(1, n):
        sums[page.parent[i]] += density[i]
    return density, sums, chars


def settled(page: Page) -> tuple[list[float], list[float], list[int]]:
    """Drops what is named as boilerplate, but not what holds the text of the page; the densities of what is left."""
    shown, n = page.dropped, len(page.tag)

    def left(freed: set[int], least: int) -> tuple[list[float], list[float], list[int]]:
        flags = list(shown)
        for i in range(1, n):
            flags[i] = flags[i] or flags[page.parent[i]] or (page.said[i] >= least and i not in freed)
        page.dropped = flags
        return densities(page)

    made = left(set(), LAYOUT)
    if not any(page.said) or any(page.tag[i] in ("article", "main") and made[2][i] for i in range(n)):
        return made
    chars = left(set(), BESIDE + 1)[2]
    holds = [page.tag[i] in ("main", "h1") and chars[i] > 0 for i in range(n)]
    for i in range(n - 1, 0, -1):
        holds[page.parent[i]] = holds[page.parent[i]] or holds[i]
    freed = {i for i in range(n) if page.said[i] == BESIDE and chars[i] and holds[i] and 2 * chars[i] >= chars[0]}
    _, sums, chars = left(freed, BESIDE)
    i = max(range(n), key=lambda i: (sums[i], chars[i], -i))
    while i > 0:
        if page.said[i] == LAYOUT and chars[i] and 2 * chars[i] >= chars[0]:
            freed.add(i)
        i = page.parent[i]
    return left(freed, LAYOUT)


def main_nodes(page: Page) -> set[int]:
    density, sums, chars = settled(page)
    n = len(page.tag)
    live = [i for i in range(n) if not page.dropped[i] and chars[i]]
    if not live:
        return set()
    body = next((i for i in live if page.tag[i] == "body"), 0)
    top = max(live, key=lambda i: (sums[i], chars[i], -i))
    threshold, i = density[top], top
    while i > 0 and i != body:
        i = page.parent[i]
        threshold = min(threshold, density[i])
    # The best subtree under every node: largest sum, then more text, then nearer the root.
    best = list(range(n))
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        if not page.dropped[i] and chars[i] and (sums[best[i]], chars[best[i]]) > (sums[best[p]], chars[best[p]]):
            best[p] = best[i]
    chosen, done = set(), [False] * n
    for i in range(n):
        if i and done[page.parent[i]]:
            done[i] = True
        elif not page.dropped[i] and chars[i] and density[i] >= threshold:
            chosen.add(best[i])
            done[i] = True
    chosen = chosen or {top}
    articles = [i for i in live if page.tag[i] in ("article", "main")]
    if not articles:
        # The whole block of an inline subtree, and the headings, paragraphs and the like beside it that reach the threshold.
        whole = set()
        for i in chosen:
            while i > 0 and page.tag[i] not in BLOCKS:
                i = page.parent[i]
            whole.add(i)
        around = {page.parent[i] for i in whole if i > 0}
        # Density grows with the length of a text, so a shorter one needs its share of the threshold only.
        most = max(chars[i] for i in whole)
        return whole | {i for i in live if page.parent[i] in around and page.tag[i] in PROSE and density[i] * most >= threshold * min(chars[i], most)}
    inner, holds = page.inside(chosen), [i in chosen for i in range(n)]
    for i in range(n - 1, 0, -1):
        holds[page.parent[i]] = holds[page.parent[i]] or holds[i]
    rounded = {i for i in articles if inner[i] or holds[i]}
    within = page.inside(rounded)
    outermost = sum(chars[i] for i in rounded if not within[page.parent[i]])
    return rounded if rounded and 2 * outermost >= chars[top] else chosen


def main_text(source: str | None) -> str:
    """The main text: blocks in page order, one per line."""
    if not source:
        return ""
    page = Page(source)
    keep = page.inside(main_nodes(page))
    blocks, current = [], []
    for node, text in [*page.pieces, (0, None)]:
        if text is None:
            block = " ".join("".join(current).split())
            if block:
                blocks.append(block)
            current = []
        elif keep[node] and not page.dropped[node]:
            current.append(text)
    return "\n".join(blocks)


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the main text in place of the html; a column of that name is replaced, all others stay."""
    kept = [f for f in pages.schema if f.name not in (html_col, out_col)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = pa.array([main_text(x) for x in part.column(html_col).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in kept), texts], names=[*(f.name for f in kept), out_col])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{out_col}` string"])
    return small_batches(pages).select(*(f.name for f in kept), html_col).mapInArrow(work, schema)
