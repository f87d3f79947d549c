"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks.  A linear classifier gives each block a score from its
ancestors, length and links; the score is the capacity of its edge to the source (content)
or the sink (boilerplate).  Blocks that follow each other and blocks that are near in
the tree (same container) are joined by smoothness edges.  The maximum flow separates the
two sides at the least cost; the blocks on the source side are the text.

The name of an element ("sidebar", "comments") speaks against the blocks below it, unless the element
holds nearly the whole page: then the name is that of a wrapper.  Where nothing on a page would be
content, plain blocks are, however short.

Reading a page takes time in proportion to its length, however deep its elements are nested.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.shared import python_batches
from postloom.llm.words import pieces

# The language of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "title", "textarea", "iframe"}
# Left out until they or what holds them ends; blocks end the first two, too.
BROKEN_BY_BLOCKS = {"svg", "select"}
HIDDEN = {"noscript", "template", "button", "annotation", "annotation-xml", *BROKEN_BY_BLOCKS}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
HOLDERS = {"ul", "ol", "dl", "table"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
PARTS = HOLDERS | set(CLOSES)
# What names of elements, classes and ids say about a block.
BAD_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "header"}
GOOD_TAGS = {"article", "main"}
BAD_NAMES = set(
    "ad ads advert adverts advertisement adsbygoogle banner promo promotion sponsor sponsored cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup login "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer masthead topbar sidebar side rail widget widgets related recommended share sharing social follow "
    "comment comments reply replies respond disqus discussion copyright legal disclaimer search toolbar skip tags taglist".split()
)
# Those that wrappers of whole pages are named after as well.
LAYOUT_NAMES = set("side sidebar rail banner masthead topbar toolbar nav menu overlay modal widget widgets search".split())
GOOD_NAMES = set("article main content post entry story body text prose".split())
NEGATING = {"no", "has", "with", "without", "hide", "hidden"}
# Weights of the classifier and of the smoothness edges, in hundredths.
BIAS, IN_GOOD_TAG, IN_BAD, GOOD_NAME, PER_LENGTH, LINKS, HEADING, MARKED = -120, 220, -500, 90, 80, -300, 60, -250
BARE = 150
FOLLOWS, SAME_PARENT, NEAR, APART = 40, 60, 60, 10
# Of the page's plain text, in hundredths, what an element must hold more than to be a wrapper.
LAYOUT_SHARE, OTHER_SHARE = 50, 90

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")
_BUTTON = re.compile(r"<(/?)button(?=[\s/>])", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in sorted(RAW)}


class _Element:
    """``bad``, ``good``: by a tag; ``named``: by a good name; ``root``: the nearest element with a bad name."""

    __slots__ = ("tag", "number", "bad", "good", "named", "link", "hidden", "root")

    def __init__(self, tag: str, number: int, above: "_Element | None", attributes: str, roots: list[tuple[int, int]]):
        self.tag, self.number = tag, number
        self.good = tag in GOOD_TAGS or (above.good if above else False)
        self.named = above.named if above else False
        self.root = above.root if above else -1
        self.link = tag == "a" or (above.link if above else False)
        self.hidden = tag in HIDDEN or (above.hidden if above else False)
        # A header within an article is its headline's place.
        self.bad = (above.bad if above else False) or (tag in BAD_TAGS and not (tag == "header" and self.good))
        if attributes and tag not in ("html", "body"):
            against = set()
            for found in _NAMES.findall(attributes):
                names = [p.lower() for p in _PART.findall("".join(found))]
                for before, name in zip(["", *names], names):
                    if before not in NEGATING:
                        self.named = self.named or name in GOOD_NAMES
                        if name in BAD_NAMES:
                            against.add(name)
            if against:
                roots.append((self.root, LAYOUT_SHARE if against <= LAYOUT_NAMES else OTHER_SHARE))
                self.root = len(roots) - 1


class _Open:
    """The open elements of a page, with what is asked about them at hand."""

    def __init__(self):
        self.stack: list[_Element] = []
        self.tags: Counter[str] = Counter()
        # Places on the stack of the blocks, and of lists, tables and their parts.
        self.blocks: list[int] = []
        self.parts: list[int] = []

    def push(self, element: _Element) -> None:
        if element.tag in BLOCK:
            self.blocks.append(len(self.stack))
        if element.tag in PARTS:
            self.parts.append(len(self.stack))
        self.stack.append(element)
        self.tags[element.tag] += 1

    def pop(self) -> str:
        tag = self.stack.pop().tag
        self.tags[tag] -= 1
        if tag in BLOCK:
            self.blocks.pop()
        if tag in PARTS:
            self.parts.pop()
        return tag

    def pop_to(self, tag: str) -> None:
        """Close the innermost ``tag``, if any is open, and all within it."""
        if self.tags[tag]:
            while self.pop() != tag:
                pass

    def end_part(self, ends: set[str]) -> None:
        """Close the part of the innermost list or table that a new one ends."""
        for place in reversed(self.parts):
            tag = self.stack[place].tag
            if tag in HOLDERS:
                return
            if tag in ends:
                while len(self.stack) > place:
                    self.pop()
                return

    @property
    def last(self) -> _Element | None:
        return self.stack[-1] if self.stack else None


def blocks(page: str) -> list[tuple[str, int, int, bool]]:
    """(text, score, number of the container, named as boilerplate) of each block that has text, in page order."""
    found: list[tuple[str, str, _Element | None, float, int]] = []
    roots: list[tuple[int, int]] = []
    opened = _Open()
    text: list[str] = []
    linked = 0
    count = 0

    def close_block() -> None:
        nonlocal linked
        if text:
            whole = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if whole:
                held = opened.blocks
                holder = opened.stack[held[-1]] if held else None
                parent = opened.stack[held[-2]].number if len(held) > 1 else 0
                found.append((whole, holder.tag if holder else "", holder, min(1.0, linked / len(whole)), parent))
            text.clear()
        linked = 0

    # A button ends at its end tag; one that another follows first, or nothing, is a stray tag.
    buttons = {a.start() for a, b in pairwise(_BUTTON.finditer(page)) if b[1] and not a[1]}
    # Behind the last ">" there is no tag.
    at, end, tags_end = 0, len(page), page.rfind(">") + 1
    while at < end:
        token = _TOKEN.search(page, at, tags_end) if at < tags_end else None
        stop = token.start() if token else page.find("<!--", at)
        stop = end if stop < 0 else stop
        above = opened.last
        if stop > at and not (above and above.hidden):
            piece = page[at:stop]
            text.append(piece)
            if above and above.link:
                linked += len(piece)
        if not token:
            break
        at = token.end()
        closing, name, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not name:
            if page.startswith("<!--", stop) and not page.endswith("-->", stop + 4, at):
                at = end
            continue
        tag = name.lower()
        if closing:
            if opened.tags[tag]:
                if tag in BLOCK and not above.hidden:
                    close_block()
                opened.pop_to(tag)
        elif tag == "br":
            text.append(" ")
        elif tag in RAW:
            if not attributes.endswith("/"):
                over = _RAW_END[tag].search(page, at)
                at = over.end() if over else end
        elif tag == "head" or (tag == "button" and stop not in buttons) or (tag in HIDDEN and attributes.endswith("/")):
            continue
        else:
            if tag in BLOCK:
                for broken in BROKEN_BY_BLOCKS:
                    opened.pop_to(broken)
                above = opened.last
                if not (above and above.hidden):
                    close_block()
                    # An open paragraph ends where a block begins; list items and cells end the last one.
                    opened.pop_to("p")
                    opened.end_part(CLOSES.get(tag, set()))
            if tag not in VOID:
                count += 1
                opened.push(_Element(tag, count, opened.last, attributes, roots))
    close_block()
    against = condemned(found, roots)
    bad = [bool(e and (e.bad or (e.root >= 0 and against[e.root]))) for _, _, e, _, _ in found]
    scores = [score(whole, tag, e, b, links) for (whole, tag, e, links, _), b in zip(found, bad)]
    if all(s <= 0 for s in scores):
        scores = [s if b else s + BARE for s, b in zip(scores, bad)]
    return [(whole, s, parent, b) for (whole, _, _, _, parent), s, b in zip(found, scores, bad)]


def condemned(found: list[tuple[str, str, _Element | None, float, int]], roots: list[tuple[int, int]]) -> list[bool]:
    """Which of the elements with a bad name, given as (the next such element above, share), speak against what they hold.

    Not those that hold more than their share of the page's plain text and all of its text under a good tag or name.
    """
    plain, good = [0] * len(roots), [0] * len(roots)
    all_plain = all_good = 0
    for whole, _, holder, links, _ in found:
        if links <= 0.5 and not (holder and holder.bad):
            size = len(whole)
            is_good = size if holder and (holder.good or holder.named) else 0
            all_plain, all_good = all_plain + size, all_good + is_good
            if holder and holder.root >= 0:
                plain[holder.root] += size
                good[holder.root] += is_good
    for i in range(len(roots) - 1, -1, -1):
        above = roots[i][0]
        if above >= 0:
            plain[above] += plain[i]
            good[above] += good[i]
    out: list[bool] = []
    for i, (above, share) in enumerate(roots):
        wraps = 100 * plain[i] > share * all_plain and good[i] == all_good
        out.append(not wraps or (above >= 0 and out[above]))
    return out


def score(text: str, tag: str, holder: _Element | None, bad: bool, links: float) -> int:
    """Above zero for content."""
    words = text.count(" ") + 1
    total = BIAS + PER_LENGTH * min(5, (1 + words // 4).bit_length() - 1) + LINKS * links
    if holder:
        total += IN_GOOD_TAG * holder.good + IN_BAD * bad + GOOD_NAME * holder.named
    if tag[:1] == "h" and tag[1:].isdigit():
        total += HEADING
    if text[0] in "©®" or text[:9].lower() == "copyright":
        total += MARKED
    return int(total)


def minimum_cut(scores: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stand on the source side of a minimum cut: positive scores pull to the source.

    Dinic's maximum flow over both terminals and the (undirected) edges.
    """
    n = len(scores)
    if all(s > 0 for s in scores) or all(s <= 0 for s in scores):
        return [s > 0 for s in scores]
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    arcs: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: int, back: int) -> None:
        arcs[a].append(len(to))
        to.append(b)
        room.append(there)
        arcs[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, s in enumerate(scores):
        if s > 0:
            join(source, i, s, 0)
        elif s < 0:
            join(i, sink, -s, 0)
    for a, b, c in edges:
        join(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in arcs[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                push = min(room[e] for e in path)
                for e in path:
                    room[e] -= push
                    room[e ^ 1] += push
                full = next(i for i, e in enumerate(path) if not room[e])
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while tried[a] < len(arcs[a]):
                e = arcs[a][tried[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                    break
                tried[a] += 1
            else:
                if a == source:
                    break
                e = path.pop()
                a = to[e ^ 1]
                tried[a] += 1


def main_text(page: str | None) -> str:
    """The content blocks, one a line.  Null, empty and textless pages give an empty text."""
    found = blocks(page or "")
    if not found:
        return ""
    edges, last = [], {}
    for i, (_, _, parent, bad) in enumerate(found):
        if i:
            _, _, other, was_bad = found[i - 1]
            edges.append((i - 1, i, APART if bad != was_bad else FOLLOWS + SAME_PARENT * (other == parent)))
        # The last one of the same kind in the same container, over what stands between.
        if last.get((parent, bad), i - 1) < i - 1:
            edges.append((last[parent, bad], i, NEAR))
        last[parent, bad] = i
    keep = minimum_cut([s for _, s, _, _ in found], edges)
    return "\n".join(block[0] for block, k in zip(found, keep) if k)


def extracted(pages: DataFrame) -> DataFrame:
    """Main text of every page.

    Needs page_id, url and html; other columns are ignored.  Null ids and urls and repeated
    rows are kept as they are; null html is empty; of an empty table nothing comes out.
    Columns: page_id, url, text, n_chars.
    """

    @F.arrow_udf("string")
    def text_of(column: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([column], names=["text"])
        return pa.array([main_text(page) for some in pieces(batch) for page in some.column("text").to_pylist()], pa.string())

    python_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", text_of(F.col("html")).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("bigint"))
