"""Elements of a page by simple CSS selectors.

The one place that needs a tree walk and so runs in Python, a page at a time.  It
only locates elements; which of them becomes which field is decided in Column
expressions over the nodes it returns.
"""

from __future__ import annotations

import re
import sys
from html.entities import html5
from html.parser import HTMLParser

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postloom.functions.text import contains_any, let

# Ordered so that the smallest node of a field is the one to take: the first selector
# that matches anything, then the first place in the document.
NODE = T.StructType(
    [
        T.StructField("field", T.StringType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("at", T.IntegerType()),
        T.StructField("upto", T.IntegerType()),
        T.StructField("text", T.StringType()),
        T.StructField("href", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("datetime", T.StringType()),
    ]
)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_CLOSED_BY_ITSELF = {"p", "li", "option", "tr", "td", "th", "dt", "dd"}
_PART = re.compile(r"([\w-]+)|\.([\w-]+)|#([\w-]+)|\[([\w-]+)(?:([*^]?=)['\"]?([^'\"\]]*)['\"]?)?\]|(:last-child)")


def _steps(selector: str) -> list[tuple[bool, list[tuple]]]:
    """(is a direct child of the step before, its tests) per compound, left to right."""
    words = re.findall(r"\[[^\]]*\]|>|[^\s>\[]+(?:\[[^\]]*\])*(?:[^\s>\[]+)*", selector)
    steps, direct = [], False
    for word in words:
        if word == ">":
            direct = True
            continue
        steps.append((direct, _PART.findall(word)))
        direct = False
    return steps


def _fits(element: dict, tests: list[tuple]) -> bool:
    attrs = element["attrs"]
    for tag, cls, ident, name, op, value, _last in tests:
        have = attrs.get(name) if name else None
        if (
            (tag and element["tag"] != tag)
            or (cls and cls not in (attrs.get("class") or "").split())
            or (ident and attrs.get("id") != ident)
            or (name and have is None)
            or (op == "=" and have != value)
            or (op == "*=" and value not in have)
            or (op == "^=" and not have.startswith(value))
        ):
            return False
    return True


def _matches(path: list[dict], steps: list[tuple[bool, list[tuple]]]) -> bool:
    """Does the innermost element of ``path`` match, with its ancestors, all steps?"""
    if not _fits(path[-1], steps[-1][1]):
        return False
    if len(steps) == 1:
        return True
    above = path[:-1]
    if steps[-1][0]:
        return bool(above) and _matches(above, steps[:-1])
    return any(_matches(above[:end], steps[:-1]) for end in range(len(above), 0, -1))


class _Walk(HTMLParser):
    """One pass over a page; ``rules`` are (field, rank, steps)."""

    def __init__(self, rules: list[tuple]):
        super().__init__(convert_charrefs=True)
        self.rules = rules
        self.open: list[dict] = [{"tag": "", "attrs": {}, "last": 0}]
        self.texts: list[str] = []
        self.hits: list[tuple[tuple, dict]] = []
        self.count = 0

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSED_BY_ITSELF and self.open[-1]["tag"] == tag:
            self._close(len(self.open) - 1)
        self.count += 1
        element = {"tag": tag, "attrs": dict(attrs), "at": self.count, "upto": None, "from": len(self.texts), "last": 0}
        # A parent knows its last child by place: with a reference both ways a page would outlive its walk.
        element["parent"] = self.open[-1]
        self.open[-1]["last"] = self.count
        path = self.open[1:] + [element]
        self.hits += [(rule, element) for rule in self.rules if _matches(path, rule[2])]
        if tag in _VOID:
            element["upto"], element["to"] = self.count, len(self.texts)
        else:
            self.open.append(element)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth]["tag"] == tag:
                self._close(depth)
                return

    def handle_data(self, data):
        self.texts.append(data)

    def _close(self, depth: int) -> None:
        for element in self.open[depth:]:
            element["upto"], element["to"] = self.count, len(self.texts)
        del self.open[depth:]

    def nodes(self) -> list[dict]:
        self._close(1)
        out = []
        for (field, rank, steps), e in self.hits:
            if any(test[6] for test in steps[-1][1]) and e["parent"]["last"] != e["at"]:
                continue
            attrs = {a: e["attrs"].get(a) for a in ("href", "content", "datetime")}
            text = " ".join(self.texts[e["from"] : e["to"]])
            out.append({"field": field, "rank": rank, "at": e["at"], "upto": e["upto"], "text": text, **attrs})
        return out


def rules_of(fields: dict[str, list[str]]) -> list[tuple]:
    return [(f, i, _steps(s)) for f, found in fields.items() for i, s in enumerate(found)]


def find_nodes(html: str | None, rules: list[tuple]) -> list[dict]:
    walk = _Walk(rules)
    walk.feed(html or "")
    walk.close()
    return walk.nodes()


def needed_literals(selectors: list[str]) -> list[str] | None:
    """One string per selector that a page must hold to match it; None if some selector needs none.

    The longest class, id or attribute value that the selector asks for; these stand in the page as they
    are, while tags and attribute names may be written in either case.
    """
    needed = []
    for selector in selectors:
        tests = [test for _, tests in _steps(selector) for test in tests]
        literals = [part for _, cls, ident, _, _, value, _ in tests for part in (cls, ident, value) if part and "&" not in part]
        if not literals:
            return None
        needed.append(max(literals, key=len))
    return list(dict.fromkeys(needed))


def may_match(html: Column, selectors: list[str]) -> Column:
    """False only for pages none of the selectors can match.

    A page with a character reference that could stand for a character of the literals is let through.
    """
    needed = needed_literals(selectors)
    if needed is None:
        return F.lit(True)
    letters = set("".join(needed))
    written = sorted({n.rstrip(";") for n, v in html5.items() if letters & set(v)}, key=lambda n: (-len(n), n))
    return contains_any(html, needed) | F.contains(html, F.lit("&#")) | (F.contains(html, F.lit("&")) & html.rlike("&(" + "|".join(written) + ")"))


def select_nodes(html: Column, kind: Column, selectors: dict[str, dict[str, list[str]]], roots: list[str] | None = None) -> Column:
    """``array<NODE>``; ``kind`` picks the table of selectors per field.

    Pages without any string a selector of their kind needs are not handed to Python.  ``roots`` are the fields
    without which the others mean nothing: then theirs decide, and a page without any of them has no nodes.
    """
    needed = F.lit(False)
    for name, fields in selectors.items():
        asked = [s for field, found in fields.items() if roots is None or field in roots for s in found]
        needed = needed | ((kind == name) & may_match(html, asked))
    # Workers get the functions above with the query, whatever is installed there.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    rules: dict[str, list[tuple]] = {}

    # Page by page: an Arrow batch would hold ten thousand pages of any size, and all their nodes.
    @F.udf(T.ArrayType(NODE), useArrow=False)
    def select(page: str | None, of: str | None) -> list[dict]:
        if not rules:
            rules.update({k: rules_of(fields) for k, fields in selectors.items()})
        return find_nodes(page, rules.get(of, []))

    return select(F.when(needed, html), kind)


def of_field(nodes: Column, field: str) -> Column:
    return F.filter(nodes, lambda n: n["field"] == field)


def first_of(nodes: Column, field: str) -> Column:
    """First node of the field's first selector that has any; null without one."""
    return F.array_min(of_field(nodes, field))


def all_of(nodes: Column, field: str) -> Column:
    """All nodes of the field's first selector that has any."""
    return let(
        of_field(nodes, field),
        lambda found: F.filter(found, lambda n: n["rank"] == F.array_min(F.transform(found, lambda m: m["rank"]))),
    )
