"""Boards as data: which part of a page gives which field, in order of preference.

A rule names a board, a field, a kind of test, the part of the page to look at and, where the kind needs
one, a value.  Rules of the board "" serve the boards without any of their own for that field.  ``first_value``
turns the rules of a field into one expression, so a new board is a few more rows: see ``Boards.with_board``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.fixed_values import CARD_SELECTORS, DEFAULT_LOCATION, DETAIL_SELECTORS, FULL_TEXT_MIN


class Rule(NamedTuple):
    board: str
    field: str
    kind: str
    part: str = ""
    value: str = ""


def _filled(part: Column) -> Column:
    return F.nullif(part, F.lit(""))


# What a rule gives, from its part and its value; null passes on to the next rule.
KINDS: dict[str, Callable[[Column, str], Column]] = {
    "given": lambda part, value: part,
    "filled": lambda part, value: _filled(part),
    "known": lambda part, value: F.when(~F.lower(part).isin("", "unknown"), part),
    "long": lambda part, value: F.when(F.length(part) >= FULL_TEXT_MIN, part),
    "holding": lambda part, value: F.when(F.contains(part, F.lit(value)), part),
    "constant": lambda part, value: F.lit(value),
}


# --- fixed values: the boards' fields -------------------------------------------------

# Parts: elements by the names of their selectors, JSON-LD fields behind "json.", the text chosen among the page's texts.
DETAIL_RULES = [
    Rule("indeed", "title", "filled", "json.title"),
    Rule("indeed", "title", "filled", "title"),
    Rule("indeed", "title", "filled", "meta_title"),
    Rule("", "title", "given", "title"),
    Rule("indeed", "company", "known", "company"),
    Rule("indeed", "company", "filled", "json.company"),
    Rule("indeed", "company", "constant", value="Unknown"),
    Rule("", "company", "given", "company"),
    Rule("", "company", "constant", value="Unknown"),
    Rule("indeed", "location", "filled", "location"),
    Rule("indeed", "location", "filled", "json.location"),
    Rule("indeed", "location", "constant", value=DEFAULT_LOCATION),
    Rule("", "location", "given", "location"),
    Rule("", "location", "constant", value=DEFAULT_LOCATION),
    Rule("indeed", "description", "long", "chosen"),
    Rule("indeed", "description", "long", "other_text"),
    Rule("indeed", "description", "filled", "json.description"),
    Rule("indeed", "description", "given", "other_text"),
    Rule("indeed", "description", "given", "chosen"),
    Rule("linkedin", "description", "given", "clean chosen"),
    Rule("", "description", "given", "main_text"),
    Rule("indeed", "salary", "holding", "salary", "PKR"),
    Rule("indeed", "salary", "holding", "salary", "Rs"),
    Rule("", "salary", "given", "salary"),
    Rule("mustakbil", "posted_date", "given", "posted"),
    Rule("", "employment_type", "given", "type"),
    Rule("", "experience_required", "given", "experience"),
]

# Parts: elements within the card; "own": the card itself; "name 0", "name 1": its list of names.
CARD_RULES = [
    Rule("mustakbil", "href", "given", "own href"),
    Rule("", "href", "given", "href"),
    # A nameless link is called by the end of its url.
    Rule("mustakbil", "title", "filled", "title"),
    Rule("mustakbil", "title", "filled", "own"),
    Rule("mustakbil", "title", "given", "end of own href"),
    Rule("", "title", "filled", "title"),
    Rule("", "title", "given", "link"),
    Rule("rozee", "company", "filled", "name 0"),
    Rule("", "company", "given", "company"),
    Rule("rozee", "company", "constant", value="Unknown"),
    Rule("", "company", "constant", value="Unknown"),
    Rule("rozee", "location", "filled", "name 1"),
    Rule("", "location", "given", "location"),
    Rule("rozee", "location", "constant", value=DEFAULT_LOCATION),
    Rule("", "location", "constant", value=DEFAULT_LOCATION),
    Rule("", "description", "given", "text"),
    Rule("", "description", "constant", value=""),
    Rule("linkedin", "posted_date", "filled", "datetime"),
    Rule("linkedin", "posted_date", "given", "posted"),
    Rule("", "posted_date", "given", "posted"),
    Rule("", "employment_type", "given", "type"),
    Rule("", "experience_required", "given", "experience"),
]


class UrlRule(NamedTuple):
    """The first rule of a board whose test holds gives the url; without one it is ''.

    Tests: ``parameter`` (the url has that one: ``base`` and its value are the new url), ``holds``, ``starts``,
    ``empty``, ``any``.  Else ``base`` goes in front of a url that does not start with "http"; with ``short``
    the query goes.  ``refused``: ''.
    """

    board: str
    test: str
    value: str = ""
    base: str = ""
    short: bool = False
    refused: bool = False


URL_RULES = [
    UrlRule("indeed", "parameter", "jk", "https://pk.indeed.com/viewjob?jk="),
    UrlRule("indeed", "holds", "/viewjob", "https://pk.indeed.com"),
    UrlRule("linkedin", "holds", "/jobs/view/", "https://www.linkedin.com", short=True),
    UrlRule("rozee", "empty", refused=True),
    UrlRule("rozee", "starts", "javascript", refused=True),
    UrlRule("rozee", "starts", "//", "https:"),
    UrlRule("rozee", "any", base="https://www.rozee.pk"),
    UrlRule("mustakbil", "empty", refused=True),
    UrlRule("mustakbil", "any", base="https://www.mustakbil.com"),
]

# How the text of a detail page is chosen: by the order of its places, or by length.
CHOSEN_TEXT = {"indeed": "priority", "linkedin": "length"}

# Boards with a peculiarity each.
TRAITS = {
    "icons before names": {"mustakbil"},
    "places of a listing are postings": {"rozee"},
    "types in full words": {"indeed", "linkedin"},
    "interns are internships": {"indeed"},
    # Elsewhere the card comes first.
    "cards fill gaps": {"indeed"},
    "chosen text before JSON": {"linkedin"},
}

# --- the boards together -----------------------------------------------------------------


@dataclass(frozen=True)
class Boards:
    """All that is known of the boards."""

    detail_selectors: dict[str, dict[str, list[str]]] = field(default_factory=lambda: DETAIL_SELECTORS)
    card_selectors: dict[str, dict[str, list[str]]] = field(default_factory=lambda: CARD_SELECTORS)
    detail: tuple[Rule, ...] = tuple(DETAIL_RULES)
    cards: tuple[Rule, ...] = tuple(CARD_RULES)
    urls: tuple[UrlRule, ...] = tuple(URL_RULES)
    chosen: dict[str, str] = field(default_factory=lambda: CHOSEN_TEXT)
    traits: dict[str, set[str]] = field(default_factory=lambda: TRAITS)

    def with_board(
        self,
        name: str,
        *,
        detail_selectors: dict[str, list[str]],
        card_selectors: dict[str, list[str]] | None = None,
        detail: list[Rule] | None = None,
        cards: list[Rule] | None = None,
        urls: list[UrlRule] | None = None,
        chosen: str | None = None,
        traits: set[str] = frozenset(),
    ) -> Boards:
        """These boards and one more; rules it lacks are the common ones."""
        rules = [*(detail or []), *(cards or []), *(urls or [])]
        if wrong := {r.board for r in rules} - {name}:
            raise ValueError(f"rules of {sorted(wrong)} for the board {name}")
        if unknown := ({r.kind for r in [*(detail or []), *(cards or [])]} - set(KINDS)) | (set(traits) - set(self.traits)):
            raise ValueError(f"no such kinds or traits: {sorted(unknown)}")
        return replace(
            self,
            detail_selectors={**self.detail_selectors, name: detail_selectors},
            card_selectors={**self.card_selectors, **({name: card_selectors} if card_selectors else {})},
            detail=(*self.detail, *(detail or [])),
            cards=(*self.cards, *(cards or [])),
            urls=(*self.urls, *(urls or [])),
            chosen={**self.chosen, **({name: chosen} if chosen else {})},
            traits={t: boards | {name} if t in traits else boards for t, boards in self.traits.items()},
        )

    def has(self, board: Column, trait: str) -> Column:
        return F.coalesce(board.isin(*sorted(self.traits[trait])), F.lit(False))


BOARDS = Boards()


def by_board(board: Column, values: dict[str, Column]) -> Column:
    """The value of the row's board; that of "" (or null) for other boards."""
    other = values.get("", F.lit(None))
    named = [(name, value) for name, value in values.items() if name]
    return reduce(lambda rest, one: F.when(board == one[0], one[1]).otherwise(rest), reversed(named), other)


def first_value(rules: tuple[Rule, ...], name: str, board: Column, part: Callable[[str], Column]) -> Column:
    """A field by its rules: the first that gives something; null where none does or the board has none."""
    tried: dict[str, list[Column]] = {}
    for rule in rules:
        if rule.field == name:
            tried.setdefault(rule.board, []).append(KINDS[rule.kind](part(rule.part) if rule.part else F.lit(None), rule.value))
    return by_board(board, {b: F.coalesce(*columns) for b, columns in tried.items()})


def url_of(rules: tuple[UrlRule, ...], board: Column, href: Column) -> Column:
    """The posting url that a link stands for; links of boards without rules stay as they are."""
    found: dict[str, Column] = {"": href}
    for name in dict.fromkeys(rule.board for rule in rules):
        mine = [_url(rule, href) for rule in rules if rule.board == name]
        found[name] = reduce(lambda rest, one: F.when(one[0], one[1]).otherwise(rest), reversed(mine), F.lit(""))
    return by_board(board, found)


def _url(rule: UrlRule, href: Column) -> tuple[Column, Column]:
    """(test, result) of a rule."""
    if rule.test == "parameter":
        value = F.regexp_extract(href, rf"^.*?{rule.value}=([^&]*?)(?:&|{rule.value}=|$)", 1)
        return value != "", F.concat(F.lit(rule.base), value)
    tests = {"holds": F.contains(href, F.lit(rule.value)), "starts": href.startswith(rule.value), "empty": href == "", "any": F.lit(True)}
    link = F.regexp_extract(href, r"^([^?]*)", 1) if rule.short else href
    whole = F.when(link.startswith("http"), link).otherwise(F.concat(F.lit(rule.base), link))
    return tests[rule.test], F.lit("") if rule.refused else whole
