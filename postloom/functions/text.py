"""Text clean-up as Column expressions."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.fixed_values import (
    CRITERIA_TAIL,
    ICON_WORDS,
    SECTION_HEADERS,
    SHOW_MORE_LESS,
    TAG,
    TRAILING_TOGGLE,
    TRUNCATED_TAIL,
    WORD,
    WS,
    WS_CHARS,
)

EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"  # Unicode word boundary


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def contains_any(text: Column, needles: list[str]) -> Column:
    found = F.lit(False)
    for needle in needles:
        found = found | F.contains(text, F.lit(needle))
    return found


def holds_any(text: Column, needles: list[str]) -> Column:
    """``contains_any`` for an expression: one regular expression, so it stands there once."""
    return text.rlike("|".join(rf"\Q{n}\E" for n in needles))


def strip(text: Column) -> Column:
    """Trim every Unicode space, not only U+0020."""
    return F.btrim(text, F.lit(WS_CHARS))


def null_if_empty(text: Column) -> Column:
    return F.when(text != "", text)


# A run of white space that is not already one plain space: single spaces, nearly
# all of a text, are left where they are instead of being copied one by one.
_MESSY_SPACE = rf"\x20{WS}+|[\t-\r\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}&&[^\x20]]{WS}*"


def clean_text(text: Column) -> Column:
    """Runs of white space become one space; null becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(text, _MESSY_SPACE, " ")), F.lit(""))


def title_case(text: Column) -> Column:
    """First letter of every run of letters upper, the rest lower ("New York-City")."""
    pieces = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(pieces, F.initcap), "")


# --- HTML ------------------------------------------------------------------

_COMMON = {
    "amp;": "&", "lt;": "<", "gt;": ">", "quot;": '"', "nbsp;": "\xa0",
    "copy;": "©", "middot;": "·", "apos;": "'",
}
# Names that HTML accepts without their semicolon, longest first.
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
_CONTROL = "".join(map(chr, range(0x80, 0xA0)))
_CONTROL_MEANS = "".join(
    bytes([c]).decode("cp1252", errors="ignore") or chr(c) for c in range(0x80, 0xA0)
)


def _code_point(number: Column) -> Column:
    """Text of a numeric reference; unusable numbers become U+FFFD or nothing."""
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    dropped = (
        number.between(0x1, 0x8)
        | number.between(0xE, 0x1F)
        | (number == 0xB)
        | (number == 0x7F)
        | number.between(0xFDD0, 0xFDEF)
        | ((number.bitwiseAND(F.lit(0xFFFE))) == 0xFFFE)
    )
    unusable = (
        number.isNull() | (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    )
    return (
        F.when(unusable, "�")
        .when(number.between(0x80, 0x9F), F.translate(char, _CONTROL, _CONTROL_MEANS))
        .when(dropped, "")
        .otherwise(char)
    )


def _decode_reference(body: Column) -> Column:
    """``body`` is what follows an '&'; it is decoded if it starts with a reference."""
    names = F.from_json(F.lit(json.dumps(html5)), "map<string,string>")
    common = F.create_map(*[F.lit(x) for pair in _COMMON.items() for x in pair])

    def decode(ref: Column) -> Column:
        rest = F.substr(body, F.length(ref) + 1)
        digits = F.regexp_extract(ref, r"^#([0-9]+)", 1)
        hexes = F.regexp_extract(ref, r"^#[xX]([0-9a-fA-F]+)", 1)
        number = F.when(digits != "", digits.try_cast("bigint")).otherwise(
            F.when(F.length(F.ltrim(hexes, F.lit("0"))) < 8, F.conv(hexes, 16, 10).try_cast("bigint"))
        )
        bare = F.regexp_extract(ref, f"^({'|'.join(_BARE)})", 1)
        named = F.coalesce(F.try_element_at(common, ref), F.try_element_at(names, ref))
        bare_named = F.try_element_at(names, bare)
        return (
            F.when(ref == "", F.concat(F.lit("&"), body))
            .when((digits != "") | (hexes != ""), F.concat(_code_point(number), rest))
            .when(named.isNotNull(), F.concat(named, rest))
            .when(bare_named.isNotNull(), F.concat(bare_named, F.substr(body, F.length(bare) + 1)))
            .otherwise(F.concat(F.lit("&"), body))
        )

    ref = F.regexp_extract(
        body, r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)", 1
    )
    return let(ref, decode)


def unescape(text: Column) -> Column:
    """Decode HTML character references; rows without '&' pass through untouched."""
    pieces = F.split(text, "&")
    decoded = F.transform(
        pieces, lambda piece, i: F.when(i == 0, piece).otherwise(_decode_reference(piece))
    )
    return F.when(F.contains(text, F.lit("&")), F.array_join(decoded, "")).otherwise(text)


def html_text(markup: Column) -> Column:
    """Markup to plain text: decode, then drop tags, then collapse."""
    return clean_text(F.regexp_replace(unescape(markup), TAG, " "))


# --- furniture -------------------------------------------------------------


def strip_chrome(text: Column) -> Column:
    """Cut collapse-button labels and the criteria list that pages append to a text."""
    text = F.coalesce(text, F.lit(""))
    cut = F.regexp_replace(text, f"(?s){SHOW_MORE_LESS}.*$", "")
    cut = F.regexp_replace(cut, CRITERIA_TAIL, "")
    return strip(F.regexp_replace(cut, TRAILING_TOGGLE, ""))


def strip_icons(text: Column) -> Column:
    """Remove icon-font words."""
    return strip(F.regexp_replace(text, rf"(?i){EDGE}(?:{'|'.join(ICON_WORDS)}){EDGE}", ""))


def looks_truncated(text: Column) -> Column:
    """True for a preview that ends in "see more", or a short text that mentions it."""
    short = strip(F.coalesce(text, F.lit("")))
    low = F.lower(short)
    return F.right(short, F.lit(160)).rlike(TRUNCATED_TAIL) | (
        (F.length(short) < 600)
        & (F.contains(low, F.lit("see more")) | F.contains(low, F.lit("show more")))
    )


# --- sentences and sections ------------------------------------------------


def dedup_sentences(text: Column) -> Column:
    """Keep the first of equal sentences; drop those of 10 characters or fewer.

    ``text`` is already collapsed.  Equal sentences meet by sorting, so a text of
    n sentences costs n log n, and the survivors go back to their first order.
    """
    parts = F.transform(
        F.split(text, rf"[.!?]{WS}+"),
        lambda s, i: F.struct(strip(F.lower(s)).alias("norm"), i.alias("at"), s.alias("s")),
    )
    ranked = F.sort_array(F.filter(parts, lambda p: F.length(p["norm"]) > 10))
    firsts = let(
        ranked,
        lambda a: F.filter(a, lambda p, i: (i == 0) | (F.get(a, i - 1)["norm"] != p["norm"])),
    )
    kept = F.transform(
        F.sort_array(F.transform(firsts, lambda p: F.struct(p["at"], p["s"]))),
        lambda p: p["s"],
    )
    return let(
        kept,
        lambda k: F.when(F.size(k) > 0, F.concat(F.array_join(k, ". "), F.lit("."))).otherwise(text),
    )


def word_count(text: Column) -> Column:
    """Words of a collapsed text."""
    trimmed = F.trim(text)
    spaces = F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit("")))
    return F.when(trimmed == "", 0).otherwise(spaces + 1)


_HEADER_LIST = [h for p in SECTION_HEADERS.values() for h in p[3:-1].split("|")]
_LONGEST_HEADER = max(map(len, _HEADER_LIST)) + 1  # with the character in front
# Letters outside ASCII that equal an ASCII letter when case is ignored.
_FOLDING = ["ı", "İ", "ſ", "K"]


def _by_first_letter(words: list[str]) -> str:
    """Alternation with one branch per first letter, so most places fail on one comparison."""
    groups: dict[str, list[str]] = {}
    for word in words:
        groups.setdefault(word[0], []).append(word[1:])
    return "|".join(f"{letter}(?:{'|'.join(rest)})" for letter, rest in groups.items())


def section_pieces(text: Column) -> Column:
    """``array<struct<name, body>>``: one entry per section header, in text order.

    A zero-width look-ahead splits the text before every header in one pass.
    What comes before the first header has no name and is dropped.  Full case
    folding costs several times more than ASCII folding and only matters for
    texts with one of four letters.
    """
    # Most characters start no header: one class tells before the alternatives are tried.
    firsts = "".join(sorted({h[0] for h in _HEADER_LIST}))
    headers = f"[{firsts}]", _by_first_letter(_HEADER_LIST)
    pieces = F.when(
        contains_any(text, _FOLDING), F.split(text, "(?iu)(?={})(?={})".format(*headers))
    ).otherwise(F.split(text, "(?i)(?={})(?={})".format(*headers)))

    def name_and_body(piece: Column) -> Column:
        head = F.left(piece, F.lit(_LONGEST_HEADER))
        name = F.coalesce(
            *[F.when(head.rlike(f"(?iu)^{p}"), F.lit(n)) for n, p in SECTION_HEADERS.items()]
        )
        header = F.regexp_extract(head, f"(?iu)^({'|'.join(_HEADER_LIST)})", 1)
        # Trimming at the end walks through the whole text: once is enough.
        body = F.rtrim(F.ltrim(F.substr(piece, F.length(header) + 1), F.lit(":•-" + WS_CHARS)), F.lit(WS_CHARS))
        return F.struct(name.alias("name"), body.alias("body"))

    return F.filter(F.transform(pieces, name_and_body), lambda p: p["name"].isNotNull())


def sections(text: Column) -> Column:
    """``map<string,string>``; of several non-empty pieces of one section the last one wins."""
    found = let(
        F.filter(let(text, section_pieces), lambda p: p["body"] != ""),
        lambda ps: F.filter(
            F.transform(
                F.array(*[F.lit(n) for n in sorted(SECTION_HEADERS)]),
                lambda n: F.try_element_at(F.filter(ps, lambda p: p["name"] == n), F.lit(-1)),
            ),
            lambda p: p.isNotNull(),
        ),
    )
    return F.map_from_entries(found)
