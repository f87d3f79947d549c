"""Texts that pages carry as structured or inline JSON, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postloom.fixed_values import (
    ARTICLE_BODY_TEXT,
    EMBEDDED_JSON_TEXT,
    JSONLD_SCRIPT,
    MARKUP_BLOCK,
    SANITIZED_JSON_TEXT,
)
from postloom.functions.text import html_text, let, unescape

FIELDS = ["title", "description", "company", "location"]
_FALSY = ["null", "[]", "{}", '""', "0", "false"]


# --- JSON-LD -------------------------------------------------------------------


def _get(node: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(node, path, kind)


def _as_list(node: Column) -> Column:
    return F.coalesce(_get(node, "$", "array<variant>"), F.array(node))


def posting_nodes(html: Column) -> Column:
    """``array<variant>``: every JobPosting node of a page.

    Scripts may hold a node, a list of nodes or an ``@graph``; bad JSON is skipped.
    """
    scripts = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(JSONLD_SCRIPT), F.lit(1))
    parsed = F.filter(F.transform(scripts, F.try_parse_json), lambda v: v.isNotNull())
    nodes = F.flatten(F.transform(parsed, _as_list))

    def expand(node: Column) -> Column:
        return let(
            _get(node, '$["@graph"]'),
            lambda graph: F.when(
                F.coalesce(F.to_json(graph), F.lit("null")).isin(_FALSY), F.array(node)
            ).otherwise(_as_list(graph)),
        )

    def is_posting(node: Column) -> Column:
        kinds = F.coalesce(
            _get(node, '$["@type"]', "array<string>"), F.array(_get(node, '$["@type"]', "string"))
        )
        return F.coalesce(F.array_contains(kinds, "JobPosting"), F.lit(False))

    return F.filter(F.flatten(F.transform(nodes, expand)), is_posting)


def _json(node: Column) -> Column:
    return F.coalesce(F.to_json(node), F.lit("null"))


def _scalar(value: Column) -> Column:
    """Text of a scalar; an object gives its @value or its name."""
    empty = F.lit("")
    inner = F.coalesce(
        F.nullif(_get(value, '$["@value"]', "string"), empty), _get(value, "$.name", "string"), empty
    )
    return F.when(_json(value).startswith("{"), inner).otherwise(F.coalesce(_get(value, "$", "string"), empty))


def _raw(node: Column, path: str) -> Column:
    return let(_get(node, path), _scalar)


def _company(node: Column) -> Column:
    def named(org: Column) -> Column:
        name = F.coalesce(F.nullif(_raw(org, "$.name"), F.lit("")), _raw(org, "$.legalName"))
        return F.when(_json(org).startswith("{"), name).otherwise(_scalar(org))

    return let(_get(node, "$.hiringOrganization"), named)


def _place_parts(node: Column) -> Column:
    """Raw pieces of the location: locality, region and country, or one text."""
    place = F.when(
        _json(_get(node, "$.jobLocation")).startswith("["), _get(node, "$.jobLocation[0]")
    ).otherwise(_get(node, "$.jobLocation"))

    def pieces(place: Column) -> Column:
        inner = _get(place, "$.address")
        address = F.when(_json(inner).isin(_FALSY), place).otherwise(inner)
        of_address = let(
            address,
            lambda a: F.when(
                _json(a).startswith("{"),
                F.array(*[_raw(a, f"$.address{p}") for p in ("Locality", "Region", "Country")]),
            ),
        )
        whole = F.array(_scalar(place))
        return F.when(_json(place).startswith("{"), F.coalesce(of_address, whole)).otherwise(whole)

    return let(place, pieces)


def node_fields(node: Column) -> Column:
    """``struct<title, description, company, location>`` of one node as plain texts."""
    raw = F.concat(
        F.array(_raw(node, "$.title"), _raw(node, "$.description"), _company(node)), _place_parts(node)
    )

    def fields(texts: Column) -> Column:
        place = F.filter(F.slice(texts, F.lit(4), F.lit(3)), lambda p: p != "")
        return F.struct(
            F.get(texts, F.lit(0)).alias("title"),
            F.get(texts, F.lit(1)).alias("description"),
            F.get(texts, F.lit(2)).alias("company"),
            F.array_join(place, ", ").alias("location"),
        )

    return let(F.transform(raw, html_text), fields)


def longest(texts: Column) -> Column:
    """The longest text of an array, the first on ties; '' for an empty array."""
    ranked = F.transform(texts, lambda t, i: F.struct(F.length(t), -i, t.alias("t")))
    return F.coalesce(F.array_max(ranked)["t"], F.lit(""))


def posting_fields(html: Column) -> Column:
    """Per field the longest value over a page's JobPosting nodes."""
    return let(
        F.transform(posting_nodes(html), node_fields),
        lambda found: F.struct(*[longest(_field(found, f)).alias(f) for f in FIELDS]),
    )


def _field(nodes: Column, name: str) -> Column:
    return F.transform(nodes, lambda n: n[name])


def jsonld_descriptions(html: Column) -> Column:
    """Descriptions of at least 20 characters, in page order."""
    texts = F.transform(posting_nodes(html), lambda n: html_text(_raw(n, "$.description")))
    return F.filter(texts, lambda t: F.length(t) >= 20)


# --- inline JSON -----------------------------------------------------------------


def _long_enough(texts: Column) -> Column:
    return F.filter(texts, lambda t: F.length(t) >= 50)


def decode_json_string(body: Column) -> Column:
    """What stands between the quotes of a JSON string; malformed escapes are eased out."""
    strict = F.from_json(F.concat(F.lit('{"v":"'), body, F.lit('"}')), "v string")["v"]
    eased = unescape(F.replace(F.replace(body, F.lit("\\n"), F.lit("\n")), F.lit('\\"'), F.lit('"')))
    return F.coalesce(strict, eased)


def sanitized_texts(html: Column) -> Column:
    """Long plain texts under "sanitizedJobDescription"."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(SANITIZED_JSON_TEXT), F.lit(1))
    return _long_enough(F.transform(found, lambda s: html_text(decode_json_string(s))))


_ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f", "v": "\x0b", "a": "\x07", "\\": "\\", "'": "'", '"': '"'}


def decode_escapes(body: Column) -> Column:
    """Backslash escapes of a text whose bytes are read one by one (as Latin-1).

    Text outside ASCII therefore comes out as it is stored today, byte by byte.
    """
    latin = F.decode(F.encode(body, "UTF-8"), "ISO-8859-1")
    pieces = F.regexp_extract_all(
        latin, F.lit(r"(?s)(\\(?:u[0-9a-fA-F]{4}|x[0-9a-fA-F]{2}|[0-7]{1,3}|.)|[^\\]+)"), F.lit(1)
    )

    def char(number: Column) -> Column:
        return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")

    def decode(piece: Column) -> Column:
        hexes = F.regexp_extract(piece, r"^\\[ux]([0-9a-fA-F]+)$", 1)
        octal = F.regexp_extract(piece, r"^\\([0-7]+)$", 1)
        simple = [F.when(piece == "\\" + k, F.lit(v)) for k, v in _ESCAPES.items()]
        return F.when(~piece.startswith("\\"), piece).otherwise(
            F.coalesce(
                *simple,
                F.when(hexes != "", char(F.conv(hexes, 16, 10).cast("bigint"))),
                F.when(octal != "", char(F.conv(octal, 8, 10).cast("bigint"))),
                piece,
            )
        )

    broken = body.rlike(r"(?<!\\)(?:\\\\)*\\(?:u(?![0-9a-fA-F]{4})|x(?![0-9a-fA-F]{2}))")
    eased = F.replace(F.replace(body, F.lit("\\n"), F.lit("\n")), F.lit('\\"'), F.lit('"'))
    return F.when(broken, eased).otherwise(F.array_join(F.transform(pieces, decode), ""))


def embedded_texts(html: Column) -> Column:
    """Long plain texts under description-like keys, then under "articleBody"."""
    html = F.coalesce(html, F.lit(""))
    found = F.concat(
        F.regexp_extract_all(html, F.lit(EMBEDDED_JSON_TEXT), F.lit(1)),
        F.regexp_extract_all(html, F.lit(ARTICLE_BODY_TEXT), F.lit(1)),
    )
    return _long_enough(F.transform(found, lambda s: html_text(decode_escapes(s))))


def markup_texts(html: Column) -> Column:
    """Long plain texts of collapsed-markup blocks."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(MARKUP_BLOCK), F.lit(1))
    return _long_enough(F.transform(found, html_text))
