"""Raw pages to posting rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.boards import BOARDS, Boards, by_board, first_value
from postloom.fixed_values import BOARD_REQUIRED_FIELDS, DEFAULT_LOCATION, FULL_TEXT_MIN
from postloom.functions import jsonld
from postloom.functions.fields import employment_type
from postloom.functions.selectors import all_of, first_of, of_field, select_nodes
from postloom.functions.stage import staged
from postloom.functions.text import clean_text, html_text, let, strip, strip_chrome, strip_icons
from postloom.functions.urls import canonical_url, fallback_id, indeed_key
from postloom.operators.groups import top_per_group

PANE_SCRIPT_ID = "clicked-pane-texts"


def node_text(nodes: Column, field: str) -> Column:
    """Collapsed text of a field's first node; null when there is none."""
    return let(first_of(nodes, field), lambda n: F.when(n.isNotNull(), clean_text(n["text"])))


# --- choosing a description -------------------------------------------------------


def text_by_priority(dom_text: Column, inline: Column, described: Column) -> Column:
    """``struct<text, source>``: the first of DOM text, inline JSON, JSON-LD that is long enough."""
    enough = F.length(dom_text) >= FULL_TEXT_MIN
    best_inline = jsonld.longest(inline)
    return (
        F.when(enough, F.struct(dom_text.alias("text"), F.lit("dom:jobDescriptionText").alias("source")))
        .when(F.size(inline) > 0, F.struct(best_inline.alias("text"), F.lit("mosaic:sanitizedJobDescription").alias("source")))
        .when(
            F.length(described) >= FULL_TEXT_MIN,
            F.struct(described.alias("text"), F.lit("jsonld:JobPosting").alias("source")),
        )
        .otherwise(F.struct(described.alias("text"), F.lit("none").alias("source")))
    )


def text_by_length(candidates: list[tuple[str, Column]]) -> Column:
    """``struct<text, source>``: the longest candidate once page furniture is cut, the first on ties."""
    pairs = [
        F.transform(texts, _tagged(source)) for source, texts in candidates
    ]
    kept = F.filter(F.concat(*pairs), lambda c: c["text"] != "")
    ranked = F.transform(kept, lambda c, i: F.struct(F.length(c["text"]), -i, c.alias("c")))
    nothing = F.struct(F.lit("").alias("text"), F.lit("").alias("source"))
    return F.coalesce(F.array_max(ranked)["c"], nothing)


def _tagged(source: str):
    return lambda t: F.struct(strip_chrome(t).alias("text"), F.lit(source).alias("source"))


# --- detail pages --------------------------------------------------------------------


def _first_long(nodes: Column, field: str) -> Column:
    """Text of the first selector whose first node has a long one; ''."""
    found = F.sort_array(of_field(nodes, field))
    firsts = let(
        found, lambda a: F.filter(a, lambda n, i: (i == 0) | (F.get(a, i - 1)["rank"] != n["rank"]))
    )
    texts = F.filter(F.transform(firsts, lambda n: html_text(n["text"])), lambda t: F.length(t) >= FULL_TEXT_MIN)
    return F.coalesce(F.get(texts, F.lit(0)), F.lit(""))


def _node_texts(nodes: Column, field: str) -> Column:
    texts = F.transform(F.sort_array(of_field(nodes, field)), lambda n: clean_text(n["text"]))
    return F.filter(texts, lambda t: F.length(t) >= 20)


_PARTS = [
    "title", "meta_title", "company", "location", "other_text", "main_text", "salary", "posted", "type", "experience",
]


def detail_parts(pages: DataFrame, boards: Boards = BOARDS) -> DataFrame:
    """(url, html, board) pages with what their elements and JSON say, one column each."""
    board, nodes, html = F.col("board"), F.col("_nodes"), F.col("html")
    with_nodes = pages.withColumn("_nodes", select_nodes(html, board, boards.detail_selectors))
    read = {f"_{name}": node_text(nodes, name) for name in _PARTS if name != "meta_title"}
    read["_meta_title"] = clean_text(first_of(nodes, "meta_title")["content"])
    read["_ld"] = jsonld.posting_fields(html)
    by_length = text_by_length(
        [
            ("markup_css", _node_texts(nodes, "markup_text")),
            ("description_container", _node_texts(nodes, "container_text")),
            ("markup_html", jsonld.markup_texts(html)),
            ("embedded_json", jsonld.embedded_texts(html)),
            ("jobs_box", _node_texts(nodes, "box_text")),
            ("jsonld", jsonld.jsonld_descriptions(html)),
        ]
    )
    by_priority = let(
        jsonld.sanitized_texts(html),
        lambda inline: text_by_priority(
            _first_long(nodes, "main_text"), inline, html_text(F.col("_ld.description"))
        )["text"],
    )
    ways = {"priority": by_priority, "length": by_length["text"]}
    chosen = by_board(board, {name: ways[way] for name, way in boards.chosen.items()})
    return staged(staged(with_nodes, read), {"_best": chosen}).drop("_nodes")


def detail_postings(pages: DataFrame, boards: Boards = BOARDS) -> DataFrame:
    """One posting per detail page (url, html, board) that has a title and a long enough text."""
    return _detail_rows(detail_parts(pages, boards), boards).drop("_ld", "_best", *[f"_{p}" for p in _PARTS])


def pane_detail(pages: DataFrame, url: str = "job_url", card: str = "card", boards: Boards = BOARDS) -> DataFrame:
    """One posting per results page with an open pane (url, html, board, the caller's ``job_url`` and card).

    The text is the best of the page and decides alone whether there is a posting.  Title,
    company and location come from the card, then from JSON-LD; the url is the caller's, then
    the card's, then the page's.
    """
    listed = lambda name: _first(F.col(card)[name])
    values = {
        "title": _first(listed("title"), clean_text(F.col("_ld")["title"])),
        "company": F.coalesce(_first(listed("company"), clean_text(F.col("_ld")["company"])), F.lit("Unknown")),
        "location": F.coalesce(_first(listed("location"), clean_text(F.col("_ld")["location"])), F.lit(DEFAULT_LOCATION)),
        "description": F.col("_best"),
        "posted_date": F.col(card)["posted_date"],
    }
    parts = detail_parts(pages.withColumnsRenamed({url: "_given_url"}), boards)
    values["job_url"] = F.coalesce(_first(F.col("_given_url"), F.col(card)["job_url"]), F.col("url"))
    out = staged(parts, values, _complete).drop("_ld", "_best", "_given_url", *[f"_{p}" for p in _PARTS])
    return out.withColumn("job_id", fallback_id(F.col("title"), F.col("company"), F.col("location")))


def _first(*options: Column) -> Column:
    return F.coalesce(*[F.nullif(o, F.lit("")) for o in options])


def _detail_rows(parts: DataFrame, boards: Boards) -> DataFrame:
    return staged(_without_icons(parts, boards), _detail_values(boards), _complete).withColumn(
        "job_id", fallback_id(F.col("title"), F.col("company"), F.col("location"))
    )


def _without_icons(parts: DataFrame, boards: Boards) -> DataFrame:
    names = ("_title", "_company")
    clean = {n: F.when(boards.has(F.col("board"), "icons before names"), strip_icons(F.col(n))).otherwise(F.col(n)) for n in names}
    return staged(parts, clean)


def _detail_values(boards: Boards) -> dict[str, Column]:
    board = F.col("board")

    def part(name: str) -> Column:
        if name.startswith("json."):
            return clean_text(F.col("_ld")[name.removeprefix("json.")])
        return {"chosen": F.col("_best"), "clean chosen": clean_text(F.col("_best"))}.get(name, F.col(f"_{name}"))

    value = lambda name: first_value(boards.detail, name, board, part).cast("string")
    names = ["title", "company", "location", "description", "salary", "posted_date", "employment_type", "experience_required"]
    values = {name: value(name) for name in names}
    values["employment_type"] = employment_type(values["employment_type"], board, boards)
    return {**values, "job_url": F.col("url"), "skills": F.array().cast("array<string>")}


def _complete(row: Column) -> Column:
    """Long enough, and none of the required fields empty."""
    whole = F.length(row["description"]) >= FULL_TEXT_MIN
    for name in BOARD_REQUIRED_FIELDS:
        whole = whole & (F.coalesce(row[name], F.lit("")) != "")
    return whole


def replay(pages: DataFrame, listing: DataFrame, key: str, order: list[Column], boards: Boards = BOARDS) -> DataFrame:
    """Parse stored detail pages again, with the listing card of the same posting at hand.

    Of several cards of a posting the first in ``order`` counts.

    A page that parses keeps its fields (see ``merge_listing``); one that does not may
    still give a row from its JSON-LD and the card, if that makes a long enough text.
    """
    card_fields = ["title", "company", "location", "description", "job_url", "posted_date"]
    first = top_per_group(listing, [key], order)
    card = first.select(F.col(key).alias("_key"), F.struct(*card_fields).alias("_card"))
    parts = detail_parts(pages, boards).join(card, F.col(key) == F.col("_key"), "left").drop("_key")
    given, ld, board = F.col("_card"), F.col("_ld"), F.col("board")
    text = _first(
        F.when(boards.has(board, "chosen text before JSON"), F.col("_best")), ld["description"],
        F.when(boards.has(board, "cards fill gaps"), given["description"]),
    )
    values = {
        "title": F.coalesce(_first(given["title"], clean_text(ld["title"])), F.lit("")),
        "company": F.coalesce(_first(given["company"], clean_text(ld["company"])), F.lit("Unknown")),
        "location": F.coalesce(_first(given["location"], clean_text(ld["location"])), F.lit(DEFAULT_LOCATION)),
        "description": clean_text(text),
        "job_url": F.col("url"),
    }
    names = list(values)
    mine = {n: c for n, c in _detail_values(boards).items() if n in names}
    tries = staged(
        _without_icons(parts, boards),
        {
            "_parsed": F.struct(*[c.alias(n) for n, c in mine.items()]),
            "_rescued": F.struct(*[values[n].alias(n) for n in mine]),
        },
    )
    row = F.when(_complete(F.col("_parsed")), F.col("_parsed")).when(_complete(F.col("_rescued")), F.col("_rescued"))
    rows = tries.select(key, "board", "_card", row.alias("_row")).filter(F.col("_row").isNotNull())
    return merge_listing(rows.select(key, "board", "_row.*", "_card"), boards)


def merge_listing(rows: DataFrame, boards: Boards = BOARDS) -> DataFrame:
    """Lay parsed rows over their card.

    On some boards the card fills gaps and gives its text if that is longer once trimmed.
    Elsewhere the card comes first: its public url stays, and so does its text unless the
    parsed one is longer.
    """
    card, fills = F.col("_card"), boards.has(F.col("board"), "cards fill gaps")
    theirs = F.coalesce(card["description"], F.lit(""))
    longer_card = F.when(
        fills, F.length(strip(theirs)) > F.length(strip(F.col("description")))
    ).otherwise(card.isNotNull() & (F.length(theirs) >= F.length("description")))
    public = F.coalesce(card["job_url"], F.lit(""))
    open_url = (public != "") & ~F.lower(public).rlike("auth|login")
    unknown = F.col("company").isin("", "Unknown") & (F.coalesce(card["company"], F.lit("")) != "")
    return rows.withColumns(
        {
            "company": F.when(fills & unknown, card["company"]).otherwise(F.col("company")),
            "description": F.when(longer_card, card["description"]).otherwise(F.col("description")),
            "job_url": F.when(~fills & open_url, public).otherwise(F.col("job_url")),
        }
    ).drop("_card")


# --- listing pages -----------------------------------------------------------------------


def listing_cards(pages: DataFrame, key: str = "page_id", boards: Boards = BOARDS) -> DataFrame:
    """Listing pages (key, html, board) to cards, one per posting url and page.

    Without any usable card the board's plain links count, with "Untitled", "Unknown"
    and the default country in place of what they lack.  A page is one row until its cards are
    chosen, so nothing is shuffled.
    """
    board = F.col("board")
    parsed = pages.select(key, "board", select_nodes(F.col("html"), board, boards.card_selectors, ["card", "fallback"]).alias("_nodes"))
    marked = lambda nodes, plain: F.transform(nodes, lambda n: F.struct(n.alias("node"), F.lit(plain).alias("plain")))
    both = F.concat(marked(all_of(F.col("_nodes"), "card"), False), marked(F.sort_array(of_field(F.col("_nodes"), "fallback")), True))
    found = F.filter(F.transform(both, lambda one: _card(boards, board, F.col("_nodes"), one["node"], one["plain"])), _has_required)
    cards = staged(parsed, {"_cards": found}).drop("_nodes").withColumn("_cards", let(F.col("_cards"), _without_plain))
    # Of equal urls the first on the page, unless every place is a posting.
    named = lambda c: F.concat_ws("\x01", c["job_url"], F.when(boards.has(board, "places of a listing are postings"), c["at"]))
    first = let(
        F.array_sort("_cards"),
        lambda cards: let(F.transform(cards, named), lambda names: F.filter(cards, lambda c, i: F.array_position(names, named(c)) == i + 1)),
    )
    rows = staged(cards, {"_first": first}).select(key, "board", F.explode("_first").alias("c")).select(key, "board", "c.*").drop("at", "plain")
    return rows.withColumn("job_id", fallback_id(F.col("title"), F.col("company"), F.col("location")))


def _without_plain(cards: Column) -> Column:
    """The cards; the plain links only where there is no other."""
    return F.when(F.exists(cards, lambda c: ~c["plain"]), F.filter(cards, lambda c: ~c["plain"])).otherwise(cards)


def _has_required(card: Column) -> Column:
    whole = F.lit(True)
    for name in BOARD_REQUIRED_FIELDS:
        whole = whole & (F.coalesce(card[name], F.lit("")) != "")
    return whole


_CARD_FIELDS = ("link", "title", "company", "location", "text", "posted", "type", "experience")


def _card(boards: Boards, board: Column, nodes: Column, card: Column, plain: Column) -> Column:
    """What a card, or a plain link, of a page says; its place comes first."""
    inside = F.filter(nodes, lambda n: (n["at"] >= card["at"]) & (n["at"] <= card["upto"]))

    def read(held: Column) -> Column:
        names = F.transform(F.sort_array(of_field(held, "names")), lambda n: clean_text(n["text"]))
        return F.struct(
            *[node_text(held, f).alias(f) for f in _CARD_FIELDS],
            first_of(held, "link")["href"].alias("href"), first_of(held, "posted")["datetime"].alias("datetime"), names.alias("names"),
        )

    return F.when(plain, _link_values(boards, board, card)).otherwise(let(inside, lambda held: let(read(held), lambda r: _card_values(boards, board, card, r))))


_POSTING_FIELDS = ("title", "company", "location", "job_url", "description", "posted_date", "employment_type", "experience_required")


def _values(at: Column, plain: bool, **named: Column) -> Column:
    return F.struct(at.alias("at"), F.lit(plain).alias("plain"), *[named[n].cast("string").alias(n) for n in _POSTING_FIELDS])


def _card_values(boards: Boards, board: Column, card: Column, r: Column) -> Column:
    read = {
        "own": clean_text(card["text"]),
        "own href": card["href"],
        "end of own href": F.substring_index(card["href"], "/", -1),
        "name 0": F.rtrim(F.get(r["names"], F.lit(0)), F.lit(",")),
        "name 1": F.btrim(F.get(r["names"], F.lit(1)), F.lit(", ")),
    }
    value = lambda name: first_value(boards.cards, name, board, lambda p: read[p] if p in read else r[p])
    names = ["title", "company", "location", "description", "posted_date", "experience_required"]
    return _values(
        card["at"], False,
        **{name: value(name) for name in names},
        job_url=canonical_url(board, value("href"), boards),
        employment_type=employment_type(value("employment_type"), board, boards),
    )


def _link_values(boards: Boards, board: Column, card: Column) -> Column:
    none = F.lit(None)
    return _values(
        card["at"], True,
        title=F.coalesce(F.nullif(clean_text(card["text"]), F.lit("")), F.lit("Untitled")),
        company=F.lit("Unknown"),
        location=F.lit(DEFAULT_LOCATION),
        job_url=canonical_url(board, card["href"], boards),
        description=F.lit(""),
        posted_date=none,
        employment_type=none,
        experience_required=none,
    )


# --- collected pane texts -------------------------------------------------------------------


def pane_results(pages: DataFrame, key: str = "page_id", script_id: str = PANE_SCRIPT_ID) -> DataFrame:
    """(key, texts, hidden) from the script a page carries its collected texts in."""
    script = F.regexp_extract(F.col("html"), rf'(?s)<script[^>]*id="{script_id}"[^>]*>(.*?)</script>', 1)
    return pages.select(
        key, F.from_json(script, "jds map<string,string>, hidden array<string>").alias("r")
    ).select(key, F.col("r.jds").alias("texts"), F.col("r.hidden").alias("hidden"))


def pane_texts(results: DataFrame, key: str = "page_id") -> DataFrame:
    return results.select(key, F.explode("texts").alias("jk", "markup"))


def hidden_cards(results: DataFrame, key: str = "page_id") -> DataFrame:
    return results.select(key, F.explode("hidden").alias("jk"))


def with_pane_texts(cards: DataFrame, pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Drop excluded cards and put the collected text on those that have one."""
    results = pane_results(pages, key)
    keyed = cards.withColumn("jk", indeed_key(F.col("job_url")))
    kept = keyed.join(hidden_cards(results, key), [key, "jk"], "left_anti")
    texts = pane_texts(results, key)
    own = F.col("description") if "description" in cards.columns else F.lit("")
    return (
        kept.join(texts, [key, "jk"], "left")
        .withColumn("description", F.when(F.coalesce("markup", F.lit("")) != "", html_text(F.col("markup"))).otherwise(own))
        .drop("markup")
    )


def payload_text(payload: Column) -> Column:
    """Posting markup inside a successful response payload; ''."""
    path = "$.body.jobInfoWrapperModel.jobInfoModel.sanitizedJobDescription"
    text = F.when(F.get_json_object(payload, "$.status") == "success", F.get_json_object(payload, path))
    return F.coalesce(text, F.lit(""))
