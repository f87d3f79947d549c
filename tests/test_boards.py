"""Boards are rows of rules: a new one takes no new code."""

import pytest
from pyspark.sql import functions as F

from postloom.boards import BOARDS, KINDS, Rule, UrlRule, first_value
from postloom.functions.urls import canonical_url
from postloom.operators import extract

FIFTH = BOARDS.with_board(
    "harbour",
    detail_selectors={"title": ["h2.role"], "company": ["p.firm"], "main_text": ["div.duties"], "salary": ["b.pay"], "type": ["i.kind"]},
    card_selectors={"card": ["div.berth"], "link": ["a.to"], "company": ["em"], "fallback": ["a.plain"]},
    detail=[
        Rule("harbour", "title", "filled", "json.title"),
        Rule("harbour", "title", "filled", "title"),
        Rule("harbour", "salary", "holding", "salary", "EUR"),
        Rule("harbour", "posted_date", "constant", value="open"),
    ],
    cards=[Rule("harbour", "location", "constant", value="Rotterdam")],
    urls=[UrlRule("harbour", "parameter", "berth", "https://harbour.example/b/"), UrlRule("harbour", "starts", "/", "https://harbour.example")],
    traits={"types in full words"},
)
DUTIES = "Load and unload the ships that arrive by night, and keep the books of the crane in order."


def pages(spark, *rows):
    return spark.createDataFrame(rows, "page_id int, url string, html string, board string")


def detail(title="Crane driver", pay="900 EUR", kind="full-time"):
    return f"<h2 class=role>{title}</h2><p class=firm>Quay Ltd</p><div class=duties>{DUTIES}</div><b class=pay>{pay}</b><i class=kind>{kind}</i>"


def test_a_fifth_board_has_postings(spark):
    linked = '<script type="application/ld+json">{"@type": "JobPosting", "title": "Night driver"}</script>'
    given = pages(
        spark,
        (1, "u1", detail(), "harbour"), (2, "u2", linked + detail(pay="900 USD", kind="fully booked"), "harbour"),
        (3, "u3", detail(title=""), "harbour"), (4, "u4", None, "harbour"), (5, "u5", detail(), None), (6, "u6", detail(), "no board"),
    )
    rows = {r.page_id: r for r in extract.detail_postings(given, FIFTH).collect()}
    assert set(rows) == {1, 2}
    one, two = rows[1], rows[2]
    assert (one.title, one.company, one.location, one.description) == ("Crane driver", "Quay Ltd", "Pakistan", DUTIES)
    assert (one.salary, one.employment_type, one.posted_date, one.job_url) == ("900 EUR", "full-time", "open", "u1")
    assert (two.title, two.salary, two.employment_type) == ("Night driver", None, None)
    assert extract.detail_postings(given).count() == 0


def test_a_fifth_board_has_cards(spark):
    html = (
        "<div class=berth><a class=to href='/b/1'>First</a><em>Quay Ltd</em></div><div class=berth><a class=to href='x?berth=22&y'>Second</a></div>"
        "<div class=berth><a class=to href='mailto:x'>Third</a></div><div class=berth><a class=to href='/b/1'>Again</a></div>"
    )
    given = pages(spark, (1, "u", html, "harbour"), (2, "u", "<a class=plain href='/b/9'>Plain</a>", "harbour"))
    rows = extract.listing_cards(given, boards=FIFTH).collect()
    got = sorted((r.page_id, r.title, r.company, r.location, r.job_url) for r in rows)
    assert got == [
        (1, "First", "Quay Ltd", "Rotterdam", "https://harbour.example/b/1"),
        (1, "Second", "Unknown", "Rotterdam", "https://harbour.example/b/22"),
        (2, "Plain", "Unknown", "Pakistan", "https://harbour.example/b/9"),
    ]
    assert extract.listing_cards(given).count() == 0


def test_the_first_rule_that_gives_something_counts(spark):
    rules = (
        Rule("a", "f", "long", "p"), Rule("a", "f", "known", "q"), Rule("a", "f", "constant", value="none"),
        Rule("", "f", "given", "p"), Rule("b", "g", "given", "p"),
    )
    rows = [("a", "x" * 50, "q"), ("a", "x", "Q"), ("a", "x", "Unknown"), ("a", None, None), ("b", "", "q"), (None, "x", "q"), ("c", None, "q")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, board string, p string, q string")
    value = lambda name: first_value(rules, name, F.col("board"), F.col)
    got = df.select("i", value("f").alias("f"), value("g").alias("g"), value("h").cast("string").alias("h")).orderBy("i").collect()
    assert [r.f for r in got] == ["x" * 50, "Q", "none", "none", "", "x", None]
    assert [r.g for r in got] == [None, None, None, None, "", None, None] and {r.h for r in got} == {None}


def test_rules_are_checked():
    assert {r.kind for r in [*BOARDS.detail, *BOARDS.cards]} <= set(KINDS)
    for wrong in ({"detail": [Rule("other", "title", "given", "title")]}, {"cards": [Rule("n", "title", "guess", "title")]}, {"traits": {"shiny"}}):
        with pytest.raises(ValueError):
            BOARDS.with_board("n", detail_selectors={}, **wrong)


def test_known_boards_are_as_before_beside_a_new_one(spark):
    rows = [("indeed", "/rc/clk?jk=ab&x"), ("linkedin", "/jobs/view/1?a"), ("rozee", "//r/1"), ("mustakbil", "/m"), ("harbour", "none"), ("z", "q")]
    df = spark.createDataFrame(rows, "b string, u string")
    got = df.select(canonical_url(F.col("b"), F.col("u"), FIFTH).alias("new"), canonical_url(F.col("b"), F.col("u")).alias("old"), "b").collect()
    assert all(r.new == r.old for r in got if r.b != "harbour") and [r.new for r in got if r.b == "harbour"] == [""]
