"""Queries over raw pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from postloom.catalog import sql as S
from postloom.catalog.fixtures import view, with_views
from postloom.catalog.q_text import _WALL, POSTED, posting_rows
from postloom.catalog.registry import query
from postloom.functions import jsonld, text, urls
from postloom.functions.selectors import first_of, of_field, select_nodes
from postloom.operators import extract, report

PAGES = ("job_pages",)


def pages_of(spark, sf_dir, name="job_pages"):
    return view(spark, sf_dir, name)


@query("scan_pages", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def scan_pages(spark, sf_dir):
    return view(spark, sf_dir, "pages").select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


@query(
    "auth_walls",
    with_views(
        f"""SELECT page_id, {S.any_of('lower(url)', _WALL)} OR {S.any_of('lower(html)', ['bot-detection-anonymous', 'from=bot-detection'])} AS wall,
        {S.any_of('lower(url)', ['bot-detection', 'secure.indeed.com/auth'])} AS bot_wall FROM job_pages""",
        *PAGES,
    ),
)
def auth_walls(spark, sf_dir):
    return pages_of(spark, sf_dir).select(
        "page_id",
        urls.is_auth_wall(F.col("url"), F.col("html")).alias("wall"),
        urls.is_bot_wall(F.col("url")).alias("bot_wall"),
    )


_FLAGS = ["cloudflare", "attention required", "captcha", "unusual traffic", "enable javascript", "sign in", "authwall", "challenge"]
_PLANTED = "CASE page_id % 5 WHEN 0 THEN 'Please Sign In and solve the CAPTCHA' WHEN 1 THEN 'cloudflare challenge' ELSE '' END || html"


@query(
    "page_flags",
    with_views(
        "SELECT page_id, coalesce(nullif(concat_ws(',', " + ", ".join(f"CASE WHEN contains(h, '{f}') THEN '{f}' END" for f in _FLAGS) + f"), ''), 'none') AS flags FROM (SELECT page_id, lower({_PLANTED}) AS h FROM job_pages) s",
        *PAGES,
    ),
)
def page_flags(spark, sf_dir):
    return pages_of(spark, sf_dir).select("page_id", report.page_flags(F.expr(_PLANTED)).alias("flags"))


_BOUNCE = "url_decode(regexp_extract(url, '[?&]continue2=([^&]+)', 1))"
_REFRESH = "regexp_extract(html, 'http-equiv=\"refresh\" content=\"0; url=([^\">]+)', 1)"


@query(
    "redirect_target",
    with_views(
        f"SELECT page_id, CASE WHEN contains(url, 'continue2=') THEN {_BOUNCE} WHEN {_REFRESH} <> '' AND {_REFRESH} <> url THEN {_REFRESH} ELSE '' END AS target FROM job_pages",
        *PAGES,
    ),
)
def redirect_target(spark, sf_dir):
    return pages_of(spark, sf_dir).select(
        "page_id", urls.redirect_target(F.col("url"), F.col("html"), F.col("url")).alias("target")
    )


# --- JSON-LD -----------------------------------------------------------------------------

_NODE = """SELECT page_id, json_extract_string(j, '$.title') AS title, json_extract_string(j, '$.description') AS description,
  json_extract_string(j, '$.hiringOrganization.name') AS company, json_extract_string(j, '$.jobLocation.address.addressLocality') || ', ' || json_extract_string(j, '$.jobLocation.address.addressCountry') AS location
  FROM (SELECT page_id, CAST(regexp_extract(html, '(?is)<script[^>]*application/ld\\+json[^>]*>(.*?)</script>', 1) AS JSON) AS j FROM job_pages WHERE contains(html, 'ld+json')) s"""
_NODE = _NODE.replace("\\\\", "\\")
_PLAIN = S.collapse("regexp_replace(replace(description, '&amp;', '&'), '<[^>]+>', ' ', 'g')")


@query("jsonld_nodes", with_views("SELECT page_id, title, description FROM nodes", *PAGES, nodes=_NODE))
def jsonld_nodes(spark, sf_dir):
    nodes = pages_of(spark, sf_dir).select("page_id", F.explode(jsonld.posting_nodes(F.col("html"))).alias("n"))
    return nodes.select(
        "page_id",
        F.try_variant_get("n", "$.title", "string").alias("title"),
        F.try_variant_get("n", "$.description", "string").alias("description"),
    )


@query(
    "jsonld_fields",
    with_views(
        f"SELECT p.page_id, coalesce(title, '') AS title, coalesce({_PLAIN}, '') AS description, coalesce(company, '') AS company, coalesce(location, '') AS location FROM job_pages p LEFT JOIN nodes n ON p.page_id = n.page_id",
        *PAGES,
        nodes=_NODE,
    ),
)
def jsonld_fields(spark, sf_dir):
    return pages_of(spark, sf_dir).select("page_id", jsonld.posting_fields(F.col("html")).alias("f")).select("page_id", "f.*")


@query("jsonld_descriptions", with_views(f"SELECT page_id, {_PLAIN} AS description FROM nodes", *PAGES, nodes=_NODE))
def jsonld_descriptions(spark, sf_dir):
    return pages_of(spark, sf_dir).select("page_id", F.explode(jsonld.jsonld_descriptions(F.col("html"))).alias("description"))


# --- inline JSON and choices of text -----------------------------------------------------------

_ID = "CAST(page_id AS VARCHAR)"
_OWN = f"'Own the build of service ' || {_ID} || ' & its \"data\" platform from end to end.'"
_DESIGN = f"'Design reports for region ' || {_ID} || '. Ship them daily with SQL and care.'"
_LEAD = f"'Lead the support group of plant ' || {_ID} || ' and keep every promised deadline.'"


@query(
    "embedded_json",
    with_views(
        f"SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'sanitized' WHEN 1 THEN 'embedded' ELSE 'markup' END AS kind, CASE page_id % 4 WHEN 0 THEN {_OWN} WHEN 1 THEN {_DESIGN} ELSE {_LEAD} END AS found FROM pages WHERE page_id % 4 <> 3"
    ),
)
def embedded_json(spark, sf_dir):
    kinds = {"sanitized": jsonld.sanitized_texts, "embedded": jsonld.embedded_texts, "markup": jsonld.markup_texts}
    tagged = F.concat(
        *[
            F.transform(fn(F.col("html")), _tag(kind))
            for kind, fn in kinds.items()
        ]
    )
    return pages_of(spark, sf_dir, "json_pages").select("page_id", F.explode(tagged).alias("t")).select("page_id", "t.*")


def _tag(kind):
    return lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("found"))


@query(
    "best_text_priority",
    with_views(
        f"""SELECT p.page_id, CASE WHEN p.page_id % 5 = 0 THEN 'A text taken from the element itself, long enough.' WHEN p.page_id % 4 = 0 THEN {_OWN.replace('page_id', 'p.page_id')} WHEN n.page_id IS NOT NULL THEN {_PLAIN} ELSE '' END AS text,
          CASE WHEN p.page_id % 5 = 0 THEN 'dom:jobDescriptionText' WHEN p.page_id % 4 = 0 THEN 'mosaic:sanitizedJobDescription' WHEN length({_PLAIN}) >= 50 THEN 'jsonld:JobPosting' ELSE 'none' END AS source
        FROM pages p LEFT JOIN nodes n ON p.page_id = n.page_id""",
        *PAGES,
        nodes=_NODE,
    ),
)
def best_text_priority(spark, sf_dir):
    inline = pages_of(spark, sf_dir, "json_pages").select("page_id", jsonld.sanitized_texts(F.col("html")).alias("inline"))
    described = pages_of(spark, sf_dir).select("page_id", jsonld.posting_fields(F.col("html"))["description"].alias("d"))
    dom = F.when(F.col("page_id") % 5 == 0, "A text taken from the element itself, long enough.").otherwise("")
    chosen = extract.text_by_priority(dom, F.col("inline"), F.col("d"))
    return inline.join(described, "page_id").select("page_id", chosen.alias("c")).select("page_id", "c.*")


@query(
    "best_text_longest",
    with_views(
        f"""SELECT page_id, CASE page_id % 4 WHEN 1 THEN {_DESIGN} WHEN 2 THEN {_LEAD} ELSE 'A short preview of the text.' END AS text,
          CASE page_id % 4 WHEN 1 THEN 'embedded_json' WHEN 2 THEN 'markup_html' ELSE 'markup_css' END AS source FROM pages"""
    ),
)
def best_text_longest(spark, sf_dir):
    preview = F.array(F.lit("A short preview of the text. Show more Show less Seniority level Entry level Employment type Contract, and more"))
    chosen = extract.text_by_length(
        [
            ("markup_css", preview),
            ("markup_html", jsonld.markup_texts(F.col("html"))),
            ("embedded_json", jsonld.embedded_texts(F.col("html"))),
        ]
    )
    return pages_of(spark, sf_dir, "json_pages").select("page_id", chosen.alias("c")).select("page_id", "c.*")


# --- elements ----------------------------------------------------------------------------------


def _inner(x: str, tag: str) -> str:
    """Text of the first element of a tag that does not nest."""
    body = f"regexp_replace(regexp_extract({x}, '(?s)<{tag}>(.*?)(?:</{tag}>|$)', 1), '<[^>]*>', ' ', 'g')"
    return S.collapse(S.unescape(body))


@query(
    "selector_extract",
    f"SELECT page_id, {_inner('html', 'h1')} AS headline, {_inner('html', 'title')} AS title, {_inner('html', 'article')} AS body, CAST(len(regexp_extract_all(html, '<nav><ul>|<li><a href')) - 1 AS INTEGER) AS n_links FROM pages",
)
def selector_extract(spark, sf_dir):
    wanted = {"headline": ["h1"], "title": ["head > title"], "body": ["article"], "link": ["nav ul > li a[href]"]}
    nodes = select_nodes(F.col("html"), F.lit("page"), {"page": wanted})
    found = pages_of(spark, sf_dir, "pages").select("page_id", nodes.alias("n"))
    return found.select(
        "page_id",
        *[text.clean_text(first_of(F.col("n"), f)["text"]).alias(f) for f in ("headline", "title", "body")],
        F.size(of_field(F.col("n"), "link")).alias("n_links"),
    )


_DETAIL_BODY = _inner("html", "article")
_FIRM = "'Firm ' || CAST(page_id AS VARCHAR)"
_DETAIL_ROWS = f"""SELECT page_id, board, {_inner('html', 'h1')} AS title, {_FIRM} AS company,
    CASE board WHEN 'indeed' THEN 'Lahore' WHEN 'linkedin' THEN 'Pakistan' ELSE 'Multan' END AS location, body AS description,
    CASE board WHEN 'indeed' THEN 'PKR 90,000' END AS salary, CASE board WHEN 'mustakbil' THEN '2 days ago' END AS posted_date,
    CASE board WHEN 'linkedin' THEN 'full-time' WHEN 'mustakbil' THEN 'part-time' END AS employment_type
  FROM (SELECT page_id, html, CASE page_id % 3 WHEN 0 THEN 'indeed' WHEN 1 THEN 'linkedin' ELSE 'mustakbil' END AS board, {_DETAIL_BODY} AS body FROM pages) s
  WHERE length(body) >= 50"""


@query("detail_postings", _DETAIL_ROWS)
def detail_postings(spark, sf_dir):
    return extract.detail_postings(pages_of(spark, sf_dir, "detail_pages")).select(
        "page_id", "board", "title", "company", "location", "description", "salary", "posted_date", "employment_type"
    )


@query(
    "replay_html",
    with_views(
        f"""SELECT d.page_id, d.board, d.title, d.company, d.location,
          CASE WHEN d.board = 'indeed' AND length({S.text('p.description')}) > length({S.text('d.description')}) THEN p.description
            WHEN d.board <> 'indeed' AND p.doc_id IS NOT NULL AND length(p.description) >= length(d.description) THEN p.description ELSE d.description END AS description,
          CASE WHEN d.board = 'indeed' OR p.doc_id IS NULL THEN g.url ELSE p.job_url END AS job_url
        FROM details d JOIN pages g ON d.page_id = g.page_id LEFT JOIN postings p ON p.doc_id = d.page_id""",
        *POSTED,
        details=_DETAIL_ROWS,
    ),
)
def replay_html(spark, sf_dir):
    """Detail pages once more, each with the card of the scraped row of the same number."""
    card = posting_rows(spark, sf_dir).withColumnRenamed("doc_id", "page_id")
    return extract.replay(pages_of(spark, sf_dir, "detail_pages"), card, "page_id", [F.col("scraped_at")])


@query(
    "pane_detail",
    with_views(
        """SELECT d.page_id, p.title, coalesce(nullif(p.company, ''), 'Unknown') AS company, coalesce(nullif(p.location, ''), 'Pakistan') AS location, d.description, p.posted_date,
          CASE WHEN d.page_id % 2 = 0 THEN p.job_url ELSE 'https://pk.indeed.com/viewjob?jk=' || CAST(d.page_id AS VARCHAR) END AS job_url
        FROM details d JOIN postings p ON p.doc_id = d.page_id WHERE d.board = 'indeed'""",
        *POSTED,
        details=_DETAIL_ROWS,
    ),
)
def pane_detail(spark, sf_dir):
    """Results pages with an open pane, each with the card of the scraped row of the same number; half come with a url."""
    names = ["title", "company", "location", "job_url", "posted_date"]
    card = posting_rows(spark, sf_dir).select(F.col("doc_id").alias("page_id"), F.struct(*names).alias("card"))
    pages = pages_of(spark, sf_dir, "detail_pages").filter("board = 'indeed'").join(card, "page_id", "left")
    given = F.when(F.col("page_id") % 2 == 0, "").otherwise(F.concat(F.lit("https://pk.indeed.com/viewjob?jk="), F.col("page_id").cast("string")))
    out = extract.pane_detail(pages.withColumn("job_url", given))
    return out.select("page_id", "title", "company", "location", "description", "posted_date", "job_url")


_CARDS = f"""SELECT page_id, board, title, company, location, url AS job_url FROM (
  SELECT *, row_number() OVER (PARTITION BY page_id, CASE WHEN board = 'rozee' THEN CAST(i AS VARCHAR) ELSE url END ORDER BY i) AS rn FROM (
    SELECT page_id, board, i, {S.collapse(S.unescape("regexp_extract(li, '>([^<]*)</a>', 1)"))} AS title,
      CASE board WHEN 'indeed' THEN 'Firm ' || CAST(page_id AS VARCHAR) WHEN 'rozee' THEN 'Firm A' ELSE 'Unknown' END AS company,
      CASE board WHEN 'linkedin' THEN 'Karachi' WHEN 'rozee' THEN 'Lahore' ELSE 'Pakistan' END AS location,
      CASE board WHEN 'linkedin' THEN 'https://www.linkedin.com/jobs/view/' || href WHEN 'indeed' THEN CASE WHEN href = '' THEN '' ELSE 'https://pk.indeed.com/viewjob?jk=' || href END WHEN 'rozee' THEN 'https://www.rozee.pk/' || href ELSE 'https://www.mustakbil.com/jobs/job/' || href END AS url
    FROM (SELECT *, {S.unescape("regexp_extract(li, 'href=\"/([^\"]*)\"', 1)")} AS href FROM (
      SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'linkedin' WHEN 1 THEN 'indeed' WHEN 2 THEN 'rozee' ELSE 'mustakbil' END AS board, unnest(lis) AS li, generate_subscripts(lis, 1) AS i
      FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="/[^"]*">[^<]*</a></li>') AS lis FROM pages) a) b) c) d WHERE title <> '' AND url <> '') e WHERE rn = 1"""


@query("listing_cards", _CARDS)
def listing_cards(spark, sf_dir):
    return extract.listing_cards(pages_of(spark, sf_dir, "listing_pages")).select(
        "page_id", "board", "title", "company", "location", "job_url"
    )


# --- collected pane texts ------------------------------------------------------------------------

CARDS = ("pane_cards",)


@query(
    "drop_excluded_cards",
    with_views("SELECT page_id, job_url FROM pane_cards WHERE card <> 'c'", *CARDS),
)
def drop_excluded_cards(spark, sf_dir):
    return extract.with_pane_texts(view(spark, sf_dir, "pane_cards"), view(spark, sf_dir, "pane_pages")).select("page_id", "job_url")


@query(
    "pane_texts",
    with_views(
        "SELECT page_id, job_url, CASE card WHEN 'a' THEN 'Collected text of card ' || CAST(page_id AS VARCHAR) WHEN 'b' THEN 'Second text' ELSE '' END AS description FROM pane_cards WHERE card <> 'c'",
        *CARDS,
    ),
)
def pane_texts(spark, sf_dir):
    return extract.with_pane_texts(view(spark, sf_dir, "pane_cards"), view(spark, sf_dir, "pane_pages")).select(
        "page_id", "job_url", "description"
    )


@query(
    "payload_text",
    with_views("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE description END AS text FROM postings", *POSTED),
)
def payload_text(spark, sf_dir):
    """Every description wrapped in a response payload, a third of them unsuccessful."""
    info = F.struct(F.struct(F.col("description").alias("sanitizedJobDescription")).alias("jobInfoModel"))
    status = F.when(F.col("doc_id") % 3 == 0, "error").otherwise("success")
    payload = F.to_json(F.struct(status.alias("status"), F.struct(info.alias("jobInfoWrapperModel")).alias("body")))
    return posting_rows(spark, sf_dir).select("doc_id", payload.alias("p")).select("doc_id", extract.payload_text(F.col("p")).alias("text"))
