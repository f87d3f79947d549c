"""Prepare scraped rows, compare them with the stored table, merge, map to table rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.fixed_values import (
    BOARD_REQUIRED_FIELDS,
    FULL_TEXT_MIN,
    INDEED_TEXT_MIN,
    LISTING_PLACEHOLDER,
    LISTING_PLACEHOLDER_TAIL,
)
from postloom.functions.dates import posted_at
from postloom.functions.fields import experience_years, is_blank, is_blank_list
from postloom.functions.text import strip
from postloom.functions.urls import stable_id
from postloom.operators.groups import top_per_group
from postloom.schemas import ADDED_COLUMNS, JOBS, LOOKUP_COLUMNS
from postloom.sources.tables import stored_by_ids

# incoming column -> stored column
FIELD_PAIRS = {
    "company": "company",
    "location": "location",
    "job_url": "url",
    "title": "job_title",
    "employment_type": "job_type",
    "salary": "salary_raw",
    "posted_date": "posted_date",
}


def _text(name: str | Column) -> Column:
    column = F.col(name) if isinstance(name, str) else name
    return strip(F.coalesce(column, F.lit("")))


def board_of(df: DataFrame, hint: str = "") -> Column:
    """Lowered board, else source, else the hint."""
    names = [F.when(F.col(c) != "", F.col(c)) for c in ("board", "job_source") if c in df.columns]
    return F.lower(F.coalesce(*names, F.lit(hint)))


# --- row rules -----------------------------------------------------------------


def is_persistable(board: Column, description: str = "description") -> Column:
    """Long text; on indeed a shorter one or a complete card; elsewhere any text or title."""
    card = (
        (_text("title") != "")
        & (_text("job_url") != "")
        & ~F.lower(_text("company")).isin("", "unknown")
    )
    needed = (
        F.when(board == "indeed", F.when(card, 0).otherwise(INDEED_TEXT_MIN))
        .when(board == "linkedin", FULL_TEXT_MIN)
        .otherwise(F.when(_text("title") != "", 0).otherwise(1))
    )
    return F.length(_text(description)) >= needed


def listing_description(board: Column) -> Column:
    """The description, or a stand-in built from an indeed card whose text is too short."""
    text = _text("description")
    enough = F.length(text) >= F.when(
        F.contains(text, F.lit(LISTING_PLACEHOLDER)), FULL_TEXT_MIN
    ).otherwise(INDEED_TEXT_MIN)
    company = F.coalesce(F.nullif(_text("company"), F.lit("")), F.lit("company"))
    place = F.coalesce(F.concat(F.lit(" · "), F.nullif(_text("location"), F.lit(""))), F.lit(""))
    card = F.concat(_text("title"), F.lit(" at "), company, place, F.lit(LISTING_PLACEHOLDER_TAIL))
    return F.when((board == "indeed") & ~enough & (_text("title") != ""), card).otherwise(F.col("description"))


def prepared_columns(board: Column) -> dict[str, Column]:
    """Stand-in text for thin cards (always long enough to keep); the native id where the url has one."""
    return {
        "description": listing_description(board),
        "job_id": F.coalesce(stable_id(board, F.col("job_url")), F.col("job_id")),
    }


def prepare(df: DataFrame, hint: str = "") -> DataFrame:
    return df.withColumns(prepared_columns(board_of(df, hint)))


def first_missing_field(fields: list[str] = BOARD_REQUIRED_FIELDS) -> Column:
    """Name of the first required field that is null or empty; null when none is."""
    return F.coalesce(*[F.when(F.coalesce(F.col(f), F.lit("")) == "", F.lit(f)) for f in fields])


# --- incoming against stored -----------------------------------------------------


def _stored(name: str) -> Column:
    return F.col(f"stored.{name}")


def improves() -> Column:
    """The incoming row has a longer text, fills a blank field, or brings the first skills."""
    better = F.length(_text("description")) > F.length(_text(_stored("job_description")))
    for new, old in FIELD_PAIRS.items():
        better = better | (~is_blank(F.col(new)) & is_blank(_stored(old)))
    return better | (~is_blank_list(F.col("skills")) & is_blank_list(_stored("skills_required")))


def merged_columns() -> dict[str, Column]:
    """Incoming values unless blank; the longer text by trimmed length, ties to the incoming."""
    out = {
        new: F.when(is_blank(F.col(new)) & ~is_blank(_stored(old)), _stored(old)).otherwise(F.col(new))
        for new, old in FIELD_PAIRS.items()
    }
    old_text = _stored("job_description")
    out["description"] = F.when(
        F.length(_text(old_text)) > F.length(_text("description")), old_text
    ).otherwise(F.col("description"))
    out["skills"] = F.when(
        is_blank_list(F.col("skills")) & ~is_blank_list(_stored("skills_required")),
        _stored("skills_required"),
    ).otherwise(F.col("skills"))
    return out


def with_stored(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Left join the looked-up columns as a struct ``stored``; stored has one row per job_id."""
    right = stored.select(
        F.col("job_id").alias("_stored_id"), F.struct(*LOOKUP_COLUMNS).alias("stored")
    )
    return batch.join(right, F.col("job_id") == F.col("_stored_id"), "left").drop("_stored_id")


def reconcile(batch: DataFrame, stored: DataFrame, seen: DataFrame, *, interactive: bool = False) -> DataFrame:
    """Give every incoming row an ``action`` and its merged values.

    new        not stored; written as prepared
    merge      stored but not marked seen; prepared, then merged over the stored row
    backfill   stored and seen, and the row improves it; merged
    unchanged  stored and seen, nothing better; only touched
    skipped    not stored and seen, and too thin to keep

    A seen mark without a stored row counts as new.  ``interactive`` is the rule of
    single searches: a plain 50 characters on two boards, no stand-in text, no merge
    for stored rows without a mark.
    """
    # Only what the batch asks for is taken from the two keyed tables.  They meet first, so
    # that the batch, in which one posting may hold many rows, takes part in a single join
    # that can be split where it is skewed.
    asked = batch.select("job_id").distinct()
    marks = seen.select("job_id").join(asked, "job_id", "left_semi").withColumn("_seen", F.lit(True))
    known = stored_by_ids(stored, asked).join(marks, "job_id", "left").select(
        F.col("job_id").alias("_stored_id"), F.struct(*LOOKUP_COLUMNS).alias("stored"), "_seen"
    )
    joined = batch.join(known, F.col("job_id") == F.col("_stored_id"), "left").drop("_stored_id")
    already = F.col("_seen").isNotNull()
    board = board_of(batch)
    if interactive:
        keep = ~(board.isin("linkedin", "indeed") & (F.length(_text("description")) < FULL_TEXT_MIN))
        fresh = F.lit("new")
    else:
        keep = is_persistable(board)
        fresh = F.when(F.col("stored").isNotNull(), "merge").otherwise("new")
    action = (
        F.when(~already, F.when(keep, fresh).otherwise("skipped"))
        .when(improves(), "backfill")
        .otherwise("unchanged")
    )
    marked = joined.withColumn("action", action)
    if not interactive:
        written = F.col("action").isin("new", "merge")
        marked = marked.withColumns(
            {n: F.when(written, c).otherwise(F.col(n)) for n, c in prepared_columns(board).items()}
        )
    return _merge_where(marked, F.col("action").isin("merge", "backfill"), batch.columns)


def _merge_where(marked: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    merged = {
        name: F.when(condition, value).otherwise(F.col(name)) for name, value in merged_columns().items()
    }
    return marked.withColumns(merged).select(*columns, "action")


def merge_rows(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Merge every incoming row over its stored row, where there is one."""
    joined = with_stored(batch, stored)
    return _merge_where(
        joined.withColumn("action", F.lit("merge")), F.col("stored").isNotNull(), batch.columns
    ).drop("action")


# --- listing and detail ------------------------------------------------------------


def merge_listing_with_detail(listing: DataFrame, detail: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Left join on the posting; the detail's filled fields win, the longer text wins,
    the listing's url stays unless it is a login url.  Of several details of a key the first
    in ``order`` counts."""
    detail = top_per_group(detail, [key], order)
    shared = [c for c in detail.columns if c in listing.columns and c not in (key, "job_url", "description")]
    right = detail.select(F.col(key).alias("_key"), F.struct("*").alias("detail"))
    joined = listing.join(right, F.col(key) == F.col("_key"), "left")
    types = dict(listing.dtypes)
    out = {}
    for c in shared:
        value = F.col(f"detail.{c}")
        empty = F.coalesce(F.size(value), F.lit(0)) <= 0 if types[c].startswith("array") else F.coalesce(value, F.lit("")) == ""
        out[c] = F.when(empty, F.col(c)).otherwise(value)
    if "description" in listing.columns:
        own = F.coalesce(F.col("description"), F.lit(""))
        new = F.coalesce(F.col("detail.description"), F.lit(""))
        out["description"] = F.when(F.length(new) > F.length(own), new).otherwise(F.col("description"))
    if "job_url" in listing.columns and "job_url" in detail.columns:
        url = F.coalesce(F.col("job_url"), F.lit(""))
        low = F.lower(url)
        public = (url != "") & ~F.contains(low, F.lit("auth")) & ~F.contains(low, F.lit("login"))
        other = F.when(F.col("detail.job_url") != "", F.col("detail.job_url"))
        out["job_url"] = F.when(public, url).otherwise(F.coalesce(other, F.col("job_url")))
    return joined.withColumns(out).select(*listing.columns)


def fill_from_listing(detail: DataFrame, listing: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Keep the parsed detail; fill a missing title, company or location from the listing,
    and take the listing's text when it is longer.  Of several listings of a key the first
    in ``order`` counts."""
    listing = top_per_group(listing, [key], order)
    right = listing.select(F.col(key).alias("_key"), F.struct("*").alias("listing"))
    joined = detail.join(right, F.col(key) == F.col("_key"), "left")

    def filled(name: str, *also: str) -> Column:
        missing = F.coalesce(F.col(name), F.lit("")).isin("", *also)
        given = F.coalesce(F.col(f"listing.{name}"), F.lit("")) != ""
        return F.when(missing & given, F.col(f"listing.{name}")).otherwise(F.col(name))

    longer = F.length(_text("listing.description")) > F.length(_text("description"))
    return joined.withColumns(
        {
            "title": filled("title"),
            "company": filled("company", "Unknown"),
            "location": filled("location"),
            "description": F.when(longer, F.col("listing.description")).otherwise(F.col("description")),
        }
    ).select(*detail.columns)


# --- table rows ----------------------------------------------------------------------


def longest_per_key(df: DataFrame, key: str, text: str, order: list[Column]) -> DataFrame:
    """One row per key: the longest text, the earliest on ties."""
    length = F.length(F.coalesce(F.col(text), F.lit("")))
    return top_per_group(df, [key], [length.desc(), *order])


def raw_payload(df: DataFrame) -> Column:
    """The whole row but its html, as JSON with nulls written out."""
    return F.to_json(F.struct(*[c for c in df.columns if c != "raw_html"]), {"ignoreNullFields": "false"})


def job_records(postings: DataFrame, now: Column, *, with_posted_at: bool = False) -> DataFrame:
    """Enriched postings to stored rows: renames, defaults, one experience number, payload."""
    types = {f.name: f.dataType for f in JOBS.fields}

    def given(name: str, default: Column | None = None) -> Column:
        value = F.col(name) if name in postings.columns else F.lit(None)
        return value if default is None else F.coalesce(value, default)

    no_text = F.lit("")
    no_skills = F.array().cast("array<string>")
    parsed = given("experience_parsed").cast(types["experience_parsed"])
    values = {
        "job_id": given("job_id"),
        "job_title": given("title", no_text),
        "job_description": given("description", no_text),
        "skills_required": given("skills", no_skills),
        "experience_required": experience_years(parsed, given("experience_required").cast("string")),
        "education_required": given("education_required"),
        "job_type": given("employment_type", no_text),
        "location": given("location", no_text),
        "industry": given("industry"),
        "company": given("company", no_text),
        "url": given("job_url", no_text),
        "job_source": F.coalesce(
            F.when(given("job_source") != "", given("job_source")), given("board"), no_text
        ),
        "date_scrapped": given("date_scrapped", now),
        "posted_date": given("posted_date"),
        "posted_at": posted_at(given("posted_date").cast("string"), now) if with_posted_at else F.lit(None),
        "salary_raw": given("salary"),
        "salary_normalized": given("salary_normalized"),
        "description_sections": given("description_sections", F.create_map().cast("map<string,string>")),
        "skills_categorized": given("skills_categorized"),
        "experience_parsed": given("experience_parsed"),
        "enrichment_confidence": given("enrichment_confidence"),
        "enrichment_timestamp": given("enrichment_timestamp"),
        "raw_payload": raw_payload(postings),
    }
    return postings.select(*[values[n].cast(t).alias(n) for n, t in types.items()])


def evolve(jobs: DataFrame) -> DataFrame:
    """Add the nullable columns an older stored table lacks."""
    types = {f.name: f.dataType for f in JOBS.fields}
    missing = {c: F.lit(None).cast(types[c]) for c in ADDED_COLUMNS if c not in jobs.columns}
    return jobs.withColumns(missing)
