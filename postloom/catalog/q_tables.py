"""Queries that compare scraped rows with stored tables, and the tables' upkeep."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.catalog import sql as S
from postloom.catalog.fixtures import view, with_views
from postloom.catalog.q_text import (
    _PERSISTABLE,
    _STABLE,
    _STAND_IN,
    ENRICHED_CTES,
    NATIVE_KEY,
    POSTED,
    joined,
    now,
    posting_rows,
)
from postloom.catalog.registry import ORACLES, query
from postloom.operators import enrich as E
from postloom.operators import maintain, report, store
from postloom.operators import reconcile as R
from postloom.plans import search
from postloom.session import work_folder
from postloom.sources import keyed, tables, vocabulary
from postloom.sources.bucketed import bucketed
from postloom.sources.tables import merge_changes

STORED = ("stored_jobs",)
SEEN = ("processed_jobs",)


def stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "stored_jobs")
    listed = F.when(F.col("skills_csv") != "", F.split("skills_csv", ","))
    return rows.withColumn(
        "skills_required", F.coalesce(listed, F.array().cast("array<string>"))
    ).drop("skills_csv")


def seen_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "processed_jobs")


def cutoff():
    return F.lit("2026-09-24 00:00:00+00:00").cast("timestamp")


# --- look-ups and merges ------------------------------------------------------------

_LOOKUP = "job_id, job_description, company, location, url, job_title, job_type, salary_raw, posted_date, skills_csv"


@query(
    "stored_by_ids",
    with_views(f"SELECT {_LOOKUP} FROM stored_jobs WHERE job_id IN (SELECT job_id FROM postings)", *POSTED, *STORED),
)
def stored_by_ids(spark, sf_dir):
    found = tables.stored_by_ids(stored_rows(spark, sf_dir), posting_rows(spark, sf_dir))
    return found.withColumn("skills_csv", F.array_join("skills_required", ",")).drop("skills_required")


@query(
    "processed_ids",
    with_views("SELECT DISTINCT job_id FROM processed_jobs WHERE job_id IN (SELECT job_id FROM stored_jobs)", *SEEN, *STORED),
)
def processed_ids(spark, sf_dir):
    return tables.processed_ids(seen_rows(spark, sf_dir), stored_rows(spark, sf_dir))


@query("job_by_id", with_views("SELECT * FROM stored_jobs WHERE job_id = '12'", *STORED))
def job_by_id(spark, sf_dir):
    return tables.job_by_id(view(spark, sf_dir, "stored_jobs"), "12")


@query(
    "longest_per_key",
    with_views(
        """SELECT job_id, doc_id, title, length(description) AS n_chars FROM postings
        QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY length(description) DESC, doc_id) = 1""",
        *POSTED,
    ),
)
def longest_per_key(spark, sf_dir):
    rows = R.longest_per_key(posting_rows(spark, sf_dir), "job_id", "description", [F.col("doc_id")])
    return rows.select("job_id", "doc_id", "title", F.length("description").cast("bigint").alias("n_chars"))


_UPSERT_COLUMNS = ["job_id", "job_description", "company", "location", "url", "job_title", "salary_raw"]


@query(
    "upsert_jobs",
    with_views(
        """SELECT job_id, job_description, company, location, url, job_title, salary_raw FROM stored_jobs WHERE job_id NOT IN (SELECT job_id FROM postings)
        UNION ALL SELECT job_id, description, coalesce(company, ''), location, job_url, title, salary FROM postings
        QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY length(description) DESC, doc_id) = 1""",
        *POSTED,
        *STORED,
    ),
)
def upsert_jobs(spark, sf_dir):
    rows = posting_rows(spark, sf_dir).select(
        "job_id",
        F.col("description").alias("job_description"),
        F.coalesce("company", F.lit("")).alias("company"),
        "location",
        F.col("job_url").alias("url"),
        F.col("title").alias("job_title"),
        F.col("salary").alias("salary_raw"),
        "doc_id",
    )
    return tables.upsert(stored_rows(spark, sf_dir).select(_UPSERT_COLUMNS), rows, [F.col("doc_id")])


@query(
    "touch_jobs",
    with_views(
        f"""SELECT job_id, max(processed_at) AS processed_at FROM (
          SELECT job_id, processed_at FROM processed_jobs UNION ALL SELECT job_id, {S.NOW} FROM postings) s GROUP BY job_id""",
        *POSTED,
        *SEEN,
    ),
)
def touch_jobs(spark, sf_dir):
    return tables.touch(seen_rows(spark, sf_dir), posting_rows(spark, sf_dir), now())


@query(
    "error_log",
    with_views(
        """SELECT 'https://' || board || '/' || CAST(event_id AS VARCHAR) AS url, outcome AS error_message, CAST(user_id % 3 AS INTEGER) AS retries, ts AS "timestamp"
        FROM fetch_log WHERE outcome <> 'ok'""",
        "fetch_log",
    ),
)
def error_log(spark, sf_dir):
    failed = view(spark, sf_dir, "fetch_log").filter(F.col("outcome") != "ok")
    url = F.concat(F.lit("https://"), "board", F.lit("/"), F.col("event_id").cast("string"))
    return tables.error_rows(failed, url, F.col("outcome"), F.col("user_id") % 3, F.col("ts").cast("timestamp"))


@query(
    "schema_evolve",
    with_views(
        """SELECT job_id, job_description, job_title, url, posted_date, salary_raw, posted_at, CAST(NULL AS DOUBLE) AS enrichment_confidence,
        CAST(NULL AS TIMESTAMP) AS enrichment_timestamp, CAST(NULL AS VARCHAR) AS raw_payload FROM stored_jobs""",
        *STORED,
    ),
)
def schema_evolve(spark, sf_dir):
    old = view(spark, sf_dir, "stored_jobs").select("job_id", "job_description", "job_title", "url", "posted_date", "salary_raw", "posted_at")
    return R.evolve(old).drop("salary_normalized", "description_sections", "skills_categorized", "experience_parsed")


_PAYLOAD = ["job_id", "title", "company", "location", "salary", "posted_date"]


@query(
    "raw_payload",
    with_views(
        "SELECT doc_id, '{' || "
        + " || ',' || ".join(f"""'"{c}":' || CASE WHEN {c} IS NULL THEN 'null' ELSE to_json({c})::VARCHAR END""" for c in _PAYLOAD)
        + " || '}' AS payload FROM postings",
        *POSTED,
    ),
)
def raw_payload(spark, sf_dir):
    rows = posting_rows(spark, sf_dir)
    slim = rows.select("doc_id", *_PAYLOAD).withColumn("raw_html", F.lit("<html>"))
    return slim.select("doc_id", R.raw_payload(slim.drop("doc_id")).alias("payload"))



@query(
    "job_records",
    with_views(
        f"""SELECT job_id, title AS job_title, full_text AS job_description, array_to_string(skill_set, '|') AS skills,
          CAST(CASE WHEN coalesce(raw_text, '') <> '' OR level <> 'unknown' THEN min_years ELSE try_cast(nullif(regexp_extract(coalesce(experience_required, ''), '[0-9]+'), '') AS BIGINT) END AS INTEGER) AS experience_required,
          education AS education_required, job_type, coalesce(location, '') AS location, CAST(NULL AS VARCHAR) AS industry, coalesce(company, '') AS company,
          job_url AS url, board AS job_source, {S.NOW} AS date_scrapped, posted_date, {S.POSTED_CASES} AS posted_at, salary AS salary_raw,
          confidence AS enrichment_confidence, doc_id
        FROM enriched""",
        *POSTED,
        **ENRICHED_CTES,
    ),
)
def job_records(spark, sf_dir):
    enriched = E.enrich(posting_rows(spark, sf_dir), S.VOCABULARY, now())
    records = R.job_records(enriched, now(), with_posted_at=True)
    return records.select(
        "job_id", "job_title", "job_description", joined(F.col("skills_required")).alias("skills"),
        "experience_required", "education_required", "job_type", "location", "industry", "company", "url",
        "job_source", "date_scrapped", "posted_date", "posted_at", "salary_raw", "enrichment_confidence",
        F.get_json_object("raw_payload", "$.doc_id").cast("bigint").alias("doc_id"),
    )


# --- reconcile ------------------------------------------------------------------------

_PAIRS = [("company", "company"), ("location", "location"), ("job_url", "url"), ("title", "job_title"), ("employment_type", "job_type"), ("salary", "salary_raw"), ("posted_date", "posted_date")]
_IMPROVES = (
    f"(length({S.text('p.description')}) > length({S.text('s.job_description')})"
    + "".join(f" OR (NOT {S.blank('p.' + a)} AND {S.blank('s.' + b)})" for a, b in _PAIRS)
    + " OR (p.skills_csv <> '' AND s.skills_csv = ''))"
)
_HAS_STORED = "s.job_id IS NOT NULL"


def _qualify(expression: str) -> str:
    """Prefix the incoming columns of a rule with their table alias."""
    return re.sub(r"(?<![\w.'])(description|board|title|job_url|company|location)(?![\w'])", r"p.\1", expression)


_ACTION = f"""CASE WHEN NOT ({_HAS_STORED} AND m.job_id IS NOT NULL)
    THEN CASE WHEN {_qualify(_PERSISTABLE)} THEN CASE WHEN {_HAS_STORED} THEN 'merge' ELSE 'new' END ELSE 'skipped' END
    WHEN {_IMPROVES} THEN 'backfill' ELSE 'unchanged' END"""
_JOINED = """FROM postings p LEFT JOIN stored_jobs s ON p.job_id = s.job_id
  LEFT JOIN (SELECT DISTINCT job_id FROM processed_jobs) m ON p.job_id = m.job_id"""
_MERGED = ", ".join(
    f"CASE WHEN {_HAS_STORED} AND DOIT AND {S.blank('p.' + a)} AND NOT {S.blank('s.' + b)} THEN s.{b} ELSE p.{a} END AS {a}" for a, b in _PAIRS
)
_MERGED_TEXT = f"""CASE WHEN {_HAS_STORED} AND DOIT AND length({S.text('s.job_description')}) > length({S.text('TXT')}) THEN s.job_description ELSE TXT END AS description,
  CASE WHEN {_HAS_STORED} AND DOIT AND p.skills_csv = '' AND s.skills_csv <> '' THEN s.skills_csv ELSE p.skills_csv END AS skills"""
_RECONCILED = f"""SELECT doc_id, CASE WHEN action IN ('new', 'merge') THEN coalesce({_STABLE}, job_id) ELSE job_id END AS job_id, action, company, location, job_url, title, employment_type, salary, posted_date, description, skills
  FROM (SELECT p.doc_id, p.job_id, p.board, a.action, {_qualify(NATIVE_KEY)} AS nk, {_MERGED.replace('DOIT', "a.action IN ('merge', 'backfill')")},
    {_MERGED_TEXT.replace('DOIT', "a.action IN ('merge', 'backfill')").replace('TXT', "(CASE WHEN a.action IN ('new', 'merge') THEN " + _qualify(_STAND_IN) + " ELSE p.description END)")}
    {_JOINED} JOIN (SELECT p.doc_id, {_ACTION} AS action {_JOINED}) a ON a.doc_id = p.doc_id) r"""
ALL3 = (*POSTED, *STORED, *SEEN)


def reconciled(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return R.reconcile(posting_rows(spark, sf_dir), stored_rows(spark, sf_dir), seen_rows(spark, sf_dir), **how)


@query("reconcile", with_views(_RECONCILED, *ALL3))
def reconcile(spark, sf_dir):
    out = reconciled(spark, sf_dir)
    names = ["doc_id", "job_id", "action", "company", "location", "job_url", "title", "employment_type", "salary", "posted_date", "description"]
    return out.select(*names, F.array_join("skills", ",").alias("skills"))


@query(
    "reconcile_interactive",
    with_views(
        f"""SELECT p.doc_id, CASE WHEN NOT ({_HAS_STORED} AND m.job_id IS NOT NULL)
          THEN CASE WHEN p.board IN ('linkedin', 'indeed') AND length({S.text('p.description')}) < 50 THEN 'skipped' ELSE 'new' END
          WHEN {_IMPROVES} THEN 'backfill' ELSE 'unchanged' END AS action {_JOINED}""",
        *ALL3,
    ),
)
def reconcile_interactive(spark, sf_dir):
    return reconciled(spark, sf_dir, interactive=True).select("doc_id", "action")


@query("reconcile_counts", with_views("SELECT action, count(*) AS n FROM r GROUP BY action", *ALL3, r=_RECONCILED))
def reconcile_counts(spark, sf_dir):
    return report.counts_by(reconciled(spark, sf_dir), "action")


@query(
    "run_totals",
    with_views(
        """SELECT count(*) AS scraped, count(*) FILTER (WHERE action IN ('new', 'merge', 'backfill')) AS enriched,
        count(DISTINCT CASE WHEN action IN ('new', 'merge', 'backfill') THEN job_id END) AS upserted,
        count(*) FILTER (WHERE action = 'unchanged') AS duplicates, count(*) FILTER (WHERE action = 'skipped') AS skipped FROM r""",
        *ALL3,
        r=_RECONCILED,
    ),
)
def run_totals(spark, sf_dir):
    return report.run_totals(reconciled(spark, sf_dir))


@query(
    "run_totals_live",
    with_views(
        """SELECT count(*) AS scraped, count(*) FILTER (WHERE action IN ('new', 'merge', 'backfill')) AS enriched,
        count(DISTINCT CASE WHEN action IN ('new', 'merge', 'backfill') THEN job_id END) AS upserted,
        count(*) FILTER (WHERE action = 'unchanged') AS duplicates, count(*) FILTER (WHERE action = 'skipped') AS skipped FROM r""",
        *ALL3,
        r=_RECONCILED,
    ),
)
def run_totals_live(spark, sf_dir):
    """Counted while the rows of a run are written, and while its changes are."""
    folder = work_folder(spark, "run")
    rows, totals = report.live_totals(reconciled(spark, sf_dir))
    rows.write.parquet(f"{folder}/rows")
    written = spark.read.parquet(f"{folder}/rows").filter(F.col("action").isin("new", "merge", "backfill") & F.col("job_id").isNotNull())
    changes, upserts = report.live_upserts(R.longest_per_key(written, "job_id", "description", [F.col("doc_id")]))
    changes.write.parquet(f"{folder}/changes")
    return spark.createDataFrame([{**totals.get, **upserts.get}])


@query(
    "improves",
    with_views(f"SELECT p.doc_id, CASE WHEN {_HAS_STORED} THEN {_IMPROVES} ELSE TRUE END AS improves FROM postings p LEFT JOIN stored_jobs s ON p.job_id = s.job_id", *POSTED, *STORED),
)
def improves(spark, sf_dir):
    pairs = R.with_stored(posting_rows(spark, sf_dir), stored_rows(spark, sf_dir))
    return pairs.select("doc_id", (F.col("stored").isNull() | R.improves()).alias("improves"))


@query(
    "merge_rows",
    with_views(
        f"""SELECT p.doc_id, p.job_id, {_MERGED.replace('DOIT', 'TRUE')}, {_MERGED_TEXT.replace('DOIT', 'TRUE').replace('TXT', 'p.description')}
        FROM postings p LEFT JOIN stored_jobs s ON p.job_id = s.job_id""",
        *POSTED,
        *STORED,
    ),
)
def merge_rows(spark, sf_dir):
    out = R.merge_rows(posting_rows(spark, sf_dir), stored_rows(spark, sf_dir))
    names = ["doc_id", "job_id", "company", "location", "job_url", "title", "employment_type", "salary", "posted_date", "description"]
    return out.select(*names, F.array_join("skills", ",").alias("skills"))


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows in the shape of parsed detail pages."""
    return stored_rows(spark, sf_dir).select(
        "job_id",
        F.col("job_title").alias("title"),
        "company",
        "location",
        F.col("url").alias("job_url"),
        F.col("job_description").alias("description"),
    )


def twice(rows: DataFrame) -> DataFrame:
    """Every row and a later, worse copy of it, which must not count."""
    return rows.withColumn("copy", F.lit(0)).unionByName(rows.withColumns({"title": F.lit("worse"), "company": F.lit("worse"), "copy": F.lit(1)}))


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.when(F.col("doc_id") % 10 == 3, F.concat(F.lit("https://secure.indeed.com/auth?x="), "job_id")).otherwise(
        F.col("job_url")
    )
    return posting_rows(spark, sf_dir).withColumn("job_url", url)


_LISTINGS = "SELECT * REPLACE (CASE WHEN doc_id % 10 = 3 THEN 'https://secure.indeed.com/auth?x=' || job_id ELSE job_url END AS job_url) FROM postings"


@query(
    "listing_detail",
    with_views(
        """SELECT l.doc_id, CASE WHEN coalesce(d.job_title, '') = '' THEN l.title ELSE d.job_title END AS title,
          CASE WHEN coalesce(d.company, '') = '' THEN l.company ELSE d.company END AS company,
          CASE WHEN coalesce(d.location, '') = '' THEN l.location ELSE d.location END AS location,
          CASE WHEN length(coalesce(d.job_description, '')) > length(coalesce(l.description, '')) THEN d.job_description ELSE l.description END AS description,
          CASE WHEN NOT contains(lower(l.job_url), 'auth') AND NOT contains(lower(l.job_url), 'login') THEN l.job_url WHEN coalesce(d.url, '') <> '' THEN d.url ELSE l.job_url END AS job_url
        FROM listings l LEFT JOIN stored_jobs d ON l.job_id = d.job_id""",
        *POSTED,
        *STORED,
        listings=_LISTINGS,
    ),
)
def listing_detail(spark, sf_dir):
    out = R.merge_listing_with_detail(_listings(spark, sf_dir), twice(details(spark, sf_dir)), "job_id", [F.col("copy")])
    return out.select("doc_id", "title", "company", "location", "description", "job_url")


@query(
    "fill_from_listing",
    with_views(
        f"""SELECT p.doc_id, CASE WHEN coalesce(p.title, '') = '' AND coalesce(s.job_title, '') <> '' THEN s.job_title ELSE p.title END AS title,
          CASE WHEN coalesce(p.company, '') IN ('', 'Unknown') AND coalesce(s.company, '') <> '' THEN s.company ELSE p.company END AS company,
          CASE WHEN coalesce(p.location, '') = '' AND coalesce(s.location, '') <> '' THEN s.location ELSE p.location END AS location,
          CASE WHEN length({S.text('s.job_description')}) > length({S.text('p.description')}) THEN s.job_description ELSE p.description END AS description
        FROM postings p LEFT JOIN stored_jobs s ON p.job_id = s.job_id""",
        *POSTED,
        *STORED,
    ),
)
def fill_from_listing(spark, sf_dir):
    out = R.fill_from_listing(posting_rows(spark, sf_dir), twice(details(spark, sf_dir)), "job_id", [F.col("copy")])
    return out.select("doc_id", "title", "company", "location", "description")


# --- upkeep -------------------------------------------------------------------------------


@query("orphans", with_views("SELECT job_id, processed_at FROM processed_jobs WHERE job_id NOT IN (SELECT job_id FROM stored_jobs)", *STORED, *SEEN))
def orphans(spark, sf_dir):
    return maintain.orphan_marks(seen_rows(spark, sf_dir), stored_rows(spark, sf_dir)).select("job_id", "processed_at")


_STALE = f"""SELECT job_id, date_scrapped FROM stored_jobs WHERE date_scrapped < {S.CUTOFF}
  AND job_id NOT IN (SELECT job_id FROM processed_jobs WHERE processed_at >= {S.CUTOFF})"""


@query("stale_jobs", with_views(_STALE, *STORED, *SEEN))
def stale_jobs(spark, sf_dir):
    return maintain.stale_jobs(stored_rows(spark, sf_dir), seen_rows(spark, sf_dir), cutoff()).select("job_id", "date_scrapped")


@query("stale_jobs_bucketed", with_views(_STALE, *STORED, *SEEN))
def stale_jobs_bucketed(spark, sf_dir):
    """Both tables in the same buckets: no exchange between them."""
    jobs, seen = _in_buckets(spark, sf_dir)
    return maintain.stale_jobs(jobs, seen, cutoff()).select("job_id", "date_scrapped")


@query("orphans_bucketed", ORACLES["orphans"])
def orphans_bucketed(spark, sf_dir):
    jobs, seen = _in_buckets(spark, sf_dir)
    return maintain.orphan_marks(seen, jobs).select("job_id", "processed_at")


def _in_buckets(spark, sf_dir):
    jobs = stored_rows(spark, sf_dir).select("job_id", "date_scrapped")
    return [bucketed(df, name, key="job_id", buckets=8) for df, name in ((jobs, "jobs"), (seen_rows(spark, sf_dir), "marks"))]


@query(
    "stale_markers",
    with_views(
        f"SELECT job_id, processed_at FROM processed_jobs WHERE processed_at < {S.CUTOFF} OR job_id IN (SELECT job_id FROM stale)",
        *STORED,
        *SEEN,
        stale=_STALE,
    ),
)
def stale_markers(spark, sf_dir):
    return maintain.stale_marks(seen_rows(spark, sf_dir), stored_rows(spark, sf_dir), cutoff())


# Scraped rows stored under one id per row, so that re-keying has something to merge.
_OLD_ROWS = f"SELECT CAST(doc_id AS VARCHAR) AS job_id, board, job_url, description, {NATIVE_KEY} AS nk FROM postings"
_PLAN = f"""SELECT job_id, new_id, has_native_id, CASE WHEN rn > 1 THEN 'delete' WHEN job_id <> new_id THEN 'rename' ELSE 'keep' END AS action
  FROM (SELECT *, row_number() OVER (PARTITION BY new_id ORDER BY length(coalesce(description, '')) DESC, job_id) AS rn
    FROM (SELECT *, coalesce({_STABLE}, job_id) AS new_id, nk IS NOT NULL AS has_native_id FROM old_rows) a) b"""
_REKEY = {"old_rows": _OLD_ROWS, "plan": _PLAN}


def _old_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_rows(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("job_id"),
        F.col("job_url").alias("url"),
        F.col("board").alias("job_source"),
        F.col("description").alias("job_description"),
    )


@query("rekey_plan", with_views("SELECT * FROM plan", *POSTED, **_REKEY))
def rekey_plan(spark, sf_dir):
    return maintain.rekey_plan(_old_rows(spark, sf_dir))


@query(
    "rekey_summary",
    with_views(
        """SELECT count(*) AS rows, count(*) FILTER (WHERE action = 'rename') AS renamed, count(*) FILTER (WHERE action = 'delete') AS deleted,
        count(*) FILTER (WHERE NOT has_native_id) AS without_native_id FROM plan""",
        *POSTED,
        **_REKEY,
    ),
)
def rekey_summary(spark, sf_dir):
    return maintain.rekey_summary(maintain.rekey_plan(_old_rows(spark, sf_dir)))


@query(
    "rekey_apply",
    with_views(
        "SELECT p.new_id AS job_id, o.job_url AS url, o.description AS job_description FROM old_rows o JOIN plan p ON o.job_id = p.job_id WHERE p.action <> 'delete'",
        *POSTED,
        **_REKEY,
    ),
)
def rekey_apply(spark, sf_dir):
    jobs = _old_rows(spark, sf_dir)
    return maintain.apply_rekey(jobs, maintain.rekey_plan(jobs)).select("job_id", "url", "job_description")


@query(
    "rekey_markers",
    with_views(
        f"""SELECT job_id, processed_at FROM processed_jobs WHERE job_id NOT IN (SELECT job_id FROM plan WHERE action <> 'keep')
        UNION ALL SELECT new_id, {S.NOW} FROM plan WHERE action = 'rename'""",
        *POSTED,
        *SEEN,
        **_REKEY,
    ),
)
def rekey_markers(spark, sf_dir):
    plan = maintain.rekey_plan(_old_rows(spark, sf_dir))
    return maintain.apply_rekey_to_marks(seen_rows(spark, sf_dir), plan, now())


_CHROME = rf"""trim(regexp_replace(regexp_replace(regexp_replace(description, '(?is)\bshow more{S.SPACE}+show less\b.*$', ''),
  '(?is)\bSeniority level\b.{{0,200}}?\bEmployment type\b.*$', ''), '(?i)(?:{S.SPACE}*\b(?:show|see) (?:more|less)\b[.…]*)+{S.SPACE}*$', ''), {S.SPACES})"""


@query(
    "cleanup_plan",
    with_views(
        f"SELECT job_id, before, after FROM (SELECT CAST(doc_id AS VARCHAR) AS job_id, description AS before, {_CHROME} AS after FROM postings WHERE board = 'mustakbil') s WHERE after <> '' AND after <> before",
        *POSTED,
    ),
)
def cleanup_plan(spark, sf_dir):
    # The planted furniture sits in the rows of one other board.
    return maintain.cleanup_plan(_old_rows(spark, sf_dir), source="mustakbil")


@query(
    "cleanup_apply",
    with_views(
        f"SELECT CAST(doc_id AS VARCHAR) AS job_id, CASE WHEN board = 'mustakbil' AND {_CHROME} <> '' THEN {_CHROME} ELSE description END AS job_description FROM postings",
        *POSTED,
    ),
)
def cleanup_apply(spark, sf_dir):
    jobs = _old_rows(spark, sf_dir)
    return maintain.apply_cleanup(jobs, maintain.cleanup_plan(jobs, source="mustakbil")).select("job_id", "job_description")


# --- vocabulary, unions, reports --------------------------------------------------------------


@query(
    "skill_vocabulary",
    with_views(
        f"""SELECT skill, row, col FROM (SELECT trim(skill) AS skill, row, col, row_number() OVER (PARTITION BY lower(trim(skill)) ORDER BY row, col) AS rn
          FROM (SELECT p_partkey AS row, CAST(c.col AS INTEGER) AS col, CASE c.col WHEN 0 THEN ' ' || split_part(p_name, ' ', 1) || ' ' WHEN 1 THEN upper(split_part(p_name, ' ', 2)) WHEN 2 THEN CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END ELSE lower(p_brand) END AS skill
            FROM part, (SELECT unnest([0, 1, 2, 3]) AS col) c) g WHERE trim(coalesce(skill, '')) <> '') r WHERE rn = 1""",
    ),
)
def skill_vocabulary(spark, sf_dir):
    """A grid of one role and four skills per row, made of the part table."""
    grid = view(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("role"),
        F.expr("' ' || split_part(p_name, ' ', 1) || ' '").alias("s1"),
        F.expr("upper(split_part(p_name, ' ', 2))").alias("s2"),
        F.expr("CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END").alias("s3"),
        F.lower("p_brand").alias("s4"),
    )
    return vocabulary.skill_vocabulary(grid, F.col("role"))


@query(
    "union_boards",
    with_views(
        "SELECT doc_id, board, 0 AS part FROM postings WHERE board = 'rozee' UNION ALL SELECT doc_id, board, 1 FROM postings WHERE board = 'mustakbil' UNION ALL SELECT doc_id, board, 2 FROM postings WHERE board = 'indeed' UNION ALL SELECT doc_id, board, 3 FROM postings WHERE board = 'linkedin'",
        *POSTED,
    ),
)
def union_boards(spark, sf_dir):
    rows = posting_rows(spark, sf_dir)
    boards = ["rozee", "mustakbil", "indeed", "linkedin"]
    parts = [rows.filter(F.col("board") == b).select("doc_id", "board", F.lit(i).alias("part")) for i, b in enumerate(boards)]
    return search.union_boards(parts)


@query("board_counts", with_views("SELECT board, count(*) AS n FROM r WHERE action IN ('new', 'merge', 'backfill') GROUP BY board", *ALL3, r=_RECONCILED.replace("SELECT doc_id, CASE", "SELECT board, doc_id, CASE", 1)))
def board_counts(spark, sf_dir):
    written = reconciled(spark, sf_dir).filter(F.col("action").isin("new", "merge", "backfill"))
    return report.counts_by(written, "board")


@query(
    "board_quality",
    with_views(
        f"""SELECT board, jobs, with_text, long_text, CASE WHEN NOT ok THEN 'FAIL' WHEN jobs > 0 THEN 'PASS' ELSE 'EMPTY' END AS status, samples FROM (
          SELECT a.board, a.ok, coalesce(p.jobs, 0) AS jobs, coalesce(p.with_text, 0) AS with_text, coalesce(p.long_text, 0) AS long_text, p.samples FROM
            (SELECT board, bool_or(outcome = 'ok' AND elapsed_s < 1000) AS ok FROM fetch_log GROUP BY board) a LEFT JOIN
            (SELECT board, count(*) AS jobs, count(*) FILTER (WHERE {S.text('description')} <> '') AS with_text, count(*) FILTER (WHERE length(description) >= 80) AS long_text,
              array_to_string(list(title ORDER BY doc_id)[1:3], ';') AS samples FROM postings GROUP BY board) p ON a.board = p.board) q""",
        *POSTED,
        "fetch_log",
    ),
)
def board_quality(spark, sf_dir):
    log = view(spark, sf_dir, "fetch_log")
    attempts = log.select("board", ((F.col("outcome") == "ok") & (F.col("elapsed_s") < 1000)).alias("ok"))
    out = report.board_quality(posting_rows(spark, sf_dir), attempts, [F.col("doc_id")])
    return out.withColumn("samples", F.array_join("samples", ";"))


@query(
    "enrichment_stats",
    with_views(
        """SELECT count(*) AS total, round(avg(confidence), 9) AS average, count(*) FILTER (WHERE confidence >= 0.7) AS high,
        count(*) FILTER (WHERE confidence >= 0.5 AND confidence < 0.7) AS medium, count(*) FILTER (WHERE confidence < 0.5) AS low FROM enriched""",
        *POSTED,
        **ENRICHED_CTES,
    ),
)
def enrichment_stats(spark, sf_dir):
    enriched = E.enrich(posting_rows(spark, sf_dir), S.VOCABULARY, now())
    return report.enrichment_stats(enriched).withColumn("average", F.round("average", 9))


# --- merges -------------------------------------------------------------------------------

_MERGED = """SELECT coalesce(c.job_id, s.job_id) AS job_id, CASE WHEN c.job_id IS NULL THEN s.title ELSE c.title END AS title, s.company, c.batch_no FROM kept s FULL JOIN changes c ON s.job_id = c.job_id"""
_STORED_ROWS = "SELECT job_id, job_title AS title, company FROM stored_jobs"
_CHANGES = "SELECT CAST(doc_id AS VARCHAR(20)) AS job_id, 'changed' AS title, doc_id AS batch_no FROM documents"


def _changes(spark, sf_dir):
    docs = view(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").cast("string").alias("job_id"), F.lit("changed").alias("title"), F.col("doc_id").alias("batch_no"))


def _current(spark, sf_dir):
    return stored_rows(spark, sf_dir).select("job_id", F.col("job_title").alias("title"), "company")


@query("merge_narrow", with_views(_MERGED, *STORED, kept=_STORED_ROWS, changes=_CHANGES))
def merge_narrow(spark, sf_dir):
    """Changes without a column keep what is stored; a new column is added."""
    return merge_changes(_current(spark, sf_dir), _changes(spark, sf_dir), "job_id")


@query(
    "merge_with_deletes",
    with_views(_MERGED, *STORED, kept=f"SELECT * FROM ({_STORED_ROWS}) r WHERE job_id NOT IN (SELECT CAST(doc_id AS VARCHAR(20)) FROM documents WHERE doc_id % 3 = 0)", changes=_CHANGES),
)
def merge_with_deletes(spark, sf_dir):
    """Deletes first; null keys among them delete nothing, a change of a deleted key is a new row."""
    docs = view(spark, sf_dir, "documents")
    gone = docs.select(F.when(F.col("doc_id") % 3 == 0, F.col("doc_id").cast("string")).alias("job_id"))
    return merge_changes(_current(spark, sf_dir), _changes(spark, sf_dir), "job_id", gone)


@query(
    "keyed_merge",
    with_views(
        "SELECT m.* FROM m",
        *STORED,
        kept=f"SELECT * FROM ({_STORED_ROWS}) r WHERE job_id NOT IN (SELECT CAST(doc_id AS VARCHAR(20)) FROM documents WHERE doc_id % 3 = 0)",
        changes=_CHANGES,
        m=_MERGED,
    ),
)
def keyed_merge(spark, sf_dir):
    """As ``merge_with_deletes``, over a keyed table in files: created, merged into, and merged into again by a batch it has."""
    path = work_folder(spark, "keyed-merge")
    keyed.create_table(_current(spark, sf_dir), path, buckets=8)
    gone = view(spark, sf_dir, "documents").filter(F.col("doc_id") % 3 == 0).select(F.col("doc_id").cast("string").alias("job_id"))
    keyed.upsert_into(path, _changes(spark, sf_dir), delete=gone, batch=("scrape", 0))
    keyed.upsert_into(path, _changes(spark, sf_dir).withColumn("title", F.lit("again")), batch=("scrape", 0))
    return keyed.read_keyed(spark, path)


@query("keyed_lookup", with_views("SELECT job_id, title, company FROM r WHERE job_id IN (SELECT job_id FROM postings)", *POSTED, *STORED, r=_STORED_ROWS))
def keyed_lookup(spark, sf_dir):
    """The stored rows of a batch's ids, from their buckets alone."""
    path = work_folder(spark, "keyed-lookup")
    keyed.create_table(_current(spark, sf_dir), path, buckets=8)
    return keyed.rows_of(spark, path, posting_rows(spark, sf_dir))


@query(
    "store_batch",
    with_views(
        f"""SELECT job_id, job_title, url FROM stored_jobs
        UNION ALL SELECT job_id, title, job_url FROM (
          SELECT coalesce({_STABLE}, job_id) AS job_id, title, job_url, doc_id, description FROM (
            SELECT doc_id, CASE WHEN doc_id % 10 = 7 THEN NULL ELSE 'n' || job_id END AS job_id, board, title, job_url, CASE WHEN job_url <> '' THEN {NATIVE_KEY} END AS nk, {_STAND_IN} AS description
            FROM (SELECT * REPLACE (CASE WHEN doc_id % 10 = 7 THEN '' ELSE job_url END AS job_url) FROM postings) p WHERE {_PERSISTABLE}) a) b
        WHERE job_id <> '' QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY length(description) DESC, doc_id) = 1""",
        *POSTED,
        *STORED,
    ),
)
def store_batch(spark, sf_dir):
    """The stored table after a batch of new postings; a tenth of them has neither an id nor a url to make one of."""
    lost = F.col("doc_id") % 10 == 7
    rows = posting_rows(spark, sf_dir)
    batch = rows.withColumns({"job_id": F.when(~lost, F.concat(F.lit("n"), "job_id")), "job_url": F.when(~lost, F.col("job_url")).otherwise("")})
    stored = stored_rows(spark, sf_dir)
    out = store.store_batch(batch, stored, seen_rows(spark, sf_dir), ["Python", "SQL"], now(), [F.col("doc_id")])
    return out.select("job_id", "job_title", "url")
