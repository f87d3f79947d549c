"""Queries over scraped texts: rules, rewrites, keys, fields, enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.catalog import sql as S
from postloom.catalog.fixtures import view, with_views
from postloom.catalog.registry import query
from postloom.fixed_values import REQUIRED_FIELDS
from postloom.functions import dates, fields, skills, text, urls
from postloom.operators import enrich as E
from postloom.operators import reconcile as R
from postloom.plans import search


def now() -> Column:
    """The fixed time every query takes as the present."""
    return F.lit("2026-10-02 12:00:00+00:00").cast("timestamp")


def posting_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped rows with their skills as an array."""
    rows = view(spark, sf_dir, "postings")
    listed = F.when(F.col("skills_csv") != "", F.split("skills_csv", ","))
    rows = rows.withColumn("skills", F.coalesce(listed, F.array().cast("array<string>"))).drop("skills_csv")
    return rows


def joined(items: Column) -> Column:
    return F.array_join(F.array_sort(items), "|")


POSTED = ("raw_postings", "postings")

# --- predicates -------------------------------------------------------------------

_SIZE = f"length({S.text('description')})"
_PERSISTABLE = f"""CASE WHEN {_SIZE} >= 50 THEN TRUE
  WHEN board = 'indeed' THEN {_SIZE} >= 20 OR ({S.text('title')} <> '' AND {S.text('job_url')} <> '' AND lower({S.text('company')}) NOT IN ('', 'unknown'))
  WHEN board = 'linkedin' THEN FALSE
  ELSE {_SIZE} > 0 OR {S.text('title')} <> '' END"""


@query("persistable", with_views(f"SELECT doc_id, {_PERSISTABLE} AS persistable FROM postings", *POSTED))
def persistable(spark, sf_dir):
    df = posting_rows(spark, sf_dir)
    return df.select("doc_id", R.is_persistable(R.board_of(df)).alias("persistable"))


def _missing_sql(names: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN coalesce({n}, '') = '' THEN '{n}'" for n in names) + " END"


@query(
    "missing_field_report",
    with_views(
        f"""SELECT board, {_missing_sql(REQUIRED_FIELDS)} AS missing, {_missing_sql(REQUIRED_FIELDS[:4])} AS board_missing,
        count(*) AS n FROM postings GROUP BY ALL""",
        *POSTED,
    ),
)
def missing_field_report(spark, sf_dir):
    df = posting_rows(spark, sf_dir).select(
        "board",
        R.first_missing_field(REQUIRED_FIELDS).alias("missing"),
        R.first_missing_field().alias("board_missing"),
    )
    return df.groupBy("board", "missing", "board_missing").agg(F.count("*").alias("n"))


_WALL = ["secure.indeed.com/auth", "from=bot-detection", "account/login", "/authwall", "/checkpoint/challenge", "linkedin.com/login", "linkedin.com/uas/login", "linkedin.com/signup"]
_DETAIL = ["/viewjob", "/jobs/view/", "/jobs/job/", "jk="]


@query(
    "detail_urls",
    with_views(
        f"SELECT doc_id, {S.any_of('lower(job_url)', _DETAIL)} AND NOT {S.any_of('lower(job_url)', _WALL)} AS is_detail FROM postings",
        *POSTED,
    ),
)
def detail_urls(spark, sf_dir):
    return posting_rows(spark, sf_dir).select("doc_id", urls.is_detail_url(F.col("job_url")).alias("is_detail"))


@query(
    "truncated",
    with_views(
        rf"""SELECT doc_id, regexp_matches(right(t, 160), '(?i)(?:\.\.\.|…)\s*(?:see|show)\s+more\b|\b(?:see|show)\s+more\s*$')
        OR (length(t) < 600 AND {S.any_of('lower(t)', ['see more', 'show more'])}) AS truncated
        FROM (SELECT doc_id, {S.text("description || CASE doc_id % 3 WHEN 0 THEN '... See more' WHEN 1 THEN '' ELSE ' show  more ' END")} AS t FROM postings) s""",
        *POSTED,
    ),
)
def truncated(spark, sf_dir):
    tail = F.when(F.col("doc_id") % 3 == 0, "... See more").when(F.col("doc_id") % 3 == 1, "").otherwise(" show  more ")
    return posting_rows(spark, sf_dir).select(
        "doc_id", text.looks_truncated(F.concat("description", tail)).alias("truncated")
    )


_PROFILED = ["title", "company", "location", "salary", "employment_type", "posted_date"]


@query(
    "blank_profile",
    with_views(
        "SELECT board, "
        + ", ".join(f"count(*) FILTER (WHERE {S.blank(c)}) AS blank_{c}" for c in _PROFILED)
        + ", count(*) FILTER (WHERE skills_csv = '') AS blank_skills FROM postings GROUP BY board",
        *POSTED,
    ),
)
def blank_profile(spark, sf_dir):
    return posting_rows(spark, sf_dir).groupBy("board").agg(
        *[F.count_if(fields.is_blank(F.col(c))).alias(f"blank_{c}") for c in _PROFILED],
        F.count_if(fields.is_blank_list(F.col("skills"))).alias("blank_skills"),
    )


@query(
    "title_query_overlap",
    with_views(
        f"""SELECT doc_id, q, q = '' OR list_has_any(string_split(lower(title), ' '), list_filter(string_split({S.collapse('lower(q)')}, ' '), lambda w: w <> '')) AS matches
        FROM (SELECT *, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'Data  analyst' WHEN 2 THEN 'senior' ELSE 'engine' END AS q FROM postings) s""",
        *POSTED,
    ),
)
def title_query_overlap(spark, sf_dir):
    k = F.col("doc_id") % 4
    q = F.when(k == 0, "").when(k == 1, "Data  analyst").when(k == 2, "senior").otherwise("engine")
    return posting_rows(spark, sf_dir).select(
        "doc_id", q.alias("q"), search.title_matches_query(F.col("title"), q).alias("matches")
    )


# --- rewrites -------------------------------------------------------------------------


@query("clean_text", with_views(f"SELECT doc_id, {S.collapse('description')} AS cleaned FROM postings", *POSTED))
def clean_text(spark, sf_dir):
    return posting_rows(spark, sf_dir).select("doc_id", text.clean_text(F.col("description")).alias("cleaned"))


_STAND_IN = f"""CASE WHEN board = 'indeed' AND NOT ({_SIZE} >= 50 OR ({_SIZE} >= 20 AND NOT contains(description, 'Listing summary from Indeed search results'))) AND {S.text('title')} <> ''
  THEN {S.text('title')} || ' at ' || CASE WHEN {S.text('company')} <> '' THEN {S.text('company')} ELSE 'company' END
    || CASE WHEN {S.text('location')} <> '' THEN ' · ' || {S.text('location')} ELSE '' END
    || '. Listing summary from Indeed search results. Open the posting link for the full job description.'
  ELSE description END"""

_JK = "lower(regexp_extract(job_url, '[?&]jk=([^&#]+)', 1))"
_HOST_PATH = "replace(lower(regexp_extract(job_url, '^https?://([^/?#]+)', 1)), 'www.', '') || rtrim(lower(regexp_extract(job_url, '^https?://[^/?#]+([^?#]*)', 1)), '/')"
NATIVE_KEY = f"""CASE
  WHEN board = 'indeed' THEN CASE WHEN regexp_matches({_JK}, '^[a-f0-9]{{8,}}$') THEN {_JK} END
  WHEN board = 'linkedin' THEN nullif(regexp_extract(job_url, '/jobs/view/(?:[^/?#]*-)?([0-9]{{5,}})', 1), '')
  WHEN contains(job_url, '/job/jsearch') OR contains(job_url, '/jobs/search') THEN NULL
  ELSE {_HOST_PATH} END"""
_STABLE = f"(CASE WHEN nk IS NOT NULL THEN {S.hash16(chr(39).join(['board || ', '|', ' || nk']))} END)"


@query(
    "stable_id",
    with_views(f"SELECT doc_id, nk AS native_key, {_STABLE} AS stable_id FROM (SELECT *, {NATIVE_KEY} AS nk FROM postings) s", *POSTED),
)
def stable_id(spark, sf_dir):
    return posting_rows(spark, sf_dir).select(
        "doc_id",
        urls.native_key(F.col("board"), F.col("job_url")).alias("native_key"),
        urls.stable_id(F.col("board"), F.col("job_url")).alias("stable_id"),
    )


_THREE = "coalesce(title, '') || '|' || coalesce(company, '') || '|' || coalesce(location, '')"


@query("fallback_id", with_views(f"SELECT doc_id, {S.hash16(f'lower({_THREE})')} AS fallback_id FROM postings", *POSTED))
def fallback_id(spark, sf_dir):
    return posting_rows(spark, sf_dir).select(
        "doc_id", urls.fallback_id(F.col("title"), F.col("company"), F.col("location")).alias("fallback_id")
    )


@query("queue_id", with_views(f"SELECT doc_id, {S.hash16(_THREE)} AS queue_id FROM postings", *POSTED))
def queue_id(spark, sf_dir):
    return posting_rows(spark, sf_dir).select(
        "doc_id", urls.queue_id(F.col("title"), F.col("company"), F.col("location")).alias("queue_id")
    )


@query(
    "indeed_key",
    with_views("SELECT doc_id, regexp_extract(job_url, '(?i)[?&]jk=([a-f0-9]+)', 1) AS jk FROM postings", *POSTED),
)
def indeed_key(spark, sf_dir):
    return posting_rows(spark, sf_dir).select("doc_id", urls.indeed_key(F.col("job_url")).alias("jk"))


@query(
    "prepare_rows",
    with_views(
        f"""SELECT doc_id, description, coalesce({_STABLE}, job_id) AS job_id FROM (
          SELECT doc_id, job_id, board, {NATIVE_KEY} AS nk, {_STAND_IN} AS description FROM postings WHERE {_PERSISTABLE.replace('description', f'({_STAND_IN})')}) s""",
        *POSTED,
    ),
)
def prepare_rows(spark, sf_dir):
    """Prepared rows that may be stored."""
    ready = R.prepare(posting_rows(spark, sf_dir))
    return ready.filter(R.is_persistable(R.board_of(ready))).select("doc_id", "description", "job_id")


@query(
    "strip_chrome",
    with_views(
        rf"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(description,
          '(?is)\bshow more{S.SPACE}+show less\b.*$', ''),
          '(?is)\bSeniority level\b.{{0,200}}?\bEmployment type\b.*$', ''),
          '(?i)(?:{S.SPACE}*\b(?:show|see) (?:more|less)\b[.…]*)+{S.SPACE}*$', ''), {S.SPACES}) AS stripped
        FROM (SELECT doc_id, description || CASE doc_id % 5 WHEN 0 THEN ' Seniority level Entry level Employment type Full-time' WHEN 1 THEN '… See more' ELSE '' END AS description FROM postings) s""",
        *POSTED,
    ),
)
def strip_chrome(spark, sf_dir):
    k = F.col("doc_id") % 5
    tail = F.when(k == 0, " Seniority level Entry level Employment type Full-time").when(k == 1, "… See more").otherwise("")
    return posting_rows(spark, sf_dir).select(
        "doc_id", text.strip_chrome(F.concat("description", tail)).alias("stripped")
    )


_ICONS = ["payments", "access_time", "work_outline", "school", "event", "flag"]


@query(
    "strip_icons",
    with_views(
        rf"""SELECT doc_id, trim(regexp_replace(replace(t, ' ', '  '), '(?i)(^| )(arrow_forward|arrow_back|business|location_city|payments|access_time|work_outline|trending_up|school|event|flag|checklist|description)($| )', '\1\3', 'g')) AS stripped
        FROM (SELECT doc_id, title || ' ' || CASE doc_id % 3 WHEN 0 THEN 'payments Access_Time' WHEN 1 THEN 'schooling flags' ELSE 'event' END || ' ' || location AS t FROM postings) s""",
        *POSTED,
    ),
)
def strip_icons(spark, sf_dir):
    k = F.col("doc_id") % 3
    word = F.when(k == 0, "payments Access_Time").when(k == 1, "schooling flags").otherwise("event")
    line = F.replace(F.concat_ws(" ", "title", word, "location"), F.lit(" "), F.lit("  "))
    return posting_rows(spark, sf_dir).select("doc_id", text.strip_icons(line).alias("stripped"))


@query(
    "canonical_url",
    with_views(
        """SELECT doc_id, CASE board
          WHEN 'indeed' THEN CASE WHEN contains(job_url, 'jk=') THEN 'https://pk.indeed.com/viewjob?jk=' || string_split(string_split(job_url, 'jk=')[2], '&')[1] ELSE '' END
          WHEN 'linkedin' THEN CASE WHEN contains(job_url, '/jobs/view/') THEN string_split(job_url, '?')[1] ELSE '' END
          WHEN 'rozee' THEN CASE WHEN doc_id % 3 = 0 THEN 'https:' || substring(job_url, 7) WHEN doc_id % 3 = 1 THEN 'https://www.rozee.pk' || substring(job_url, 21) ELSE '' END
          ELSE job_url END AS url FROM postings""",
        *POSTED,
    ),
)
def canonical_url(spark, sf_dir):
    k = F.col("doc_id") % 3
    rozee = F.when(k == 0, F.expr("substring(job_url, 7)")).when(k == 1, F.expr("substring(job_url, 21)")).otherwise(
        F.concat(F.lit("javascript:open("), "job_url", F.lit(")"))
    )
    href = F.when(F.col("board") == "rozee", rozee).otherwise(F.col("job_url"))
    return posting_rows(spark, sf_dir).select("doc_id", urls.canonical_url(F.col("board"), href).alias("url"))


_FRAGMENT = "CASE doc_id % 7 WHEN 0 THEN 'Full-Time ' WHEN 1 THEN 'full time, onsite' WHEN 2 THEN 'Part-time' WHEN 3 THEN 'Partial remote' WHEN 4 THEN 'Contractor' WHEN 5 THEN 'Interns' ELSE 'fully remote' END || location"


@query(
    "employment_type",
    with_views(
        f"""SELECT doc_id, CASE
          WHEN board IN ('indeed', 'linkedin') THEN CASE WHEN contains(t, 'full-time') OR contains(t, 'full time') THEN 'full-time' WHEN contains(t, 'part-time') THEN 'part-time' WHEN contains(t, 'contract') THEN 'contract' WHEN contains(t, 'internship') OR (board = 'indeed' AND contains(t, 'intern')) THEN 'internship' END
          ELSE CASE WHEN contains(t, 'full') THEN 'full-time' WHEN contains(t, 'part') THEN 'part-time' WHEN contains(t, 'contract') THEN 'contract' WHEN contains(t, 'intern') THEN 'internship' END END AS kind
        FROM (SELECT doc_id, board, lower({_FRAGMENT}) AS t FROM postings) s""",
        *POSTED,
    ),
)
def employment_type(spark, sf_dir):
    return posting_rows(spark, sf_dir).select(
        "doc_id", fields.employment_type(F.expr(_FRAGMENT), F.col("board")).alias("kind")
    )


# --- enrichment ---------------------------------------------------------------------------

_CLEANED = f"SELECT *, {S.CLEAN} AS clean FROM postings"
_TEXTS = {"cleaned": _CLEANED, "texts": S.SENTENCES}
_LOWERED = {
    **_TEXTS,
    "low": "SELECT *, lower(full_text) AS lt, lower(coalesce(experience_required, '') || ' ' || full_text) AS et FROM texts",
}


@query("entities", with_views(f"SELECT page_id, {S.unescape('html')} AS decoded FROM job_pages", "job_pages"))
def entities(spark, sf_dir):
    return view(spark, sf_dir, "job_pages").select("page_id", text.unescape(F.col("html")).alias("decoded"))


@query(
    "html_text",
    with_views(
        f"SELECT page_id, {S.collapse(f'regexp_replace({S.unescape(chr(104) + chr(116) + chr(109) + chr(108))}, {chr(39)}<[^>]+>{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')} AS body FROM job_pages",
        "job_pages",
    ),
)
def html_text(spark, sf_dir):
    return view(spark, sf_dir, "job_pages").select("page_id", text.html_text(F.col("html")).alias("body"))


@query("dedup_sentences", with_views("SELECT doc_id, full_text FROM texts", *POSTED, **_TEXTS))
def dedup_sentences(spark, sf_dir):
    clean = text.clean_text(text.unescape(F.col("description")))
    return (
        posting_rows(spark, sf_dir).select("doc_id", clean.alias("clean"))
        .select("doc_id", text.dedup_sentences(F.col("clean")).alias("full_text"))
    )


_SECTION_COLUMNS = ", ".join(f"{S.section(n)} AS {n}" for n in S.SECTION_NAMES)


@query(
    "sections",
    with_views(
        f"SELECT doc_id, {_SECTION_COLUMNS} FROM (SELECT doc_id, {S.pieces('clean')} AS pieces FROM cleaned) s",
        *POSTED,
        cleaned=_CLEANED,
    ),
)
def sections(spark, sf_dir):
    found = posting_rows(spark, sf_dir).select(
        "doc_id", text.sections(text.clean_text(text.unescape(F.col("description")))).alias("m")
    )
    return found.select("doc_id", *[F.try_element_at("m", F.lit(n)).alias(n) for n in S.SECTION_NAMES])


_SECTION_COUNT = " + ".join(f"CASE WHEN {S.section(n)} IS NULL THEN 0 ELSE 1 END" for n in S.SECTION_NAMES)


@query(
    "clean_description",
    with_views(
        f"SELECT doc_id, full_text, CAST({S.words('full_text')} AS INTEGER) AS word_count, CAST({_SECTION_COUNT} AS INTEGER) AS n_sections FROM (SELECT *, {S.pieces('clean')} AS pieces FROM texts) s",
        *POSTED,
        **_TEXTS,
    ),
)
def clean_description(spark, sf_dir):
    return E.clean_descriptions(posting_rows(spark, sf_dir)).select(
        "doc_id", "full_text", "word_count", F.size("description_sections").alias("n_sections")
    )


_ALL_SKILLS = f"list_distinct(list_concat(CASE WHEN skills_csv = '' THEN [] ELSE string_split(skills_csv, ',') END, {S.skill_list('lt')}))"


@query(
    "skills",
    with_views(
        f"SELECT doc_id, array_to_string(list_sort({_ALL_SKILLS}), '|') AS skills FROM low",
        *POSTED,
        **_LOWERED,
    ),
)
def skill_lists(spark, sf_dir):
    cleaned = E.clean_descriptions(posting_rows(spark, sf_dir)).select("doc_id", "skills", F.lower("full_text").alias("low"))
    found = F.array_union("skills", skills.matched_skills(F.col("low"), S.VOCABULARY))
    return cleaned.select("doc_id", joined(found).alias("skills"))


@query(
    "skill_pairs",
    with_views(
        "SELECT doc_id, skill FROM (" + f"SELECT doc_id, unnest({S.skill_list('lt')}) AS skill FROM low) s",
        *POSTED,
        **_LOWERED,
    ),
)
def skill_pairs(spark, sf_dir):
    """The table form of the match, for vocabularies too large for expressions."""
    texts = E.clean_descriptions(posting_rows(spark, sf_dir)).select("doc_id", "full_text")
    vocabulary = spark.createDataFrame([(s,) for s in S.VOCABULARY], "skill string")
    return skills.skill_pairs(texts, vocabulary, key="doc_id", text="full_text")


_CATEGORY = """CASE WHEN regexp_matches(lower(skill), 'communication|leadership|team|problem|collaboration|analytical|creative|critical thinking|management') THEN 'soft'
  WHEN regexp_matches(lower(skill), 'git|jira|jenkins|docker|kubernetes|hadoop') THEN 'tools' ELSE 'technical' END"""


@query(
    "skill_category",
    with_views(
        f"SELECT skill, {_CATEGORY} AS category, count(*) AS n FROM (SELECT unnest({_ALL_SKILLS}) AS skill FROM low) s GROUP BY ALL",
        *POSTED,
        **_LOWERED,
    ),
)
def skill_category(spark, sf_dir):
    cleaned = E.clean_descriptions(posting_rows(spark, sf_dir)).select("skills", F.lower("full_text").alias("low"))
    found = F.array_union("skills", skills.matched_skills(F.col("low"), S.VOCABULARY))
    counted = cleaned.select(F.explode(found).alias("skill")).groupBy("skill").agg(F.count("*").alias("n"))
    return counted.withColumn("category", skills.skill_category(F.col("skill")))


_EXPERIENCE = f"""SELECT *, coalesce(CAST(nullif(regexp_extract(raw_text, '[0-9]+'), '') AS BIGINT), 0) AS min_years,
  CAST(nullif(regexp_extract(raw_text, '^[0-9]+[^0-9]+([0-9]+)', 1), '') AS BIGINT) AS max_years
  FROM (SELECT *, {S.year_text('et')} AS raw_text, coalesce({S.cases('et', S.LEVEL_WORDS)}, 'unknown') AS level FROM low) s"""


@query(
    "experience",
    with_views("SELECT doc_id, min_years, max_years, level, raw_text FROM parsed", *POSTED, **_LOWERED, parsed=_EXPERIENCE),
)
def experience(spark, sf_dir):
    cleaned = E.clean_descriptions(posting_rows(spark, sf_dir))
    parsed = fields.experience(fields.field_and_text(F.col("experience_required"), F.col("full_text")))
    return cleaned.select("doc_id", parsed.alias("e")).select("doc_id", "e.*")


_YEARS = """CAST(CASE WHEN coalesce(raw_text, '') <> '' OR level <> 'unknown' THEN min_years
  ELSE try_cast(nullif(regexp_extract(coalesce(experience_required, ''), '[0-9]+'), '') AS BIGINT) END AS INTEGER)"""


@query(
    "experience_years",
    with_views(f"SELECT doc_id, {_YEARS} AS years FROM parsed", *POSTED, **_LOWERED, parsed=_EXPERIENCE),
)
def experience_years(spark, sf_dir):
    enriched = E.enrich(posting_rows(spark, sf_dir), S.VOCABULARY, now())
    years = fields.experience_years(F.col("experience_parsed"), F.col("experience_required"))
    return enriched.select("doc_id", years.alias("years"))


@query(
    "salary",
    with_views(
        "SELECT doc_id, " + ", ".join(f"{v} AS {'pay_' + k if k in ('min', 'max') else k}" for k, v in S.SALARY_CASES.items()) + " FROM postings",
        *POSTED,
    ),
)
def salary(spark, sf_dir):
    rows = posting_rows(spark, sf_dir).select("doc_id", fields.salary(F.col("salary")).alias("s"))
    return rows.select("doc_id", "s.currency", F.col("s.min").alias("pay_min"), F.col("s.max").alias("pay_max"), "s.period")


@query(
    "education",
    with_views(f"SELECT doc_id, {S.cases(chr(39) + ' ' + chr(39) + ' || lt', S.EDUCATION_WORDS)} AS education FROM low", *POSTED, **_LOWERED),
)
def education(spark, sf_dir):
    cleaned = E.clean_descriptions(posting_rows(spark, sf_dir))
    low = fields.field_and_text(F.lit(None).cast("string"), F.col("full_text"))
    return cleaned.select("doc_id", fields.education(low).alias("education"))


_TYPE = f"coalesce({S.cases('lower(employment_type)', S.TYPE_WORDS)}, {S.cases('lt', S.TYPE_WORDS)}, 'Full-time')"


@query("job_type", with_views(f"SELECT doc_id, {_TYPE} AS job_type FROM low", *POSTED, **_LOWERED))
def job_type(spark, sf_dir):
    cleaned = E.clean_descriptions(posting_rows(spark, sf_dir))
    return cleaned.select("doc_id", fields.job_type(F.col("employment_type"), F.lower("full_text")).alias("job_type"))


_ENRICHED = f"""SELECT *, least(100, 55 + CASE WHEN words > 100 THEN 10 ELSE 0 END + CASE WHEN n_sections > 1 THEN 20 ELSE 0 END
    + CASE WHEN len(skill_set) >= 3 THEN 10 ELSE 0 END + CASE WHEN len(skill_set) >= 7 THEN 10 ELSE 0 END
    + CASE WHEN min_years > 0 OR level <> 'unknown' THEN 10 ELSE 0 END + CASE WHEN currency IS NOT NULL THEN 10 ELSE 0 END
    + CASE WHEN education IS NOT NULL THEN 5 ELSE 0 END) / 100.0::DOUBLE AS confidence
  FROM (SELECT *, {S.words('full_text')} AS words, {_SECTION_COUNT} AS n_sections, list_sort({_ALL_SKILLS}) AS skill_set,
      {S.cases("' ' || lt", S.EDUCATION_WORDS)} AS education, {_TYPE} AS job_type,
      {', '.join(f"{v} AS {'pay_' + k if k in ('min', 'max') else k}" for k, v in S.SALARY_CASES.items())}
    FROM (SELECT *, {S.pieces('clean')} AS pieces FROM parsed) p) q"""
ENRICHED_CTES = {**_LOWERED, "parsed": _EXPERIENCE, "enriched": _ENRICHED}


@query("confidence", with_views("SELECT doc_id, confidence FROM enriched", *POSTED, **ENRICHED_CTES))
def confidence(spark, sf_dir):
    return E.enrich(posting_rows(spark, sf_dir), S.VOCABULARY, now()).select(
        "doc_id", F.col("enrichment_confidence").alias("confidence")
    )


def enriched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every posting enriched, nested values flattened to columns."""
    out = E.enrich(posting_rows(spark, sf_dir), S.VOCABULARY, now())
    groups = F.col("skills_categorized")
    return out.select(
        "doc_id", "job_id", "title", "description",
        joined(F.col("skills")).alias("skills"),
        joined(groups["technical"]).alias("technical"),
        joined(groups["soft"]).alias("soft"),
        joined(groups["tools"]).alias("tools"),
        *[F.try_element_at("description_sections", F.lit(n)).alias(n) for n in S.SECTION_NAMES],
        "experience_parsed.min_years", "experience_parsed.max_years", "experience_parsed.level",
        "salary_normalized.currency",
        F.col("salary_normalized.min").alias("pay_min"),
        F.col("salary_normalized.max").alias("pay_max"),
        "salary_normalized.period",
        F.col("education_required").alias("education"),
        F.col("employment_type").alias("job_type"),
        F.col("enrichment_confidence").alias("confidence"),
        F.col("enrichment_timestamp").alias("enriched_at"),
    )


def _group(name: str) -> str:
    return f"array_to_string(list_filter(skill_set, lambda skill: {_CATEGORY} = '{name}'), '|') AS {name}"


@query(
    "enrich_batch",
    with_views(
        f"""SELECT doc_id, job_id, title, full_text AS description, array_to_string(skill_set, '|') AS skills,
          {_group('technical')}, {_group('soft')}, {_group('tools')}, {_SECTION_COLUMNS}, min_years, max_years, level,
          currency, pay_min, pay_max, period, education, job_type, confidence, {S.NOW} AS enriched_at FROM enriched""",
        *POSTED,
        **ENRICHED_CTES,
    ),
)
def enrich_batch(spark, sf_dir):
    return enriched_rows(spark, sf_dir)


@query("posted_at", with_views(f"SELECT doc_id, {S.POSTED_CASES} AS posted_at FROM postings", *POSTED))
def posted_at(spark, sf_dir):
    return posting_rows(spark, sf_dir).select("doc_id", dates.posted_at(F.col("posted_date"), now()).alias("posted_at"))
