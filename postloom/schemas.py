"""Declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, TIME = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType()
STRINGS = T.ArrayType(STRING)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SALARY = struct(currency=STRING, min=LONG, max=LONG, period=STRING, raw=STRING)
EXPERIENCE = struct(min_years=LONG, max_years=LONG, level=STRING, raw_text=STRING)
SKILL_GROUPS = struct(technical=STRINGS, soft=STRINGS, tools=STRINGS)

PAGES = struct(page_id=LONG, url=STRING, html=STRING)

# A scraped posting before it is stored.
POSTING = struct(
    job_id=STRING, title=STRING, company=STRING, location=STRING, job_url=STRING, board=STRING,
    description=STRING, skills=STRINGS, posted_date=STRING, salary=STRING,
    employment_type=STRING, experience_required=STRING, education_required=STRING,
    industry=STRING, raw_html=STRING, date_scrapped=STRING, job_source=STRING,
)

# The stored table, one row per job_id.
JOBS = struct(
    job_id=STRING, job_title=STRING, job_description=STRING, skills_required=STRINGS,
    experience_required=INT, education_required=STRING, job_type=STRING, location=STRING,
    industry=STRING, company=STRING, url=STRING, job_source=STRING, date_scrapped=TIME,
    posted_date=STRING, posted_at=TIME, salary_raw=STRING, salary_normalized=SALARY,
    description_sections=T.MapType(STRING, STRING), skills_categorized=SKILL_GROUPS,
    experience_parsed=EXPERIENCE, enrichment_confidence=T.DoubleType(),
    enrichment_timestamp=TIME, raw_payload=STRING,
)

SEEN = struct(job_id=STRING, processed_at=TIME)
ERRORS = struct(url=STRING, error_message=STRING, retries=INT, timestamp=TIME)

# The columns the reconcile step reads from the stored table.
LOOKUP_COLUMNS = [
    "job_id", "job_description", "company", "location", "url", "job_title",
    "job_type", "salary_raw", "posted_date", "skills_required",
]

# Nullable columns added to an older stored table.
ADDED_COLUMNS = [
    "posted_date", "posted_at", "salary_raw", "salary_normalized",
    "description_sections", "skills_categorized", "experience_parsed",
    "enrichment_confidence", "enrichment_timestamp", "raw_payload",
]
