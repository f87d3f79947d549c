"""Enrichment: clean text, sections, skills, experience, salary, education, type, score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.functions import fields, skills
from postloom.functions.text import clean_text, dedup_sentences, sections, unescape, word_count


def clean_descriptions(df: DataFrame, text: str = "description") -> DataFrame:
    """Adds ``full_text``, ``description_sections``, ``word_count``.

    Sections come from the collapsed text before equal sentences are dropped.
    """
    cleaned = df.withColumn("_clean", clean_text(unescape(F.col(text))))
    return (
        cleaned.withColumn("description_sections", sections(F.col("_clean")))
        .withColumn("full_text", dedup_sentences(F.col("_clean")))
        .withColumn("word_count", word_count(F.col("full_text")))
        .drop("_clean")
    )


def _with_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    absent = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def enrich(postings: DataFrame, vocabulary: list[str], now: Column, *, matched: str | None = None) -> DataFrame:
    """Enrich every posting in narrow projections; no shuffle, no Python.

    ``matched`` names an array column of skills already matched by
    ``skills.skill_pairs``; without it the vocabulary list is matched here.
    """
    base = clean_descriptions(
        _with_missing(
            postings,
            {
                "skills": "array<string>", "salary": "string", "employment_type": "string",
                "experience_required": "string", "education_required": "string",
            },
        )
    ).withColumn("_low", F.lower("full_text"))
    found = F.col(matched) if matched else skills.matched_skills(F.col("_low"), vocabulary)
    own = F.coalesce(F.col("skills"), F.array().cast("array<string>"))
    parsed = (
        base.withColumn("skills", F.array_sort(F.array_union(own, found)))
        .withColumn("experience_parsed", fields.experience(fields.field_and_text(F.col("experience_required"), F.col("_low"))))
        .withColumn("salary_normalized", fields.salary(F.col("salary")))
        .withColumn("_education", fields.education(fields.field_and_text(F.col("education_required"), F.col("_low"))))
        .withColumn("employment_type", fields.job_type(F.col("employment_type"), F.col("_low")))
        .withColumn("skills_categorized", skills.skill_groups(F.col("skills")))
    )
    return (
        parsed.withColumn(
            "enrichment_confidence",
            fields.confidence(
                F.col("word_count"), F.size("description_sections"), F.size("skills"),
                F.col("experience_parsed"), F.col("salary_normalized"), F.col("_education"),
            ),
        )
        .withColumn("enrichment_timestamp", now)
        .withColumn("education_required", F.coalesce("_education", "education_required"))
        .withColumn("description", F.col("full_text"))
        .drop("_low", "_education", "full_text", "word_count")
    )


def enrich_with_table(
    postings: DataFrame, vocabulary: DataFrame, now: Column, *, key: str
) -> DataFrame:
    """``enrich`` with the vocabulary as a table of any size; ``key`` is unique per posting."""
    texts = clean_descriptions(postings.select(key, "description")).select(key, "full_text")
    pairs = skills.skill_pairs(texts, vocabulary, key=key, text="full_text")
    matched = pairs.groupBy(key).agg(F.collect_set("skill").alias("_matched"))
    joined = postings.join(matched, key, "left").withColumn(
        "_matched", F.coalesce("_matched", F.array().cast("array<string>"))
    )
    return enrich(joined, [], now, matched="_matched").drop("_matched")
